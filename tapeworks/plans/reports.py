"""Report ingestion and reads: raw-line archive, layout parsing, read by dates.

Raw reports land as lines ``(section, api_name, report_date, line_no,
line)`` so any report can be re-parsed later; the three typed layouts parse
from those lines.  Reading by a date list is a join of the dates with the
inventory: present dates are read in one multi-file scan, absent ones are
returned as a separate ``missing`` DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_filter, dates_frame
from ..operators.layouts import LAYOUTS, parse_report
from ..sources.catalog import CATALOG
from ..sources.inventory import path_missing
from ..sources.text import scan_lines

REPORT_NAME_PATTERN = r"/([^/]+)/([^/]+)/year=([0-9]{4})/([0-9]{4}-[0-9]{2}-[0-9]{2})\.csv$"


def report_lines_from_files(spark: SparkSession, root: str, api_name: str | None = None) -> DataFrame:
    """Lines of raw report CSVs stored as ``{root}/{section}/{api}/year=Y/Y-M-D.csv``.

    UTF-8, BOM stripped from line 1; blank lines kept (they consume numbers).
    """
    glob = f"{root}/*/{api_name or '*'}/year=*/*.csv"
    lines = scan_lines(spark, glob, "UTF-8", strip_bom=True)
    return lines.select(
        F.regexp_extract("path", REPORT_NAME_PATTERN, 1).alias("section"),
        F.regexp_extract("path", REPORT_NAME_PATTERN, 2).alias("api_name"),
        F.try_to_date(F.regexp_extract("path", REPORT_NAME_PATTERN, 4), "yyyy-MM-dd").alias("report_date"),
        "line_no", "line")


def report_lines_from_binary(raw: DataFrame) -> DataFrame:
    """Lines of whole report files (a ``binaryFile`` batch, as a stream delivers them).

    One file is one row, so this is for files of a report-day (tens of MB);
    larger ones go through :func:`report_lines_from_files`, which splits them.
    """
    name = [F.regexp_extract("path", REPORT_NAME_PATTERN, i) for i in (1, 2, 4)]
    text = F.regexp_replace(F.decode("content", "UTF-8"), "\\A\uFEFF", "")
    keyed = raw.select(name[0].alias("section"), name[1].alias("api_name"),
                       F.try_to_date(name[2], "yyyy-MM-dd").alias("report_date"), text.alias("_text"))
    # a final newline ends the last line, it does not open one
    lines = F.split(F.regexp_replace("_text", "\n\\z", ""), "\n", -1)
    return keyed.where(F.col("report_date").isNotNull() & (F.col("_text") != "")).select(
        "section", "api_name", "report_date", F.posexplode(lines).alias("_pos", "_line")).select(
        "section", "api_name", "report_date", (F.col("_pos") + 1).cast("int").alias("line_no"),
        F.regexp_replace("_line", "\\r+\\z", "").alias("line"))


def landed_reports(spark: SparkSession, root: str) -> DataFrame | None:
    """(section, api_name, report_date) already landed; None if nothing is."""
    try:
        return read_raw_lines(spark, root).select("section", "api_name", "report_date").distinct()
    except Exception as exc:  # noqa: BLE001
        if path_missing(exc):
            return None
        raise


def read_raw_lines(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("line_no int, line string, section string, api_name string, year int, "
                             "report_date date").parquet(root)


def archive_raw_lines(lines: DataFrame, root: str, skip_existing: bool = False) -> None:
    """Landing sink for raw report lines, partitioned down to the report date (SNK-4).

    Dynamic overwrite: landing a report-date replaces only that date; reads by
    date prune to its folder.  ``skip_existing`` leaves landed dates untouched.
    """
    if skip_existing:
        landed = landed_reports(lines.sparkSession, root)
        if landed is not None:
            lines = lines.join(landed, ["section", "api_name", "report_date"], "left_anti")
    # one task per (report, date, block of lines) - never a whole report-year
    block = F.floor(F.col("line_no") / F.lit(1_000_000))
    (lines.withColumn("year", F.year("report_date"))
          .repartition("section", "api_name", "report_date", block)
          .sortWithinPartitions("report_date", "line_no")
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("section", "api_name", "year", "report_date").parquet(root))


def parse_layout(lines: DataFrame, api_name: str, keys=("report_date",)):
    """Typed rows and verdicts of one report; unknown layout -> NotImplementedError."""
    layout = LAYOUTS.get(api_name)
    return parse_report(lines, layout, list(keys))


def read_report_by_dates(spark: SparkSession, lines: DataFrame, api_name: str, dates):
    """``(rows, missing)`` for a report over requested dates.

    ``lines`` is the landing dataset (or any lines DataFrame with
    ``api_name, report_date, line_no, line``).  Unknown report names fail
    eagerly; a name without a layout raises ``NotImplementedError``.
    Missing dates are reported, never fatal; with nothing found the rows
    DataFrame is empty but keeps the declared schema.
    """
    if api_name not in {row[0] for row in CATALOG}:
        raise KeyError(f"unknown report {api_name!r}")
    layout = LAYOUTS.get(api_name)
    wanted = dates_frame(spark, dates).withColumnRenamed("d", "report_date")
    # a filter on the dates themselves, so a partitioned landing table is pruned to them
    chosen = lines.where((F.col("api_name") == api_name) & date_filter(F.col("report_date"), dates))
    missing = wanted.join(chosen.select("report_date").distinct(), "report_date", "left_anti")
    rows, verdicts = parse_report(chosen, layout, ["report_date"])
    return rows, missing, verdicts


def report_support(names: DataFrame) -> DataFrame:
    """Adds ``support`` to rows with ``report_name``: ``parsed`` (has a layout), ``unparsed`` (landed as raw
    lines only) or ``unknown`` - what :func:`read_report_by_dates` reads, or refuses by which error (SRC-8)."""
    name = F.col("report_name")
    return names.withColumn("support", F.when(name.isin(*LAYOUTS.names()), "parsed")
                            .when(name.isin(*[row[0] for row in CATALOG]), "unparsed").otherwise("unknown"))


def catalog_fanout(spark: SparkSession, dates: DataFrame) -> DataFrame:
    """Dates x enabled reports (the daily work list).

    The 63 catalog rows are a literal array exploded per date - a bounded
    fan-out, no join.
    """
    from ..sources.catalog import CATALOG, DISABLED
    rows = F.array(*[F.struct(F.lit(n).alias("api_name"), F.lit(s).alias("section"),
                              F.lit(sla if sla else None).cast("string").alias("sla_time"))
                     for n, s, _, _, sla in CATALOG if n not in DISABLED])
    return dates.select("*", F.inline(rows))


# --- Fixed value: payloads shorter than this are "no report today" ---
MIN_REPORT_BYTES = 10


def availability(inventory: DataFrame) -> DataFrame:
    """Report files too short to hold a report are UNAVAILABLE (FLT-8)."""
    return inventory.withColumn(
        "available", F.col("length") >= MIN_REPORT_BYTES).withColumn(
        "status", F.when(F.col("length") < MIN_REPORT_BYTES, "UNAVAILABLE"))


def lines_from_bytes(spark: SparkSession, payload: bytes, api_name: str, report_date,
                     encoding: str = "utf-8-sig") -> DataFrame:
    """Lines of one report given as bytes (e.g. just fetched), ready for parsing.

    For a single user-supplied payload that is already on the driver; files
    at rest go through :func:`report_lines_from_files`.
    """
    import datetime as _dt
    text = payload.decode(encoding)
    rows = text.split("\n")
    if rows and rows[-1] == "":
        rows.pop()
    d = report_date if isinstance(report_date, _dt.date) else _dt.date.fromisoformat(str(report_date))
    data = [(api_name, d, i + 1, r.rstrip("\r")) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "api_name string, report_date date, line_no int, line string")
