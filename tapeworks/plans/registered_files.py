"""Registered queries over real files: archives, text, the lake and its streams.

The files are rendered from the driver tables into the shared checkpoint
folder, then read by the operators as they would be in production.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixtures import derived as D
from ..fixtures.archives import write_archives, write_spanning_reports, write_text_files
from ..fixtures.rendered import btb_lines_from_lineitem, tick_lines_from_events
from ..operators import validate
from ..session import checkpoint_dir, cut_lineage, delete_at_end
from ..sources import archive_source
from ..sources.text import physical_line_counts, scan_lines
from ..streaming.incremental import ingest_new_archives
from ..streaming.sessions import read_sessions, run_session_stream
from . import lake as L
from . import oracle_files as OF
from .backfill import lake_facts, lake_footers, run_dates
from .reports import archive_raw_lines, parse_layout, read_raw_lines, read_report_by_dates, report_support
from .ticks import existing_provenance, process_archives, process_lines, rebuild_report, write_rebuild_report, write_ticks

REPORT_RANGE = ("1995-03-01", "1996-08-30")


def _folder(spark, name: str) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return path


def _lines(spark, sf_dir) -> DataFrame:
    return cut_lineage(tick_lines_from_events(spark.read.parquet(f"{sf_dir}/events.parquet")))


def _archives(spark, sf_dir) -> str:
    root = _folder(spark, "archives")
    write_archives(_lines(spark, sf_dir), root)
    return root


def q_archive_verdicts(spark, sf_dir):
    return process_archives(spark, _archives(spark, sf_dir)).verdicts.drop("message")


def q_archive_source_lines(spark, sf_dir):
    """Lines per archive from the named source: a batch read, and a stream that is restarted when the even days land."""
    lines, root, out = _lines(spark, sf_dir), _folder(spark, "archives"), _folder(spark, "source")
    archive_source.register(spark)

    def land(df, epoch):
        df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{out}/rows")

    for parity in (1, 0):
        write_archives(lines.where(F.dayofmonth("file_date") % 2 == parity), root)
        stream = spark.readStream.format(archive_source.NAME).load(root)
        (stream.writeStream.foreachBatch(land).option("checkpointLocation", f"{out}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    batch = spark.read.format(archive_source.NAME).load(root)
    both = batch.select(F.lit("batch").alias("way"), "feed", "file_date", "source_row", "n_lines").unionByName(
        spark.read.parquet(f"{out}/rows").select(F.lit("stream").alias("way"), "feed", "file_date", "source_row", "n_lines"))
    return both.groupBy("way", "feed", "file_date").agg(
        F.count_if(F.col("source_row") > 0).alias("lines_read"), F.max("n_lines").alias("lines_counted"))


def q_archive_stream(spark, sf_dir):
    """Provenance after two runs of the incremental ingest, the second with the archives of even days."""
    lines, root, lake = _lines(spark, sf_dir), _folder(spark, "landing"), _folder(spark, "stream-lake")
    for parity in (1, 0):
        write_archives(lines.where(F.dayofmonth("file_date") % 2 == parity), root)
        ingest_new_archives(spark, root, lake, f"{lake}/_checkpoint", build_id="b1")
    return existing_provenance(spark, lake).select(
        "feed", "file_date", "source_txt_row_count", "row_count", "timestamp_null_count")


def q_run_outcomes(spark, sf_dir):
    """Run log of a daily run over all archived dates and one without an archive; archives go to another store."""
    root, lake, store = _archives(spark, sf_dir), _folder(spark, "run-lake"), _folder(spark, "store")
    asked = _lines(spark, sf_dir).select("feed", "file_date").distinct()
    none = asked.select("feed", F.lit("1999-01-04").cast("date").alias("file_date")).distinct()
    log = run_dates(spark, root, lake, asked.union(none), "b1", archive_store=store)
    return log.select("feed", "trade_date", "download", "extract", "partition", "s3_upload", "ticks_s3_upload",
                      "tick_count", F.col("error").isNotNull().alias("failed"))


def q_tick_line_counts(spark, sf_dir):
    """A reader that loses line 3 of every file of a day divisible by seven is caught by the independent count."""
    root = _folder(spark, "tick-text")
    write_text_files(_lines(spark, sf_dir), root)
    feed = F.regexp_extract("path", "feed=([A-Z]+)/", 1).alias("feed")
    day = F.regexp_extract("path", "file_date=([0-9-]+)/", 1).cast("date").alias("file_date")
    counts = physical_line_counts(spark, root).select(feed, day, "n_lines")
    lines = scan_lines(spark, root, "ISO-8859-1").select(feed, day, F.col("line_no").alias("source_row"), "line")
    lossy = lines.where((F.dayofmonth("file_date") % 7 != 0) | (F.col("source_row") != 3))
    v = validate.file_verdicts(lossy, None, counts).join(counts, validate.FILE_KEYS)
    return v.select("feed", "file_date", "n_lines", F.coalesce(F.col("rule") == "line_count", F.lit(False)).alias("lost"))


def _lake(spark, sf_dir) -> str:
    lake = _folder(spark, "files-lake")
    write_ticks(process_lines(_lines(spark, sf_dir)), lake)
    return lake


def q_lake_schema(spark, sf_dir):
    """Dates whose files differ from the written schema: one file is replaced by one with another column type."""
    lake = _lake(spark, sf_dir)
    first = L.current(spark, lake).orderBy("feed", "file_date").first()
    rows = spark.read.schema(L.TICKS_SCHEMA).parquet(*L.tick_paths(lake, [first])).drop("feed", "year", "file_date")
    other = cut_lineage(rows.withColumn("quantity", F.col("quantity").cast("string")))
    other.write.mode("overwrite").parquet(f"{lake}/ticks/{L.date_folder(first.feed, first.file_date)}")
    return lake_facts(spark, lake).select("feed", "file_date", "has_provenance", "schema_matches")


def q_lake_footer_index(spark, sf_dir):
    """Files and how many of them were opened, in a first look at the lake and in a second behind a rebuilt day."""
    lake = _lake(spark, sf_dir)

    def look(turn: int) -> DataFrame:
        return cut_lineage(lake_footers(spark, lake).groupBy(F.lit(turn).alias("turn")).agg(
            F.count(F.lit(1)).alias("n_files"), F.count_if("opened").alias("n_opened"), F.count_if("conforms").alias("n_conform")))

    one = look(1)
    write_ticks(process_lines(_lines(spark, sf_dir).where(F.dayofmonth("file_date") == 8)), lake)
    return one.unionByName(look(2))


def q_lake_order(spark, sf_dir):
    """Rows as the files hold them: their lines rise within every file (ORD-1)."""
    lake = _lake(spark, sf_dir)
    rows = spark.read.schema(L.TICKS_SCHEMA).parquet(f"{lake}/ticks").select(
        "feed", "file_date", "source_row", F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("p")).alias("at"))
    # a file holds at most ROWS_PER_FILE rows, so a window over one is bounded
    before = F.lag("source_row").over(Window.partitionBy("path").orderBy("at"))
    return rows.withColumn("_before", before).groupBy("feed", "file_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("source_row").alias("first_row"), F.max("source_row").alias("last_row"),
        F.count_if(F.col("_before") >= F.col("source_row")).alias("n_descents"))


def q_session_stream(spark, sf_dir):
    """Sessions that a later file closed, from the stream over commits of odd, then even days."""
    lines, lake = _lines(spark, sf_dir), _folder(spark, "session-lake")
    for parity in (1, 0):
        write_ticks(process_lines(lines.where(F.dayofmonth("file_date") % 2 == parity)), lake)
        run_session_stream(spark, lake, f"{lake}/_checkpoint")
    return read_sessions(spark, lake).where("complete").drop("complete", "version")


def q_rebuild_report_csv(spark, sf_dir):
    out = _folder(spark, "report-csv")
    b = process_lines(_lines(spark, sf_dir))
    write_rebuild_report(rebuild_report(b.verdicts, b.ticks), out)
    back = spark.read.option("header", True).schema(
        "feed string, trade_date string, status string, row_count bigint, timestamp_null_count bigint, "
        "other_session_row_count bigint, seconds double, error string").csv(out)
    return back.withColumn("error", F.coalesce("error", F.lit("")))


def q_report_spanning_rows(spark, sf_dir):
    """Report rows whose cells span lines, read from text files in splits of 256 KB."""
    root = _folder(spark, "spanning")
    write_spanning_reports(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), root)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    try:  # the scan is materialised by the numbering, with these splits
        lines = scan_lines(spark, root, "UTF-8").select(
            F.regexp_extract("path", "report_date=([0-9-]+)/", 1).cast("date").alias("report_date"), "line_no", "line")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows, _ = parse_layout(lines, "BTBLoanBalance")
    return rows.select("report_date", "line_no", "if_code", "company_name", "contracts_count", "assets_quantity", "value_brl")


def q_report_lake_gaps(spark, sf_dir):
    """Requested report dates that were never landed: days divisible by three are left out."""
    root = _folder(spark, "gap-lake")
    lines = btb_lines_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).withColumns(
        {"section": F.lit("lending"), "api_name": F.lit("BTBLoanBalance")})
    archive_raw_lines(lines.where(F.dayofmonth("report_date") % 3 != 0), root)
    return read_report_by_dates(spark, read_raw_lines(spark, root), "BTBLoanBalance", REPORT_RANGE)[1]


def q_report_support(spark, sf_dir):
    """What a read of each named report would do; every eleventh order asks for a name that is not in the catalog."""
    r = D.report_results_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    name = F.when(F.dayofmonth("trade_date") == 11, F.concat("report_name", F.lit("X"))).otherwise(F.col("report_name"))
    return report_support(r.withColumn("report_name", name)).groupBy("report_name", "support").agg(
        F.count(F.lit(1)).alias("n_asked"))


QUERIES = {
    "report_spanning_rows": q_report_spanning_rows,
    "archive_verdicts": q_archive_verdicts,
    "archive_source_lines": q_archive_source_lines,
    "archive_stream": q_archive_stream,
    "run_outcomes": q_run_outcomes,
    "tick_line_counts": q_tick_line_counts,
    "lake_schema": q_lake_schema,
    "lake_footer_index": q_lake_footer_index,
    "lake_order": q_lake_order,
    "session_stream": q_session_stream,
    "rebuild_report_csv": q_rebuild_report_csv,
    "report_lake_gaps": q_report_lake_gaps,
    "report_support": q_report_support,
}

ORACLE_SQL = {name: getattr(OF, name.upper()) for name in QUERIES}
