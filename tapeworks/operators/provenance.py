"""Per-file provenance facts and the output checks that use them.

Provenance is its own table keyed ``(feed, file_date)`` (a DataFrameWriter
cannot put a different footer key on every file).  All facts come from
partial aggregates, so each file contributes a handful of bytes to the
shuffle whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from .validate import FILE_KEYS


def tick_facts(ticks: DataFrame) -> DataFrame:
    """row_count, timestamp_null_count, other_session_row_count per file."""
    return ticks.groupBy(*FILE_KEYS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("timestamp").isNull()).alias("timestamp_null_count"),
        F.count_if(F.col("trade_date") != F.col("reference_date")).alias("other_session_row_count"),
    )


def provenance_rows(facts: DataFrame, verdicts: DataFrame, sources: DataFrame | None = None,
                    collector_version: str = "0", build_id: str | None = None,
                    created_at: Column | None = None) -> DataFrame:
    """Provenance record per published file (contract field order).

    ``sources`` optionally carries ``source_zip_name, source_zip_sha256,
    source_txt_name`` per file (archive scans); otherwise they are null.
    ``source_txt_row_count`` is the data-line count of the text scan, a
    different aggregate from ``row_count`` (the typed rows written).
    """
    ok = verdicts.where(F.col("status") == "OK").select(
        *FILE_KEYS, F.col("data_lines").alias("source_txt_row_count"))
    p = ok.join(facts, FILE_KEYS, "left")
    if sources is not None:
        p = p.join(sources.select(*FILE_KEYS, "source_zip_name", "source_zip_sha256",
                                  "source_txt_name"), FILE_KEYS, "left")
    else:
        p = (p.withColumn("source_zip_name", F.lit(None).cast("string"))
              .withColumn("source_zip_sha256", F.lit(None).cast("string"))
              .withColumn("source_txt_name", F.lit(None).cast("string")))
    created = created_at if created_at is not None else F.date_format(
        F.date_trunc("second", F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return p.select(
        *FILE_KEYS,
        F.date_format("file_date", "yyyy-MM-dd").alias("trade_date"),
        "source_zip_name", "source_zip_sha256", "source_txt_name",
        F.col("source_txt_row_count").cast("bigint").alias("source_txt_row_count"),
        F.lit(C.SCHEMA_VERSION).alias("schema_version"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.col("timestamp_null_count"), F.lit(0)).cast("bigint").alias("timestamp_null_count"),
        F.lit(C.TIMEZONE).alias("timezone"),
        F.lit(collector_version).alias("collector_version"),
        F.lit(build_id).cast("string").alias("collector_commit"),
        created.alias("created_at_utc"),
    )


def output_check(provenance: DataFrame) -> DataFrame:
    """VAL-8: files whose written rows differ from their data lines, or are zero."""
    return provenance.where(
        (F.col("row_count") != F.col("source_txt_row_count")) | (F.col("row_count") == 0)
    ).select(*FILE_KEYS, "row_count", "source_txt_row_count",
             F.when(F.col("row_count") == 0, "zero rows")
              .otherwise(F.format_string("row_count %d != source_txt_row_count %d",
                                         "row_count", "source_txt_row_count")).alias("problem"))


def unreadable_times(ticks: DataFrame, k: int = C.MAX_REPORTED_TIMES) -> DataFrame:
    """First ``k`` distinct unreadable ``time_raw`` values per file, by first line.

    The distinct step is a partial aggregate; the top-k window then sees one
    row per distinct bad value, and Spark's window group limit trims each
    partition to ``k`` rows per file before the shuffle.
    """
    from pyspark.sql import Window
    bad = ticks.where(F.col("timestamp").isNull())
    firsts = bad.groupBy(*FILE_KEYS, "time_raw").agg(
        F.min("source_row").alias("first_line"), F.count(F.lit(1)).alias("occurrences"))
    w = Window.partitionBy(*FILE_KEYS).orderBy("first_line")
    return firsts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def provenance_payload(prov: DataFrame) -> DataFrame:
    """``(feed, file_date, payload)``: the provenance record as a JSON object (FN-14)."""
    fields = [n for n, _ in C.PROVENANCE_FIELDS]
    return prov.select("feed", "file_date", F.to_json(F.struct(*fields)).alias("payload"))


def parse_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """JSON payload -> typed provenance struct ``prov`` plus ``payload_problem``:
    missing, not JSON, or incomplete (a required field is null)."""
    parsed = payloads.withColumn("prov", F.from_json(F.col(column), C.PROVENANCE_DDL))
    required = ["feed", "trade_date", "source_txt_row_count", "schema_version", "row_count"]
    incomplete = F.lit(False)
    for name in required:
        incomplete = incomplete | F.col(f"prov.{name}").isNull()
    problem = (F.when(F.col(column).isNull(), "missing")
                .when(F.col("prov").isNull() | ~F.col(column).rlike(r"^\s*\{"), "not JSON")
                .when(incomplete, "incomplete"))
    return parsed.withColumn("payload_problem", problem)
