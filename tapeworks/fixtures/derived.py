"""Archive listings, provenance facts, local files and run results derived
from the driver tables (inputs of the reconciliation, retention and run-log
queries).  Every rule here is mirrored by the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..sources.catalog import CATALOG

ARCHIVE_ROOT = "archive/"
CURRENT_BUILD = "build-A"


def archive_listing_from_orders(orders: DataFrame) -> DataFrame:
    """Object listing of archived ZIPs: one per order's (feed, date), plus strangers."""
    feed = F.when(F.col("o_orderkey") % 2 == 0, "RV").otherwise("DERIV")
    d = F.to_date("o_orderdate")
    zip_path = F.concat(F.lit(ARCHIVE_ROOT), K.archive_key(feed, d))
    stranger = F.concat(F.lit(ARCHIVE_ROOT + "b3/bdi/tick_by_tick_rv/notes_"),
                        F.col("o_orderkey").cast("string"), F.lit(".txt"))
    path = F.when(F.col("o_orderkey") % 500 == 0, stranger).otherwise(zip_path)
    return orders.select(path.alias("path")).distinct()


def ticks_facts_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One ticks file per (feed, ship date) with the facts its footer would carry."""
    li = lineitem.select(
        F.when(F.col("l_linenumber") % 2 == 0, "RV").otherwise("DERIV").alias("feed"),
        F.to_date("l_shipdate").alias("file_date"), "l_orderkey")
    agg = li.groupBy("feed", "file_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_orderkey").alias("_keysum"))
    day = F.dayofmonth("file_date")
    return agg.select(
        "feed", "file_date",
        (day != 29).alias("has_provenance"),
        F.when(day == 13, 0).otherwise(1).alias("schema_version"),
        (day != 31).alias("schema_matches"),
        F.col("row_count").cast("bigint").alias("row_count"),
        (F.col("row_count") + F.when(F.col("_keysum") % 7 == 0, 1).otherwise(0))
        .cast("bigint").alias("source_txt_row_count"),
        F.when(day % 5 == 0, "build-B").when(day % 7 == 0, F.lit(None))
         .when(day % 11 == 0, CURRENT_BUILD + "+dirty").otherwise(CURRENT_BUILD)
         .alias("collector_commit"),
    )


RETENTION_TODAY = "2024-02-20"
RETENTION_DAYS = 28


def local_files_from_documents(documents: DataFrame) -> DataFrame:
    """Local files (raw Parquet, ZIP, ticks) named from document ids; some strangers."""
    doc = F.col("doc_id")
    feed = F.when(doc % 2 == 0, "RV").otherwise("DERIV")
    d = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 60).cast("int"))
    kind = F.when(doc % 3 == 0, "raw").when(doc % 3 == 1, "zip").otherwise("ticks")
    iso_name = F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(".parquet"))
    name = (F.when(doc % 50 == 0, F.concat(F.lit("notes_"), doc.cast("string"), F.lit(".txt")))
             .when(kind == "zip", K.archive_name(feed, d)).otherwise(iso_name))
    f = documents.select("doc_id", feed.alias("feed"), kind.alias("kind"), name.alias("name"),
                         F.col("n_chars").cast("bigint").alias("length"),
                         (doc % 23 == 0).alias("check_failed"),
                         (doc % 7 != 0).alias("_archived"))
    parsed = (F.when(F.col("kind") == "zip",
                     F.coalesce(K.name_date(F.col("name"), "RV"), K.name_date(F.col("name"), "DERIV")))
               .otherwise(K.ticks_name_date(F.col("name"))))
    f = _once(_once(f).withColumn("file_date", parsed))
    key = (F.when(F.col("file_date").isNull() | (F.col("kind") == "raw"), F.lit(None))
            .when(F.col("kind") == "zip", K.archive_key(F.col("feed"), F.col("file_date")))
            .otherwise(K.ticks_key(F.col("feed"), F.col("file_date"))))
    return _once(f.withColumn("archive_key", key))


def _once(df: DataFrame) -> DataFrame:
    """A step whose columns are computed once: nothing above an explode is inlined below it."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def archive_keys_from_files(files: DataFrame) -> DataFrame:
    return files.where(F.col("_archived") & F.col("archive_key").isNotNull()).select("archive_key")


def date_results_from_orders(orders: DataFrame) -> DataFrame:
    """Date-level run results: five stage statuses, accumulated error, timings."""
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    download = F.when(st == "F", "SUCCESS").when(st == "O", "SKIPPED").otherwise("UNAVAILABLE")
    extract = F.when(st == "P", "SKIPPED").when(k % 17 == 0, "FAILED").otherwise("SUCCESS")
    upload = F.when(k % 13 == 0, "FAILED").otherwise("SUCCESS")
    started = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 3600).cast("int"))
    dur = (F.floor("o_totalprice").cast("bigint") % 600).cast("int")
    return orders.select(
        F.to_date("o_orderdate").alias("trade_date"),
        download.alias("download"), extract.alias("extract"),
        F.when(extract == "SUCCESS", "SUCCESS").otherwise("SKIPPED").alias("partition"),
        upload.alias("s3_upload"),
        F.when(extract == "SUCCESS", "SUCCESS").otherwise("SKIPPED").alias("ticks_s3_upload"),
        F.when(extract == "SUCCESS", (k % 1000).cast("bigint")).alias("tick_count"),
        F.when(st == "P", "download: unavailable").alias("_e1"),
        F.when(extract == "FAILED", "extract: contract violation").alias("_e2"),
        F.when(upload == "FAILED", "upload: archive publish failed").alias("_e3"),
        started.alias("started"),
        (started + F.make_dt_interval(secs=dur)).alias("finished"),
    )


def report_results_from_orders(orders: DataFrame) -> DataFrame:
    """Report-level run results: report chosen by key over the catalog order."""
    names = F.array(*[F.lit(r[0]) for r in CATALOG])
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    upload = F.when(k % 19 == 0, "ERROR").when(st == "F", "SUCCESS").otherwise("SKIPPED")
    return orders.select(
        F.get(names, (k % len(CATALOG)).cast("int")).alias("report_name"),
        F.to_date("o_orderdate").alias("trade_date"),
        upload.alias("upload_status"),
        (st == "P").alias("unavailable"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=((k * 37) % 86400).cast("int")))
        .alias("arrived_at"),
    )
