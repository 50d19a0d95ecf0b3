"""Incremental ingestion of newly landed archives with Structured Streaming.

The landing folder is a streaming ``binaryFile`` source; the checkpoint
remembers which files were processed, so a re-run (``availableNow``) picks
up only new archives.  Each micro-batch runs the batch job - validate,
convert, write ticks and provenance with dynamic partition overwrite - so a
replayed batch rewrites the same (feed, date) partitions with the same
content (idempotent), and the verdicts of every batch go to a
quarantine/verdict table (also keyed by feed and date).  No state store is needed: every archive is
independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.reports import archive_raw_lines, availability, report_lines_from_binary
from ..plans.ticks import process_archive_frame, write_ticks
from ..session import cut_lineage, temporary_tables
from ..sources.archives import BINARY_FILE_SCHEMA


def archive_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing)


def ingest_new_archives(spark: SparkSession, landing: str, lake: str, checkpoint: str,
                        build_id: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None):
    """Start (and, with ``available_now``, finish) an incremental ingest run.

    ``checkpoint`` must be a durable shared folder.  Returns the query.
    """

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        with temporary_tables():  # a micro-batch leaves no working tables behind
            b = process_archive_frame(batch, build_id=build_id)
            write_ticks(b, lake)
            # keyed by (feed, date) with dynamic overwrite: a replayed batch
            # rewrites the same verdict partitions instead of duplicating them
            (b.verdicts.withColumn("epoch_id", F.lit(epoch_id))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("feed", "file_date").parquet(f"{lake}/verdicts"))

    writer = (archive_stream(spark, landing, max_files_per_trigger).writeStream
              .foreachBatch(each_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def ingest_new_reports(spark: SparkSession, landing: str, lake: str, checkpoint: str,
                       skip_existing: bool = True, available_now: bool = True):
    """Land the raw lines of report files that arrived since the last run.

    ``landing`` holds ``{section}/{api}/year=Y/Y-M-D.csv``.  Payloads too
    short to be a report are left out (they are "no report today").  A
    report-date that is already landed is kept unless ``skip_existing`` is
    off; either way a replayed batch ends in the same lines.
    """

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        real = availability(batch).where("available")
        with temporary_tables():
            lines = cut_lineage(report_lines_from_binary(real))
            archive_raw_lines(lines, f"{lake}/reports", skip_existing=skip_existing)

    query = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(landing)
             .writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
             .trigger(**({"availableNow": True} if available_now else {"processingTime": "1 minute"})).start())
    if available_now:
        query.awaitTermination()
    return query
