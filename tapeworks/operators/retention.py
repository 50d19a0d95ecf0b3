"""Retention decision for locally kept files (the deletion itself is not built).

Priority per file: name not parseable -> ``ignored``; date on/after the
cutoff -> ``recent``; raw intermediate -> ``delete`` (no archive check);
archive check failed -> ``error`` (kept); not in the archive ->
``kept_missing_in_archive``; otherwise ``delete``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DECISIONS = ("ignored", "recent", "delete", "error", "kept_missing_in_archive")


def cutoff(today: Column, retention_days: int) -> Column:
    if retention_days < 0:
        raise ValueError(f"retention_days must be >= 0, got {retention_days}")
    return F.date_sub(today, retention_days)


def decide(files: DataFrame, archive_keys: DataFrame, today: Column, retention_days: int) -> DataFrame:
    """One decision per local file.

    ``files``: ``(feed, kind, name, file_date?, length, archive_key?,
    check_failed)`` where ``kind`` is ``raw``, ``zip`` or ``ticks`` and
    ``file_date`` is null when the name does not parse.
    ``archive_keys``: ``(archive_key)`` present in the archive; the join is
    on the derived key (JOIN-7).
    """
    present = archive_keys.select("archive_key", F.lit(True).alias("_in_archive")).distinct()
    j = files.join(present, "archive_key", "left")
    cut = cutoff(today, retention_days)
    decision = (F.when(F.col("file_date").isNull(), "ignored")
                 .when(F.col("file_date") >= cut, "recent")
                 .when(F.col("kind") == "raw", "delete")
                 .when(F.col("check_failed"), "error")
                 .when(F.col("_in_archive").isNull(), "kept_missing_in_archive")
                 .otherwise("delete"))
    return j.withColumn("decision", decision).drop("_in_archive")


def summary(decisions: DataFrame) -> DataFrame:
    """Counters per feed: deleted, kept missing in archive, ignored, errors, freed bytes/MB."""
    # by decision first: the decision is computed once per file, not once per counter
    per = decisions.groupBy("feed", "decision").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))

    def total(value: str, column: str = "n") -> Column:
        return F.sum(F.when(F.col("decision") == value, F.col(column)).otherwise(F.lit(0))).cast("bigint")

    return per.groupBy("feed").agg(
        total("delete").alias("deleted"),
        total("kept_missing_in_archive").alias("kept_missing_in_archive"),
        total("ignored").alias("ignored"),
        total("error").alias("errors"),
        total("delete", "bytes").alias("freed_bytes"),
    ).withColumn("freed_mb", F.round(F.col("freed_bytes") / F.lit(1048576.0), 1))
