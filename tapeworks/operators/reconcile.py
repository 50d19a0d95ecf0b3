"""Archive reconciliation: inventories, conformance verification, rebuild plans.

All inputs are small per-file tables (one row per archive, ticks file or
provenance record) - joins between them are ordinary equi-joins that AQE
broadcasts when they are small, and never touch tick rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.keys import archive_name_date, basename, ticks_name_date

# --- Fixed values: verification messages and rebuild statuses ---
NO_TICKS = "no ticks Parquet"
NO_PROVENANCE = "pre-contract file (no provenance)"
SCHEMA_DIFFERS = "schema differs from the contract"
ORPHAN = "ticks Parquet without archived ZIP"
NO_ARCHIVE = "no archived ZIP in S3"
STATUS_OK, STATUS_FAILED, STATUS_SKIPPED, STATUS_WOULD_RUN = "OK", "FAILED", "SKIPPED", "WOULD_RUN"


def archived_dates(inventory: DataFrame) -> DataFrame:
    """Distinct ``(feed, file_date)`` of archive names; strangers are ignored."""
    names = inventory.select(basename(F.col("path")).alias("_name"))
    feed, file_date = archive_name_date(F.col("_name"))
    # strangers become an empty (null) array and vanish in the explode; a
    # Generate, unlike a Filter, keeps the parse in one projection with
    # common subexpressions computed once
    keep = F.when(file_date.isNotNull(), F.array(F.struct(feed, file_date)))
    return names.select(F.inline(keep)).distinct()


def ticks_dates(inventory: DataFrame, feed_col: str = "feed") -> DataFrame:
    """Distinct ``(feed, file_date)`` of ``YYYY-MM-DD.parquet`` ticks files."""
    d = ticks_name_date(basename(F.col("path")))
    keep = F.when(d.isNotNull(), F.array(F.struct(F.col(feed_col).alias("feed"), d.alias("file_date"))))
    return inventory.select(F.inline(keep)).distinct()


def verify_problem(ticks_present: Column, prov_present: Column, schema_version: Column,
                   schema_matches: Column, row_count: Column, source_rows: Column) -> Column:
    """First failing conformance check of one archived date, or null when OK."""
    return (F.when(~ticks_present, F.lit(NO_TICKS))
             .when(~prov_present, F.lit(NO_PROVENANCE))
             .when(F.coalesce(schema_version != C.SCHEMA_VERSION, F.lit(True)),
                   F.concat(F.lit("schema_version "), F.coalesce(schema_version.cast("string"),
                                                                  F.lit("None"))))
             .when(~F.coalesce(schema_matches, F.lit(False)), F.lit(SCHEMA_DIFFERS))
             .when(F.coalesce(row_count != source_rows, F.lit(True)),
                   F.format_string("row_count %s != source_txt_row_count %s",
                                   F.coalesce(row_count.cast("string"), F.lit("None")),
                                   F.coalesce(source_rows.cast("string"), F.lit("None")))))


def verify(archived: DataFrame, ticks: DataFrame) -> DataFrame:
    """Conformance problems of an archive (VER-1/VER-2).

    ``archived``: ``(feed, file_date)`` with a source archive.
    ``ticks``: ``(feed, file_date, has_provenance, schema_version,
    schema_matches, row_count, source_txt_row_count)``, one per ticks file.
    Returns ``(feed, file_date, kind, problem, ord)`` - ``kind`` is
    ``orphan`` (ticks without archive) or ``archived``; ``ord`` orders the
    messages per feed: orphans by date first, then archived dates.
    """
    a = archived.select("feed", "file_date", F.lit(True).alias("_a"))
    t = ticks.withColumn("_t", F.lit(True))
    j = a.join(t, ["feed", "file_date"], "full_outer")
    orphan = F.col("_a").isNull()
    problem = F.when(orphan, F.lit(ORPHAN)).otherwise(verify_problem(
        F.col("_t").isNotNull(), F.coalesce(F.col("has_provenance"), F.lit(False)),
        F.col("schema_version"), F.col("schema_matches"), F.col("row_count"),
        F.col("source_txt_row_count")))
    out = j.select("feed", "file_date",
                   F.when(orphan, "orphan").otherwise("archived").alias("kind"),
                   problem.alias("problem"))
    out = out.where(F.col("problem").isNotNull())
    w = Window.partitionBy("feed").orderBy(F.col("kind").desc(), "file_date")
    return out.withColumn("ord", F.row_number().over(w))


def verify_counts(archived: DataFrame, ticks: DataFrame, problems: DataFrame) -> DataFrame:
    """Per feed: archived dates, ticks files and problems (AGG-12)."""
    a = archived.groupBy("feed").agg(F.count(F.lit(1)).alias("archived"))
    t = ticks.groupBy("feed").agg(F.count(F.lit(1)).alias("ticks_files"))
    p = problems.groupBy("feed").agg(F.count(F.lit(1)).alias("problems"))
    return (a.join(t, "feed", "full_outer").join(p, "feed", "full_outer")
             .fillna(0, ["archived", "ticks_files", "problems"]))


def rebuild_plan(requested: DataFrame, archived: DataFrame, provenance: DataFrame,
                 build_id: str | None, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Per requested (feed, date): FAILED / SKIPPED / WOULD_RUN / RUN.

    * no archived ZIP -> FAILED with the reason;
    * written by this build (same id, not a dirty build) with the current
      schema version, and not ``force`` -> SKIPPED;
    * otherwise WOULD_RUN on a dry run, RUN when the plan is executed.

    ``position``/``total`` number the dates of each feed in date order (the
    window runs over the plan - one row per date - never over ticks).
    """
    req = requested.select("feed", "file_date").distinct()
    a = archived.select("feed", "file_date", F.lit(True).alias("_archived"))
    p = provenance.select("feed", "file_date", F.col("collector_commit").alias("_commit"),
                          F.col("schema_version").alias("_version"))
    j = req.join(a, ["feed", "file_date"], "left").join(p, ["feed", "file_date"], "left")
    clean_build = build_id is not None and not build_id.endswith("+dirty")
    same = (F.lit(clean_build) & (F.col("_commit") == F.lit(build_id))
            & (F.col("_version") == C.SCHEMA_VERSION))
    status = (F.when(F.col("_archived").isNull(), STATUS_FAILED)
               .when(F.lit(not force) & F.coalesce(same, F.lit(False)), STATUS_SKIPPED)
               .otherwise(STATUS_WOULD_RUN if dry_run else "RUN"))
    w = Window.partitionBy("feed").orderBy("file_date")
    wall = Window.partitionBy("feed")
    return j.select(
        "feed", "file_date", status.alias("status"),
        F.when(F.col("_archived").isNull(), F.lit(NO_ARCHIVE)).otherwise(F.lit("")).alias("error"),
        F.row_number().over(w).alias("position"),
        F.count(F.lit(1)).over(wall).alias("total"),
    )


def fully_archived(feed_dates: DataFrame, archived: DataFrame, ticks: DataFrame) -> DataFrame:
    """Feed-dates that have both the archive and the ticks file (stage-0 skip)."""
    return (feed_dates.join(archived.select("feed", "file_date"), ["feed", "file_date"], "left_semi")
                      .join(ticks.select("feed", "file_date"), ["feed", "file_date"], "left_semi"))


def status_histogram(plan: DataFrame) -> DataFrame:
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def verify_ok(problems: DataFrame) -> bool:
    """Exit status of a verification run: True when there is no problem (VER-4)."""
    return problems.isEmpty()


def duplicate_keys(dim: DataFrame, *keys: str) -> DataFrame:
    """Keys that appear more than once in a dimension (SET-4); empty when unique."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
