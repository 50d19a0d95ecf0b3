"""Tick ingestion as one Spark job: lines -> verdicts -> typed ticks -> sinks.

Shape of the physical plan: the line scan feeds (a) one partially
aggregated shuffle keyed by file for the verdicts (a few hundred bytes per
file) and (b) the typed projection of accepted files, semi-joined against
the OK verdicts (AQE broadcasts them when small), then one shuffle keyed
by (feed, file_date) to lay files out on write.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.calendar import date_filter, dates_frame
from ..operators import convert, provenance, validate
from ..session import cut_lineage
from . import lake


# Lines per output file inside one (feed, date) partition directory.
ROWS_PER_FILE = 1_000_000


@dataclass
class TickBatch:
    """Verdicts and typed ticks of a set of files, and what is derived from them.

    ``facts`` (counts per file) is one pass over the typed ticks, done when it
    is first asked for and materialised: provenance, reports and the run log
    share it.  :func:`write_ticks` sets it from the files it wrote, without
    that pass.
    """

    verdicts: DataFrame
    ticks: DataFrame  # feed, file_date + 14 contract columns
    sources: DataFrame | None = None
    collector_version: str = "0"
    build_id: str | None = None

    @cached_property
    def facts(self) -> DataFrame:
        return cut_lineage(provenance.tick_facts(self.ticks))

    @cached_property
    def provenance(self) -> DataFrame:
        return provenance.provenance_rows(self.facts, self.verdicts, self.sources,
                                          self.collector_version, self.build_id)


def process_lines(lines: DataFrame, files: DataFrame | None = None,
                  sources: DataFrame | None = None, build_id: str | None = None,
                  collector_version: str = "0") -> TickBatch:
    """Verdicts, typed ticks and provenance for a lines DataFrame.

    Verdicts (one row per file) are materialised once in the checkpoint
    folder: the full pass over the lines that produces them runs once, and
    every consumer (routing, provenance, reports) reads a small table.
    """
    verdicts = cut_lineage(validate.file_verdicts(lines, files))
    ticks = convert.typed_ticks(validate.accepted_lines(lines, verdicts))
    return TickBatch(verdicts, ticks, sources, collector_version, build_id)


def empty_batch(spark: SparkSession) -> TickBatch:
    """A batch without files (a run with nothing to do)."""
    none = spark.createDataFrame([], "feed string, file_date date, source_row int, line string")
    return process_lines(none)


def rebuild_report(verdicts: DataFrame, ticks: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """One row per file: OK with counts, or FAILED with the violation.

    ``facts``: a batch's counts if it has them already.
    """
    facts = provenance.tick_facts(ticks) if facts is None else facts
    r = verdicts.join(facts, validate.FILE_KEYS, "left")
    ok = F.col("status") == "OK"
    return r.select(
        "feed", "file_date",
        F.date_format("file_date", "yyyy-MM-dd").alias("trade_date"),
        F.when(ok, "OK").otherwise("FAILED").alias("status"),
        F.when(ok, F.col("row_count")).alias("row_count"),
        F.when(ok, F.col("timestamp_null_count")).alias("timestamp_null_count"),
        F.when(ok, F.coalesce(F.col("other_session_row_count"), F.lit(0)))
         .alias("other_session_row_count"),
        F.when(ok, F.lit("")).otherwise(F.col("message")).alias("error"),
    )


# --- Sinks ---

def write_ticks(batch: TickBatch, root: str, skip_existing: bool = False) -> DataFrame:
    """Publish ticks and their provenance under ``root``, in one commit (see :mod:`.lake`).

    Layout: ``ticks/feed=/year=/file_date=`` (``file_date`` copies
    ``reference_date``, which stays inside the files; a day of more than
    :data:`ROWS_PER_FILE` lines is written as several files) and
    ``provenance/feed=/year=/file_date=``.  Only the (feed, date) partitions
    of this batch are replaced, every other date stays, and a date rejected
    now keeps its previous output.  ``skip_existing`` leaves already
    published dates untouched.  A failure at any step leaves what was
    published before, whole.

    The source is read once: the counts of provenance, run log and session
    summary come from the files as written.  A file whose typed rows are not
    as many as its data lines, or none, is not published; returns those files
    with the problem (VAL-8).
    """
    spark = batch.ticks.sparkSession
    ticks, published = batch.ticks, lake.current(spark, root)
    done = None
    if skip_existing and published is not None:
        done = cut_lineage(published.select(*validate.FILE_KEYS))
        ticks = ticks.join(done, validate.FILE_KEYS, "left_anti")
    # A hot day must not land in one writer task: each (feed, date) is cut
    # into chunks of consecutive lines, written as separate files of the same
    # partition directory, each in TXT order (source_row recovers the whole).
    chunk = F.floor(F.col("source_row") / F.lit(ROWS_PER_FILE))
    out = (ticks.withColumn("year", F.year("file_date"))
                .repartition("feed", "file_date", chunk)
                .sortWithinPartitions("feed", "file_date", "source_row")
                .select("feed", "year", "file_date", *C.CONTRACT_COLUMNS))
    made = lake.Generation(spark, root)
    facts, sessions = made.measure(made.stage(out, "ticks"))
    if done is None:  # else the batch holds more files than were written
        batch.facts = facts
    prov = (batch.provenance if "provenance" in batch.__dict__ or done is None else provenance.provenance_rows(
        facts, batch.verdicts, batch.sources, batch.collector_version, batch.build_id))
    if done is not None:
        prov = prov.join(done, validate.FILE_KEYS, "left_anti")
    prov = cut_lineage(prov)
    refused = cut_lineage(provenance.output_check(prov))
    prov = prov.join(refused, validate.FILE_KEYS, "left_anti")
    made.stage(prov.withColumn("year", F.year("file_date")).repartition("feed", "file_date"), "provenance")
    kept = facts.join(prov, validate.FILE_KEYS, "left_semi")
    dates = kept.select(*validate.FILE_KEYS).collect()  # a row per date of the batch
    if dates:
        made.move("ticks", {lake.date_folder(r.feed, r.file_date) for r in refused.collect()})
        made.move("provenance", set())
        before = made.superseded(kept.select(*validate.FILE_KEYS))
        made.commit(kept, sessions)
        made.clean(dates, before)
    return refused


def existing_provenance(spark: SparkSession, root: str) -> DataFrame | None:
    """The published provenance; None if nothing is published yet.  Other failures are raised."""
    return lake.published_provenance(spark, root, PROVENANCE_SCHEMA)


PROVENANCE_SCHEMA = ("trade_date string, source_zip_name string, source_zip_sha256 string, "
                     "source_txt_name string, source_txt_row_count bigint, schema_version int, "
                     "row_count bigint, timestamp_null_count bigint, timezone string, "
                     "collector_version string, collector_commit string, created_at_utc string, "
                     "feed string, year int, file_date date")


def read_ticks(spark: SparkSession, root: str, feed: str, dates) -> DataFrame:
    """Ticks of ``feed`` for calendar *file* dates (not sessions), contract order.

    ``dates`` follows the date contract: a date or ISO text, a list, or a
    (start, end) tuple of business days, ends included.  The last commits say
    which files hold those dates (a row per date asked for reaches the
    driver, as a path does for Spark's own listing); no others are opened.
    Dates without ticks are simply absent; :func:`missing_ticks` names them.
    """
    published = lake.current(spark, root)
    asked = [] if published is None else published.where(
        (F.col("feed") == feed) & date_filter(F.col("file_date"), dates)).select("feed", "file_date", "generation").collect()
    if not asked:
        return spark.createDataFrame([], C.CONTRACT_SCHEMA)
    df = spark.read.schema(lake.TICKS_SCHEMA).option("basePath", f"{root}/ticks").parquet(*lake.tick_paths(root, asked))
    return df.where((F.col("feed") == feed) & date_filter(F.col("file_date"), dates)).select(*C.CONTRACT_COLUMNS)


def missing_ticks(spark: SparkSession, root: str, feed: str, dates) -> DataFrame:
    """``(file_date)``: requested dates of ``feed`` that are not published."""
    wanted = dates_frame(spark, dates).withColumnRenamed("d", "file_date")
    done = existing_provenance(spark, root)
    if done is None:
        return wanted
    have = done.where((F.col("feed") == feed) & date_filter(F.col("file_date"), dates))
    return wanted.join(have.select("file_date"), "file_date", "left_anti")


# --- Archive and text entry points ---

def merge_archive_problems(verdicts: DataFrame, problems: DataFrame) -> DataFrame:
    """Source-level problems (no/multiple TXT, unreadable or several archives) win over line rules."""
    p = problems.select("feed", "file_date", F.col("rule").alias("_arule"),
                        F.col("candidates").alias("_cands"))
    v = verdicts.join(p, validate.FILE_KEYS, "left")
    bad = F.col("_arule").isNotNull()
    return v.select(
        "feed", "file_date",
        F.when(bad, "REJECTED").otherwise(F.col("status")).alias("status"),
        F.when(bad, F.col("_arule")).otherwise(F.col("rule")).alias("rule"),
        F.when(bad, "archive").otherwise(F.col("source_column")).alias("source_column"),
        F.when(bad, F.lit(1).cast("bigint")).otherwise(F.col("invalid_count")).alias("invalid_count"),
        F.when(bad, F.lit(None).cast("int")).otherwise(F.col("first_line")).alias("first_line"),
        F.when(bad, F.col("_cands")).otherwise(F.col("first_value")).alias("first_value"),
        "data_lines", "blank_lines",
        F.when(bad, F.format_string("archive: %s [%s]", F.col("_arule"), F.col("_cands")))
         .otherwise(F.col("message")).alias("message"),
    )


def process_archives(spark: SparkSession, location: str, build_id: str | None = None,
                     collector_version: str = "0") -> TickBatch:
    """Validate and convert every tick archive under ``location``."""
    from ..sources import archives
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
           .option("recursiveFileLookup", "true").load(location))
    return process_archive_frame(raw, build_id, collector_version)


def process_archive_frame(raw: DataFrame, build_id: str | None = None,
                          collector_version: str = "0") -> TickBatch:
    """Validate and convert the archives of a ``binaryFile`` DataFrame.

    The archives are unpacked once, into a table in the shared checkpoint
    folder that every branch reads; no executor holds a copy of its own.
    """
    from ..sources import archives
    scan = cut_lineage(archives.scan_archive_frame(raw))
    problems = cut_lineage(archives.archive_problems(scan))
    lines = archives.archive_lines(scan)
    verdicts = validate.file_verdicts(lines, problems.select("feed", "file_date"),
                                      problems.select("feed", "file_date", "n_lines"))
    verdicts = cut_lineage(merge_archive_problems(verdicts, problems))
    ticks = convert.typed_ticks(validate.accepted_lines(lines, verdicts))
    return TickBatch(verdicts, ticks, problems, collector_version, build_id)


def process_text(spark: SparkSession, paths, build_id: str | None = None) -> TickBatch:
    """Validate and convert unzipped tick TXT files (splittable, numbered in parallel)."""
    from ..sources.text import tick_files, tick_line_counts, tick_lines_from_text
    lines = tick_lines_from_text(spark, paths).drop("path")
    files = cut_lineage(tick_files(spark, paths))
    verdicts = validate.file_verdicts(lines, files, tick_line_counts(spark, paths))
    verdicts = cut_lineage(merge_archive_problems(verdicts, files))
    ticks = convert.typed_ticks(validate.accepted_lines(lines, verdicts))
    return TickBatch(verdicts, ticks, files, build_id=build_id)


def write_rebuild_report(report: DataFrame, path: str) -> None:
    """Rebuild report as CSV with a header, one row per feed and date (SNK-5).

    The report is one row per file, so a single output file is bounded.
    ``seconds`` is the wall time of the run that did the date; a report
    without it gets 0.
    """
    cols = ["feed", "trade_date", "status", "row_count", "timestamp_null_count",
            "other_session_row_count", "seconds", "error"]
    if "seconds" not in report.columns:
        report = report.withColumn("seconds", F.lit(0.0))
    (report.select(*cols).orderBy("feed", "trade_date").coalesce(1)
           .write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
           .option("ignoreTrailingWhiteSpace", False).csv(path))  # texts as they are


def run_log(batch: TickBatch, started=None, finished=None, refused: DataFrame | None = None,
            missing: DataFrame | None = None, skipped: DataFrame | None = None,
            archives_published: DataFrame | None = None, ticks_published: DataFrame | None = None) -> DataFrame:
    """Date-level run rows (RUN-2): stage statuses, tick count, error and times.

    * a file that was read: ``download`` SUCCESS, ``extract`` by its verdict,
      ``partition`` SUCCESS unless the sink refused it (``refused``, as
      :func:`write_ticks` returns it);
    * upload stages: the outcome of :func:`.publish.publish` over the archives
      and over the ticks, if there was one, else as the write went.  A failed
      upload of the archive stops nothing; its error comes first, then that of
      a later stage, then that of the ticks;
    * ``missing`` (feed, file_date): no archive - ``download`` UNAVAILABLE;
    * ``skipped`` (feed, file_date): both artifacts were there - all stages SKIPPED.

    ``started`` and ``finished`` are the run's wall-clock times.
    """
    from ..operators import runlog
    facts = batch.facts.select("feed", "file_date", "row_count")
    v = batch.verdicts.join(facts, validate.FILE_KEYS, "left")
    if refused is None:
        v = v.withColumn("problem", F.lit(None).cast("string"))
    else:
        v = v.join(refused.select(*validate.FILE_KEYS, "problem"), validate.FILE_KEYS, "left")
    for name, outcome in (("_zip", archives_published), ("_out", ticks_published)):
        if outcome is None:
            v = v.withColumns({name: F.lit(None).cast("string"), f"{name}_error": F.lit(None).cast("string")})
        else:
            v = v.join(outcome.select(*validate.FILE_KEYS, F.col("status").alias(name), F.col("error").alias(f"{name}_error")),
                       validate.FILE_KEYS, "left")
    ok = F.col("status") == "OK"
    written = ok & F.col("problem").isNull()
    now = F.current_timestamp().cast("timestamp_ntz")
    t0 = now if started is None else F.lit(started).cast("timestamp_ntz")
    t1 = t0 if finished is None else F.lit(finished).cast("timestamp_ntz")

    def row(df: DataFrame, download, extract, partition, archive_upload, ticks_upload, ticks, error) -> DataFrame:
        stages = dict(zip(runlog.STAGES, (download, extract, partition, archive_upload, ticks_upload), strict=True))
        return df.select(
            "feed", F.col("file_date").alias("trade_date"), *[runlog.checked(c).alias(n) for n, c in stages.items()],
            ticks.cast("bigint").alias("tick_count"), error.alias("error"), t0.alias("started"), t1.alias("finished"))

    success, failed, skip, none = (F.lit(x) for x in (runlog.SUCCESS, runlog.FAILED, runlog.SKIPPED, None))
    out = row(v, success, F.when(ok, success).otherwise(failed),
              F.when(written, success).when(ok, failed).otherwise(skip),
              F.coalesce(F.col("_zip"), skip) if archives_published is not None else F.when(written, success).otherwise(skip),
              F.when(written, F.coalesce(F.col("_out"), skip if ticks_published is not None else success)).otherwise(skip),
              F.when(written, F.coalesce(F.col("row_count"), F.lit(0))),
              runlog.accumulate_errors(F.when(F.col("_zip") == runlog.FAILED, F.concat(F.lit("archive upload: "), F.col("_zip_error"))),
                                       F.when(~ok, F.concat(F.lit("extract: "), F.col("message"))),
                                       F.when(ok & ~written, F.concat(F.lit("partition: "), F.col("problem"))),
                                       F.when(written & (F.col("_out") == runlog.FAILED),
                                              F.concat(F.lit("ticks upload: "), F.col("_out_error")))))
    if missing is not None:
        out = out.unionByName(row(missing, F.lit(runlog.UNAVAILABLE), skip, skip, skip, skip, none,
                                  F.lit("download: no archive for the date")))
    if skipped is not None:
        out = out.unionByName(row(skipped, skip, skip, skip, skip, skip, none, none.cast("string")))
    return out
