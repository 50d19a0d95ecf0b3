"""Run bookkeeping: stage statuses, error accumulation and run summaries.

Two summary dialects exist and are kept apart on purpose:

* date-level (tick runs): ``succeeded`` = no error, ``failed`` = error,
  ``unavailable`` counts ``download = UNAVAILABLE`` independently of the
  error (an unavailable date is normally also failed);
* report-level: ``UNAVAILABLE`` is its own outcome, not a failure, and
  ``succeeded`` counts only ``SUCCESS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: status vocabulary and upload->report status mapping ---
SUCCESS, SKIPPED, UNAVAILABLE, FAILED = "SUCCESS", "SKIPPED", "UNAVAILABLE", "FAILED"
STAGE_STATUSES = (SUCCESS, SKIPPED, UNAVAILABLE, FAILED)
STAGES = ("download", "extract", "partition", "s3_upload", "ticks_s3_upload")
UPLOAD_TO_REPORT = {SUCCESS: SUCCESS, SKIPPED: SKIPPED}


def valid_status(c: Column) -> Column:
    """Check constraint on a status column."""
    return c.isin(*STAGE_STATUSES)


def checked(c: Column) -> Column:
    """The status itself; a value outside the vocabulary fails the job instead of entering the log."""
    return F.when(valid_status(c), c).otherwise(
        F.raise_error(F.concat(F.lit("not a stage status: "), F.coalesce(c.cast("string"), F.lit("null")))))


def report_status(upload_status: Column) -> Column:
    """Upload outcome -> report outcome; anything unmapped is FAILED."""
    m = F.create_map(*[F.lit(x) for kv in UPLOAD_TO_REPORT.items() for x in kv])
    return F.coalesce(m[upload_status], F.lit(FAILED))


def accumulate_errors(*stage_errors: Column) -> Column:
    """``'a; b'`` in stage order, skipping stages without an error; null if none."""
    joined = F.concat_ws("; ", *stage_errors)
    return F.when(joined != "", joined)


def date_summary(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG-4 over date-level results (``download``, ``error``, ``started``, ``finished``)."""
    by = by or []
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count_if(F.col("download") == UNAVAILABLE).alias("unavailable"),
        F.timestamp_diff("SECOND", F.min("started"), F.max("finished")).alias("duration_s"),
    )


def report_summary(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG-5 over report-level results (``status``)."""
    by = by or []
    s = F.col("status")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == SUCCESS).alias("succeeded"),
        F.count_if(s == SKIPPED).alias("skipped"),
        F.count_if(s == UNAVAILABLE).alias("unavailable"),
        F.count_if(s == FAILED).alias("failed"),
    )


def failures(results: DataFrame, status_col: str | None = None) -> DataFrame:
    """Only the failed rows (RUN-4)."""
    if status_col:
        return results.where(F.col(status_col) == FAILED)
    return results.where(F.col("error").isNotNull())


def summary_line(total: Column, succeeded: Column, failed: Column) -> Column:
    """Formatted one-line summary (FN-20)."""
    return F.format_string("%s dates: %s ok, %s failed", F.format_number(total, 0),
                           F.format_number(succeeded, 0), F.format_number(failed, 0))


def summary_lines(results: DataFrame) -> DataFrame:
    """The run's report as rows ``(part, feed, trade_date, line)`` (FN-20).

    Part 1 counts the outcomes, part 2 has a line per date (stages and
    ticks), part 3 a line per failure; ordered by part, feed and date they
    are the text of a run summary.  Nothing is gathered: a row per line.
    """
    s = date_summary(results)
    heads = F.array(*[F.struct(F.lit(i).alias("_n"), line.alias("line")) for i, line in enumerate((
        F.format_string("Dates processed : %d", "total"), F.format_string("Succeeded       : %d", "succeeded"),
        F.format_string("Failed          : %d", "failed"), F.format_string("Unavailable     : %d", "unavailable")))])
    none = F.lit(None)
    head = s.select(F.inline(heads)).select(
        F.lit(1).alias("part"), none.cast("string").alias("feed"), none.cast("date").alias("trade_date"),
        F.concat(F.lit("  "), F.col("line")).alias("line"))
    stages = F.concat_ws(" ", *[F.rpad(F.concat(F.lit(f"{name}="), F.col(name)), len(name) + 12, " ") for name in STAGES])
    per = results.select(
        F.lit(2).alias("part"), "feed", "trade_date",
        F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit("  "), stages, F.lit(" ticks="),
                 F.coalesce(F.format_number("tick_count", 0), F.lit("-"))).alias("line"))
    bad = failures(results).select(
        F.lit(3).alias("part"), "feed", "trade_date",
        F.concat(F.lit("    "), F.date_format("trade_date", "yyyy-MM-dd"), F.lit(": "), "error").alias("line"))
    return head.union(per).union(bad)


def late_reports(arrivals: DataFrame, catalog: DataFrame) -> DataFrame:
    """Arrivals later than the catalog SLA (RUN-5); blank SLA is never late.

    ``arrivals``: ``(api_name, report_date, arrived_at TIMESTAMP_NTZ)`` in
    exchange wall time.  The catalog side is 63 rows.
    """
    c = F.broadcast(catalog.select("api_name", "sla_time"))
    j = arrivals.join(c, "api_name", "inner")
    arrival_tod = F.date_format("arrived_at", "HH:mm:ss")
    return j.withColumn("late", F.coalesce(arrival_tod > F.col("sla_time"), F.lit(False)))
