"""Registered queries: Spark DataFrames over the driver tables, and the
equivalent oracle SQL for each.

Every query reads whole tables (no id subsets, no row caps); top-k limits
appear only where the report itself is a top-k (first blank lines, first
unreadable times).  Column names are aliased identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import convert, provenance, sessions, validate
from ..fixtures.rendered import tick_lines_from_events
from ..operators.layouts import is_perpetual
from ..fixtures.rendered import (btb_lines_from_lineitem, derivatives_lines_from_orders,
                                equities_lines_from_part)
from ..functions.calendar import is_business_day
from ..operators import reconcile, retention, runlog
from ..fixtures import derived as D
from ..session import checkpoint_dir
from ..sources.catalog import catalog
from ..sources.text import scan_lines
from . import oracle_ops as OO
from . import oracle_reports as OR
from . import oracle_ticks as OT
from . import registered_files
from .reports import archive_raw_lines, availability, parse_layout, read_raw_lines, read_report_by_dates
from .ticks import missing_ticks, process_lines, read_ticks, rebuild_report, run_log, write_ticks


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tick_batch(spark: SparkSession, sf_dir: str):
    lines = tick_lines_from_events(_table(spark, sf_dir, "events"))
    return lines, process_lines(lines)


def q_tick_verdicts(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    return b.verdicts.drop("message")


def q_ticks_typed(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    cols = [c if c != "timestamp" else convert.epoch_millis("timestamp").alias("timestamp_ms")
            for c in b.ticks.columns]
    return b.ticks.select(*cols)


def q_tick_provenance(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    return b.provenance.select("feed", "file_date", "trade_date", "source_txt_row_count",
                               "schema_version", "row_count", "timestamp_null_count", "timezone")


def q_tick_rebuild_report(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    return rebuild_report(b.verdicts, b.ticks)


def q_tick_blank_lines(spark, sf_dir):
    lines, _ = _tick_batch(spark, sf_dir)
    return validate.first_blank_lines(lines).select("feed", "file_date", "rank", "source_row")


def q_tick_unreadable_times(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    return provenance.unreadable_times(b.ticks).select(
        "feed", "file_date", "time_raw", "first_line", "occurrences", "rank")


def q_tick_code_counts(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    return sessions.daily_code_counts(b.ticks)


def q_tick_sessions(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    cal = sessions.file_calendar(b.verdicts.where(F.col("status") == "OK"))
    return sessions.session_summary(b.ticks, cal)


def q_tick_bars(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    bars = sessions.bars(b.ticks, "minute")
    return bars.select("feed", "symbol", F.unix_millis("bar_start").alias("bar_start_ms"),
                       "open", "high", "low", "close", "volume", "n_trades")


def _bars(unit: str):
    def query(spark, sf_dir):
        _, b = _tick_batch(spark, sf_dir)
        return sessions.bars(b.ticks, unit).select(
            "feed", "symbol", F.unix_millis("bar_start").alias("bar_start_ms"),
            "open", "high", "low", "close", "volume", "n_trades")
    return query


# Business days that the lake queries read back.
TICK_RANGE = ("2024-01-08", "2024-01-26")
REPORT_RANGE = ("1995-03-01", "1996-08-30")


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _tick_lake(spark, sf_dir) -> str:
    """A lake written in two batches (odd, then even days), the second one twice."""
    lake = _scratch(spark, "tick-lake")
    lines = tick_lines_from_events(_table(spark, sf_dir, "events"))
    for parity, skip in ((1, False), (0, False), (0, True)):
        batch = process_lines(lines.where(F.dayofmonth("file_date") % 2 == parity))
        write_ticks(batch, lake, skip_existing=skip)
    return lake


def q_tick_lake_range(spark, sf_dir):
    lake = _tick_lake(spark, sf_dir)
    back = [read_ticks(spark, lake, feed, TICK_RANGE).withColumn("feed", F.lit(feed)) for feed in ("RV", "DERIV")]
    return back[0].union(back[1]).groupBy("feed", F.to_date("reference_date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").cast("bigint").alias("volume"),
        F.max("source_row").alias("last_row"))


def q_tick_lake_missing(spark, sf_dir):
    lake = _tick_lake(spark, sf_dir)
    gone = [missing_ticks(spark, lake, feed, TICK_RANGE).select(F.lit(feed).alias("feed"), "file_date")
            for feed in ("RV", "DERIV")]
    return gone[0].union(gone[1])


def _report_lake(spark, sf_dir):
    """The lending report's rows and missing dates, read from lines landed in two batches."""
    root = _scratch(spark, "report-lake")
    lines = btb_lines_from_lineitem(_table(spark, sf_dir, "lineitem")).withColumns(
        {"section": F.lit("lending"), "api_name": F.lit("BTBLoanBalance")})
    for parity, skip in ((1, False), (0, False), (0, True)):
        archive_raw_lines(lines.where(F.dayofmonth("report_date") % 2 == parity), root, skip_existing=skip)
    return read_report_by_dates(spark, read_raw_lines(spark, root), "BTBLoanBalance", REPORT_RANGE)


def q_report_lake_rows(spark, sf_dir):
    return _report_lake(spark, sf_dir)[0].groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("assets_quantity").alias("assets"), F.max("line_no").alias("last_line"))


def q_report_lake_missing(spark, sf_dir):
    return _report_lake(spark, sf_dir)[1]


def q_text_line_numbers(spark, sf_dir):
    """Text files written from ``orders``, a blank line here and there, numbered by the text source."""
    root = _scratch(spark, "text-lines")
    line = F.when(F.col("o_orderkey") % 37 == 0, "").otherwise(
        F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"))
    (_table(spark, sf_dir, "orders").withColumn("file_year", F.year("o_orderdate"))
     .repartition("file_year").sortWithinPartitions("file_year", "o_orderkey").select("file_year", line.alias("value"))
     .write.partitionBy("file_year").text(root))
    return scan_lines(spark, root, "UTF-8").select(
        F.regexp_extract("path", "file_year=([0-9]+)", 1).cast("int").alias("file_year"), "line_no", "line")


def q_tick_run_lines(spark, sf_dir):
    """The run summary of a batch, from its own run log."""
    _, b = _tick_batch(spark, sf_dir)
    return runlog.summary_lines(run_log(b)).select("part", "feed", "trade_date", "line")


def q_tick_payload_roundtrip(spark, sf_dir):
    _, b = _tick_batch(spark, sf_dir)
    parsed = provenance.parse_payload(provenance.provenance_payload(b.provenance))
    return parsed.select("feed", "file_date", "prov.trade_date", "prov.source_txt_row_count", "prov.row_count",
                         "prov.timezone", F.coalesce("payload_problem", F.lit("")).alias("payload_problem"))


def q_output_check(spark, sf_dir):
    facts = D.ticks_facts_from_lineitem(_table(spark, sf_dir, "lineitem"))
    return provenance.output_check(facts)


def q_fully_archived(spark, sf_dir):
    archived, ticks = _archive(spark, sf_dir)
    return reconcile.fully_archived(archived, archived, ticks)


def q_rebuild_plan_business(spark, sf_dir):
    archived, ticks = _archive(spark, sf_dir)
    requested = ticks.where(is_business_day(F.col("file_date"))).select("feed", "file_date")
    return reconcile.rebuild_plan(requested, archived, ticks.where("has_provenance"), D.CURRENT_BUILD, dry_run=True)


def q_duplicate_events(spark, sf_dir):
    keyed = _table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("ship_date"), "l_partkey")
    return reconcile.duplicate_keys(keyed, "ship_date", "l_partkey")


def q_report_availability(spark, sf_dir):
    inv = _table(spark, sf_dir, "documents").select("source", F.octet_length("text").cast("bigint").alias("length"))
    return availability(inv).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if("available").alias("n_available"),
        F.count_if(F.col("status") == runlog.UNAVAILABLE).alias("n_unavailable"))


def _btb(spark, sf_dir):
    return parse_layout(btb_lines_from_lineitem(_table(spark, sf_dir, "lineitem")), "BTBLoanBalance")


def _equities(spark, sf_dir):
    return parse_layout(equities_lines_from_part(_table(spark, sf_dir, "part")), "InstrumentsEquities")


def q_report_btb_rows(spark, sf_dir):
    return _btb(spark, sf_dir)[0]


def q_report_btb_verdicts(spark, sf_dir):
    return _btb(spark, sf_dir)[1]


def q_report_equities_rows(spark, sf_dir):
    return _equities(spark, sf_dir)[0]


def q_report_equities_verdicts(spark, sf_dir):
    return _equities(spark, sf_dir)[1]


def _derivatives(spark, sf_dir):
    return parse_layout(derivatives_lines_from_orders(_table(spark, sf_dir, "orders")),
                        "InstrumentsDerivatives")


def q_report_derivatives_rows(spark, sf_dir):
    return _derivatives(spark, sf_dir)[0]


def q_report_derivatives_verdicts(spark, sf_dir):
    return _derivatives(spark, sf_dir)[1]


def q_report_equities_perpetual(spark, sf_dir):
    rows = _equities(spark, sf_dir)[0]
    return rows.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_instruments"),
        F.count_if(is_perpetual("expiration_date")).alias("n_perpetual"),
        F.count_if(F.col("expiration_date").isNull()).alias("n_no_expiration"))


def _archive(spark, sf_dir):
    listing = D.archive_listing_from_orders(_table(spark, sf_dir, "orders"))
    archived = reconcile.archived_dates(listing)
    ticks = D.ticks_facts_from_lineitem(_table(spark, sf_dir, "lineitem"))
    return archived, ticks


def q_archive_dates(spark, sf_dir):
    return _archive(spark, sf_dir)[0]


def q_archive_verify(spark, sf_dir):
    archived, ticks = _archive(spark, sf_dir)
    return reconcile.verify(archived, ticks)


def q_archive_verify_counts(spark, sf_dir):
    archived, ticks = _archive(spark, sf_dir)
    return reconcile.verify_counts(archived, ticks, reconcile.verify(archived, ticks))


def _plan(spark, sf_dir):
    archived, ticks = _archive(spark, sf_dir)
    requested = ticks.select("feed", "file_date")
    prov = ticks.where(F.col("has_provenance"))
    return reconcile.rebuild_plan(requested, archived, prov, D.CURRENT_BUILD, dry_run=True)


def q_rebuild_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


def q_rebuild_histogram(spark, sf_dir):
    return reconcile.status_histogram(_plan(spark, sf_dir))


def _retention(spark, sf_dir):
    files = D.local_files_from_documents(_table(spark, sf_dir, "documents"))
    keys = D.archive_keys_from_files(files)
    today = F.lit(D.RETENTION_TODAY).cast("date")
    return retention.decide(files.drop("_archived"), keys, today, D.RETENTION_DAYS)


def q_retention_decisions(spark, sf_dir):
    return _retention(spark, sf_dir).select("doc_id", "feed", "kind", "file_date", "decision")


def q_retention_summary(spark, sf_dir):
    return retention.summary(_retention(spark, sf_dir))


def _date_results(spark, sf_dir):
    r = D.date_results_from_orders(_table(spark, sf_dir, "orders"))
    return r.withColumn("error", runlog.accumulate_errors(F.col("_e1"), F.col("_e2"), F.col("_e3")))


def q_run_date_summary(spark, sf_dir):
    r = _date_results(spark, sf_dir).withColumn("run_year", F.year("trade_date"))
    return runlog.date_summary(r, ["run_year"])


def q_run_failures(spark, sf_dir):
    f = runlog.failures(_date_results(spark, sf_dir))
    return f.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n_failed"),
                                       F.min("error").alias("first_error"))


def _report_results(spark, sf_dir):
    r = D.report_results_from_orders(_table(spark, sf_dir, "orders"))
    status = F.when(F.col("unavailable"), runlog.UNAVAILABLE).otherwise(
        runlog.report_status(F.col("upload_status")))
    cat = F.broadcast(catalog(spark).select(F.col("api_name").alias("report_name"), "section"))
    return r.withColumn("status", status).join(cat, "report_name", "inner")


def q_run_report_summary(spark, sf_dir):
    return runlog.report_summary(_report_results(spark, sf_dir), ["section"])


def q_report_lateness(spark, sf_dir):
    r = D.report_results_from_orders(_table(spark, sf_dir, "orders"))
    late = runlog.late_reports(r.withColumnRenamed("report_name", "api_name")
                                .withColumnRenamed("trade_date", "report_date"), catalog(spark))
    return late.groupBy("api_name").agg(F.count(F.lit(1)).alias("n_arrivals"),
                                        F.count_if("late").alias("n_late"))


def q_report_fanout(spark, sf_dir):
    from .reports import catalog_fanout
    days = (_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
            .where(is_business_day(F.col("d"))))
    tasks = catalog_fanout(spark, days)
    return tasks.groupBy(F.year("d").alias("run_year"), "section").agg(
        F.count(F.lit(1)).alias("n_tasks"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tick_verdicts": q_tick_verdicts,
    "ticks_typed": q_ticks_typed,
    "tick_provenance": q_tick_provenance,
    "tick_rebuild_report": q_tick_rebuild_report,
    "tick_blank_lines": q_tick_blank_lines,
    "tick_unreadable_times": q_tick_unreadable_times,
    "tick_code_counts": q_tick_code_counts,
    "tick_sessions": q_tick_sessions,
    "tick_bars": q_tick_bars,
    "tick_bars_hour": _bars("hour"),
    "tick_bars_day": _bars("day"),
    "tick_lake_range": q_tick_lake_range,
    "tick_lake_missing": q_tick_lake_missing,
    "report_lake_rows": q_report_lake_rows,
    "report_lake_missing": q_report_lake_missing,
    "text_line_numbers": q_text_line_numbers,
    "tick_run_lines": q_tick_run_lines,
    "tick_payload_roundtrip": q_tick_payload_roundtrip,
    "output_check": q_output_check,
    "fully_archived": q_fully_archived,
    "rebuild_plan_business": q_rebuild_plan_business,
    "duplicate_keys": q_duplicate_events,
    "report_availability": q_report_availability,
    "report_btb_rows": q_report_btb_rows,
    "report_btb_verdicts": q_report_btb_verdicts,
    "report_equities_rows": q_report_equities_rows,
    "report_equities_verdicts": q_report_equities_verdicts,
    "report_equities_perpetual": q_report_equities_perpetual,
    "report_derivatives_rows": q_report_derivatives_rows,
    "report_derivatives_verdicts": q_report_derivatives_verdicts,
    "archive_dates": q_archive_dates,
    "archive_verify": q_archive_verify,
    "archive_verify_counts": q_archive_verify_counts,
    "rebuild_plan": q_rebuild_plan,
    "rebuild_histogram": q_rebuild_histogram,
    "retention_decisions": q_retention_decisions,
    "retention_summary": q_retention_summary,
    "run_date_summary": q_run_date_summary,
    "run_failures": q_run_failures,
    "run_report_summary": q_run_report_summary,
    "report_lateness": q_report_lateness,
    "report_fanout": q_report_fanout,
}

QUERIES |= registered_files.QUERIES

ORACLE_SQL: dict[str, str] = registered_files.ORACLE_SQL | {
    "tick_verdicts": OT.TICK_VERDICTS,
    "ticks_typed": OT.TICKS_TYPED,
    "tick_provenance": OT.TICK_PROVENANCE,
    "tick_rebuild_report": OT.TICK_REBUILD_REPORT,
    "tick_blank_lines": OT.TICK_BLANK_LINES,
    "tick_unreadable_times": OT.TICK_UNREADABLE_TIMES,
    "tick_code_counts": OT.TICK_CODE_COUNTS,
    "tick_sessions": OT.TICK_SESSIONS,
    "tick_bars": OT.TICK_BARS,
    "tick_bars_hour": OT.TICK_BARS_HOUR,
    "tick_bars_day": OT.TICK_BARS_DAY,
    "tick_lake_range": OT.TICK_LAKE_RANGE,
    "tick_lake_missing": OT.TICK_LAKE_MISSING,
    "report_lake_rows": OR.BTB_LAKE_ROWS,
    "report_lake_missing": OR.BTB_LAKE_MISSING,
    "text_line_numbers": OR.TEXT_LINE_NUMBERS,
    "tick_run_lines": OT.TICK_RUN_LINES,
    "tick_payload_roundtrip": OT.TICK_PAYLOAD_ROUNDTRIP,
    "output_check": OO.OUTPUT_CHECK,
    "fully_archived": OO.FULLY_ARCHIVED,
    "rebuild_plan_business": OO.REBUILD_PLAN_BUSINESS,
    "duplicate_keys": OO.DUPLICATE_KEYS,
    "report_availability": OO.REPORT_AVAILABILITY,
    "report_btb_rows": OR.BTB_ROWS,
    "report_btb_verdicts": OR.BTB_VERDICTS,
    "report_equities_rows": OR.EQ_ROWS,
    "report_equities_verdicts": OR.EQ_VERDICTS,
    "report_equities_perpetual": OR.EQ_PERPETUAL,
    "report_derivatives_rows": OR.DV_ROWS,
    "report_derivatives_verdicts": OR.DV_VERDICTS,
    "archive_dates": OO.ARCHIVE_DATES,
    "archive_verify": OO.ARCHIVE_VERIFY,
    "archive_verify_counts": OO.ARCHIVE_VERIFY_COUNTS,
    "rebuild_plan": OO.REBUILD_PLAN,
    "rebuild_histogram": OO.REBUILD_HISTOGRAM,
    "retention_decisions": OO.RETENTION_DECISIONS,
    "retention_summary": OO.RETENTION_SUMMARY,
    "run_date_summary": OO.RUN_DATE_SUMMARY,
    "run_failures": OO.RUN_FAILURES,
    "run_report_summary": OO.RUN_REPORT_SUMMARY,
    "report_lateness": OO.REPORT_LATENESS,
    "report_fanout": OO.REPORT_FANOUT,
}
