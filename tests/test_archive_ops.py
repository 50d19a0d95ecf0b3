"""Date lists, name parsing, verification, rebuild plans, retention, run logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import keys as K
from tapeworks.functions.calendar import resolve_dates
from tapeworks.operators import reconcile, retention, runlog

D = dt.date


def test_resolve_dates(spark):
    assert resolve_dates(spark, "2026-06-30") == [D(2026, 6, 30)]
    # list: explicit, sorted, unique, weekends kept
    assert resolve_dates(spark, ["2026-07-04", "2026-06-30", "2026-06-30"]) == [D(2026, 6, 30), D(2026, 7, 4)]
    # tuple: inclusive business-day range (Fri..Mon drops the weekend)
    assert resolve_dates(spark, ("2026-07-03", "2026-07-06")) == [D(2026, 7, 3), D(2026, 7, 6)]
    assert resolve_dates(spark, ("2026-07-04", "2026-07-05")) == []
    with pytest.raises(ValueError):
        resolve_dates(spark, ("2026-07-03", "2026-07-04", "2026-07-05"))
    with pytest.raises(TypeError):
        resolve_dates(spark, 20260703)


def test_archive_names_round_trip(spark):
    df = spark.createDataFrame([("RV", D(2026, 6, 30)), ("DERIV", D(2026, 6, 30))], "feed string, d date")
    got = df.select(K.archive_name(F.col("feed"), F.col("d")).alias("n"),
                    K.ticks_key(F.col("feed"), F.col("d")).alias("k")).collect()
    assert [r.n for r in got] == ["20260630_NEGOCIOSAVISTA.zip", "30-06-2026_NEGOCIOSAVISTA_DRV.zip"]
    assert got[0].k == "b3/tick_by_tick/rv/ticks/year=2026/2026-06-30.parquet"
    inv = spark.createDataFrame([("s3://b/x/20260630_NEGOCIOSAVISTA.zip",),
                                 ("s3://b/x/30-06-2026_NEGOCIOSAVISTA_DRV.zip",),
                                 ("s3://b/x/20260230_NEGOCIOSAVISTA.zip",),  # not a date
                                 ("s3://b/x/notes.txt",)], "path string")
    got = sorted((r.feed, r.file_date) for r in reconcile.archived_dates(inv).collect())
    assert got == [("DERIV", D(2026, 6, 30)), ("RV", D(2026, 6, 30))]


def test_verify_messages_in_order(spark):
    archived = spark.createDataFrame([("RV", D(2026, 6, d)) for d in (1, 2, 3, 4)], "feed string, file_date date")
    ticks = spark.createDataFrame([
        ("RV", D(2026, 6, 1), False, None, None, None, None),   # pre-contract
        ("RV", D(2026, 6, 3), True, 1, True, 10, 10),          # ok
        ("RV", D(2026, 6, 4), True, 1, True, 10, 11),          # count mismatch
        ("RV", D(2026, 5, 30), True, 1, True, 5, 5),           # orphan
    ], "feed string, file_date date, has_provenance boolean, schema_version int, "
       "schema_matches boolean, row_count bigint, source_txt_row_count bigint")
    got = [(str(r.file_date), r.problem) for r in reconcile.verify(archived, ticks).orderBy("ord").collect()]
    assert got == [("2026-05-30", reconcile.ORPHAN),
                   ("2026-06-01", reconcile.NO_PROVENANCE),
                   ("2026-06-02", reconcile.NO_TICKS),
                   ("2026-06-04", "row_count 10 != source_txt_row_count 11")]


def test_rebuild_plan_skip_force_dirty(spark):
    req = spark.createDataFrame([("RV", D(2026, 6, d)) for d in (1, 2, 3)], "feed string, file_date date")
    archived = req.where(F.col("file_date") != D(2026, 6, 3))
    prov = spark.createDataFrame([("RV", D(2026, 6, 1), "abc", 1), ("RV", D(2026, 6, 2), "old", 1)],
                                 "feed string, file_date date, collector_commit string, schema_version int")
    plan = {str(r.file_date): r.status for r in
            reconcile.rebuild_plan(req, archived, prov, "abc", dry_run=True).collect()}
    assert plan == {"2026-06-01": "SKIPPED", "2026-06-02": "WOULD_RUN", "2026-06-03": "FAILED"}
    forced = {r.status for r in reconcile.rebuild_plan(req, archived, prov, "abc", force=True)
              .where(F.col("file_date") == D(2026, 6, 1)).collect()}
    assert forced == {"RUN"}
    dirty = reconcile.rebuild_plan(req, archived, prov, "abc+dirty").where(
        F.col("file_date") == D(2026, 6, 1)).first()
    assert dirty.status == "RUN" and dirty.total == 3 and dirty.position == 1


def test_retention_cutoff_and_archive_check(spark):
    files = spark.createDataFrame([
        (1, "RV", "zip", D(2026, 10, 26), 100, "k1", False),   # old, archived -> delete
        (2, "RV", "zip", D(2026, 10, 27), 100, "k2", False),   # on cutoff -> kept
        (3, "RV", "ticks", D(2026, 10, 1), 50, "k3", False),   # not archived -> kept
        (4, "RV", "raw", D(2026, 10, 1), 70, None, False),     # raw -> delete without check
        (5, "RV", "zip", None, 10, None, False),               # stranger -> ignored
        (6, "RV", "ticks", D(2026, 10, 1), 10, "k6", True),    # check failed -> error
    ], "id int, feed string, kind string, file_date date, length bigint, archive_key string, check_failed boolean")
    keys = spark.createDataFrame([("k1",), ("k6",)], "archive_key string")
    dec = retention.decide(files, keys, F.lit("2026-11-24").cast("date"), 28)
    got = {r.id: r.decision for r in dec.collect()}
    assert got == {1: "delete", 2: "recent", 3: "kept_missing_in_archive", 4: "delete",
                   5: "ignored", 6: "error"}
    s = retention.summary(dec).first()
    assert (s.deleted, s.kept_missing_in_archive, s.ignored, s.errors, s.freed_bytes) == (2, 1, 1, 1, 170)
    with pytest.raises(ValueError):
        retention.decide(files, keys, F.current_date(), -1)


def test_run_summaries_two_dialects(spark):
    dates = spark.createDataFrame([
        ("SUCCESS", None), ("UNAVAILABLE", "download: unavailable"), ("SUCCESS", "extract: bad"),
    ], "download string, error string").withColumn("started", F.lit(dt.datetime(2026, 1, 1, 10)).cast("timestamp_ntz")) \
        .withColumn("finished", F.lit(dt.datetime(2026, 1, 1, 10, 0, 30)).cast("timestamp_ntz"))
    s = runlog.date_summary(dates).first()
    assert (s.total, s.succeeded, s.failed, s.unavailable, s.duration_s) == (3, 1, 2, 1, 30)
    reports = spark.createDataFrame([("SUCCESS",), ("UNAVAILABLE",), ("SKIPPED",), ("FAILED",)], "status string")
    r = runlog.report_summary(reports).first()
    assert (r.total, r.succeeded, r.skipped, r.unavailable, r.failed) == (4, 1, 1, 1, 1)
    m = spark.createDataFrame([("SUCCESS",), ("SKIPPED",), ("WEIRD",)], "u string").select(
        runlog.report_status(F.col("u")).alias("s"))
    assert [x.s for x in m.collect()] == ["SUCCESS", "SKIPPED", "FAILED"]
    e = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string").select(
        runlog.accumulate_errors(F.col("x"), F.col("y"), F.col("z")).alias("e"))
    assert [x.e for x in e.collect()] == ["a; c", None]
