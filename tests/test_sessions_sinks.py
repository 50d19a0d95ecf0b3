"""Bars keep TXT order inside a millisecond; session windows; output checks; CSV report."""

import datetime as dt

from pyspark.sql import functions as F

from tapeworks.operators import provenance, sessions
from tapeworks.plans.ticks import write_rebuild_report

D = dt.date


def _ticks(spark, rows):
    df = spark.createDataFrame(rows, "feed string, file_date date, source_row int, symbol string, "
                                     "ts string, price double, quantity bigint, update_action smallint, "
                                     "trade_date string, reference_date string")
    return df.withColumn("timestamp", F.to_timestamp("ts")).drop("ts")


def test_bars_break_ties_by_source_row_not_trade_id(spark):
    t = _ticks(spark, [
        ("RV", D(2026, 6, 30), 4, "A", "2026-06-30 13:00:00.006", 10.0, 1, 0, "2026-06-30", "2026-06-30"),
        ("RV", D(2026, 6, 30), 2, "A", "2026-06-30 13:00:00.006", 11.0, 1, 0, "2026-06-30", "2026-06-30"),
        ("RV", D(2026, 6, 30), 3, "A", "2026-06-30 13:00:00.006", 12.0, 1, 0, "2026-06-30", "2026-06-30"),
        ("RV", D(2026, 6, 30), 5, "A", "2026-06-30 13:00:59.000", 9.0, 2, 2, "2026-06-30", "2026-06-30"),
    ])
    b = sessions.bars(t).first()
    # cancelled trade (update_action 2) excluded; same-ms trades ordered by line
    assert (b.open, b.close, b.high, b.low, b.volume, b.n_trades) == (11.0, 10.0, 12.0, 10.0, 3, 3)


def test_session_windows_and_files_to_read(spark):
    files = spark.createDataFrame([("DERIV", D(2026, 11, d)) for d in (18, 19, 23)], "feed string, file_date date")
    cal = sessions.file_calendar(files)
    wanted = spark.createDataFrame([("DERIV", D(2026, 11, 19))], "feed string, session_date date")
    got = sorted(r.file_date for r in sessions.files_for_sessions(cal, wanted).collect())
    assert got == [D(2026, 11, 18), D(2026, 11, 19), D(2026, 11, 23)]
    t = _ticks(spark, [
        ("DERIV", D(2026, 11, 18), 2, "X", "2026-11-18 17:00:00", 1.0, 5, 0, "2026-11-19", "2026-11-18"),
        ("DERIV", D(2026, 11, 19), 2, "X", "2026-11-19 10:00:00", 1.0, 7, 0, "2026-11-19", "2026-11-19"),
        ("DERIV", D(2026, 11, 23), 2, "X", "2026-11-23 02:29:00", 1.0, 9, 0, "2026-11-19", "2026-11-23"),
        ("DERIV", D(2026, 11, 23), 3, "X", "2026-11-23 10:00:00", 1.0, 1, 0, "2026-11-23", "2026-11-23"),
    ])
    s = {r.session_date: r for r in sessions.session_summary(t, cal).collect()}
    r = s[D(2026, 11, 19)]
    assert (r.n_trades, r.from_previous_file, r.from_own_file, r.from_next_file, r.volume) == (3, 1, 1, 1, 21)
    assert sessions.off_session(t).count() == 2 and sessions.own_session(t).count() == 2


def test_output_check_and_report_csv(spark, tmp_path):
    prov = spark.createDataFrame([("RV", D(2026, 6, 30), 3, 3), ("RV", D(2026, 7, 1), 3, 4),
                                  ("RV", D(2026, 7, 2), 0, 0)],
                                 "feed string, file_date date, row_count bigint, source_txt_row_count bigint")
    got = {str(r.file_date): r.problem for r in provenance.output_check(prov).collect()}
    assert got == {"2026-07-01": "row_count 3 != source_txt_row_count 4", "2026-07-02": "zero rows"}
    report = spark.createDataFrame(
        [("RV", "2026-06-30", "OK", 3, 0, 1, ""), ("DERIV", "2026-06-30", "FAILED", None, None, None, "bad")],
        "feed string, trade_date string, status string, row_count bigint, timestamp_null_count bigint, "
        "other_session_row_count bigint, error string")
    write_rebuild_report(report, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert back.columns[0] == "feed" and back.count() == 2


def test_hour_and_day_bars_in_exchange_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        # 02:30 and 02:59 UTC are the evening before in the exchange's zone
        rows = [(2, "2026-06-30 02:30:00", 5.0), (3, "2026-06-30 02:59:59.999", 6.0), (4, "2026-06-30 03:00:00", 0.0),
                (5, "2026-06-30 20:00:00", 9.0), (6, "2026-06-30 15:00:00", 7.0), (7, "2026-07-01 02:59:59", 3.0)]
        df = spark.createDataFrame([("RV", D(2026, 6, 30), n, "A", t, p, 1, 0, "2026-06-30", "2026-06-30") for n, t, p in rows],
                                   "feed string, file_date date, source_row int, symbol string, ts string, price double, "
                                   "quantity bigint, update_action smallint, trade_date string, reference_date string")
        t = df.withColumn("timestamp", F.to_utc_timestamp(F.to_timestamp("ts"), "UTC")
                          + F.expr("INTERVAL 9 HOURS")).drop("ts")
        got = {r.ms: (r.open, r.close) for r in sessions.bars(t, "day").select(
            F.unix_millis("bar_start").alias("ms"), "open", "close").collect()}
        utc = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
        assert got == {utc(2026, 6, 29, 3): (5.0, 6.0), utc(2026, 6, 30, 3): (0.0, 3.0)}
        assert sessions.bars(t, "hour").count() == 5
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_every_trade_is_in_a_session_or_outside(spark):
    cal = sessions.file_calendar(spark.createDataFrame([("RV", D(2026, 6, 30))], "feed string, file_date date"))
    t = _ticks(spark, [
        ("RV", D(2026, 6, 30), 2, "A", "2026-06-30 13:00:00", 1.0, 1, 0, "2026-06-30", "2026-06-30"),
        ("RV", D(2026, 6, 30), 3, "A", "2026-06-30 13:00:00", 1.0, 1, 0, "2026-07-15", "2026-06-30")])
    s = {r.session_date: r for r in sessions.session_summary(t, cal).collect()}
    assert s[D(2026, 6, 30)].from_own_file == 1 and s[D(2026, 6, 30)].outside_window == 0
    assert s[D(2026, 7, 15)].outside_window == 1
