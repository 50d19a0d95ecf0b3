"""Incremental ingest: a re-run picks up only newly landed archives."""

from pyspark.sql import functions as F

from tapeworks.streaming.incremental import ingest_new_archives
from tests.conftest import tick_line, tick_text, txt_name, write_zip


def test_available_now_processes_only_new_files(spark, tmp_path):
    landing, lake, ckpt = (str(tmp_path / d) for d in ("landing", "lake", "ckpt"))
    (tmp_path / "landing").mkdir()
    for day in ("2026-06-29", "2026-06-30"):
        write_zip(landing, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * 2)})
    ingest_new_archives(spark, landing, lake, ckpt, build_id="b1")
    prov = spark.read.parquet(f"{lake}/provenance")
    assert prov.count() == 2
    epochs1 = {r.epoch_id for r in spark.read.parquet(f"{lake}/verdicts").collect()}

    bad_day = "2026-07-01"
    write_zip(landing, "DERIV", bad_day,
              {txt_name("DERIV", bad_day): tick_text([tick_line(ref=bad_day, price="x")])})
    ingest_new_archives(spark, landing, lake, ckpt, build_id="b1")
    v = spark.read.parquet(f"{lake}/verdicts")
    new = v.where(~F.col("epoch_id").isin(*epochs1)).collect()
    assert [(r.feed, str(r.file_date), r.status) for r in new] == [("DERIV", bad_day, "REJECTED")]
    assert spark.read.parquet(f"{lake}/provenance").count() == 2   # rejected date not published
    assert spark.read.parquet(f"{lake}/ticks").count() == 4


def test_second_run_keeps_the_first_days_provenance(spark, tmp_path):
    landing, lake, ckpt = (str(tmp_path / d) for d in ("landing", "lake", "ckpt"))
    (tmp_path / "landing").mkdir()
    for day in ("2026-06-29", "2026-06-30"):
        write_zip(landing, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * 2)})
        ingest_new_archives(spark, landing, lake, ckpt, build_id="b1")
    prov = spark.read.parquet(f"{lake}/provenance")
    assert sorted(str(r.file_date) for r in prov.collect()) == ["2026-06-29", "2026-06-30"]
    assert spark.read.parquet(f"{lake}/ticks").count() == 4


def test_reports_land_once_and_keep_other_days(spark, tmp_path):
    from tapeworks.plans.reports import read_raw_lines
    from tapeworks.streaming.incremental import ingest_new_reports
    landing, lake, ckpt = (str(tmp_path / d) for d in ("landing", "lake", "ckpt"))
    folder = tmp_path / "landing" / "lending" / "BTBLoanBalance" / "year=2026"
    folder.mkdir(parents=True)

    def land(day, data, name=None):
        (folder / (name or f"2026-06-{day}.csv")).write_bytes(data)
        ingest_new_reports(spark, landing, lake, ckpt)
        return sorted((r.report_date.day, r.line_no, r.line) for r in read_raw_lines(spark, f"{lake}/reports").collect())

    first = [(29, 1, "título;x"), (29, 2, ""), (29, 3, "a;b")]
    assert land(29, "\ufefftítulo;x\r\n\r\na;b\r\n".encode()) == first
    both = first + [(30, 1, "next;day"), (30, 2, "c;d;e")]
    assert land(30, b"next;day\nc;d;e") == both
    assert land(31, b"short") == both  # no report today
    (folder / "2026-06-29.csv").unlink()
    again = tmp_path / "landing" / "again" / "lending" / "BTBLoanBalance" / "year=2026"
    again.mkdir(parents=True)
    (again / "2026-06-30.csv").write_bytes(b"another version of the day")
    ingest_new_reports(spark, landing, lake, ckpt)
    assert sorted((r.report_date.day, r.line_no, r.line) for r in read_raw_lines(spark, f"{lake}/reports").collect()) == both


# --- Sessions as a stream over commits ---

def _session_lake(spark, tmp_path, lake, days):
    """Publishes files one by one; ``days``: (file date, [(session, quantity), ...])."""
    from tapeworks.plans.ticks import process_archives, write_ticks
    for i, (day, trades) in enumerate(days):
        folder = tmp_path / f"z{i}-{day}-{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        lines = [tick_line(ref=day, trade_date=s, qty=str(q)) for s, q in trades]
        write_zip(str(folder), "RV", day, {txt_name("RV", day): tick_text(lines)})
        write_ticks(process_archives(spark, str(folder)), lake)


def _batch_sessions(spark, lake):
    from tapeworks.operators import sessions
    from tapeworks.plans.lake import current
    ticks = spark.read.parquet(f"{lake}/ticks")
    cal = sessions.file_calendar(current(spark, lake).select("feed", "file_date"))
    return {str(r.session_date): tuple(r)[2:] for r in sessions.session_summary(ticks, cal).select(
        "feed", "session_date", "n_trades", "from_previous_file", "from_own_file", "from_next_file", "outside_window",
        "volume").collect()}


def _stream_sessions(spark, lake):
    from tapeworks.streaming.sessions import read_sessions
    return {str(r.session_date): (r.n_trades, r.from_previous_file, r.from_own_file, r.from_next_file, r.outside_window, r.volume)
            for r in read_sessions(spark, lake).collect()}


FILES = [("2026-06-26", [("2026-06-26", 1), ("2026-06-29", 2)]),       # an early trade of the 29th
         ("2026-06-29", [("2026-06-29", 4), ("2026-06-26", 8)]),       # a late trade of the 26th
         ("2026-07-01", [("2026-07-01", 16), ("2026-06-29", 32), ("2026-06-26", 64), ("2026-07-20", 128)])]


def test_stream_equals_batch_as_files_come(spark, tmp_path):
    from tapeworks.streaming.sessions import run_session_stream
    lake, ckpt = str(tmp_path / "lake"), str(tmp_path / "ckpt")
    _session_lake(spark, tmp_path, lake, FILES[:1])
    run_session_stream(spark, lake, ckpt)
    assert not (tmp_path / "lake" / "sessions").exists() or _stream_sessions(spark, lake) == {}  # no later file yet
    _session_lake(spark, tmp_path, lake, FILES[1:2])
    run_session_stream(spark, lake, ckpt)
    assert set(_stream_sessions(spark, lake)) == {"2026-06-26"}
    _session_lake(spark, tmp_path, lake, FILES[2:])
    run_session_stream(spark, lake, ckpt)
    got, want = _stream_sessions(spark, lake), _batch_sessions(spark, lake)
    assert set(got) == {"2026-06-26", "2026-06-29"} and all(got[d] == want[d] for d in got)
    # a file between two known ones, and a rebuilt one, change sessions that were emitted
    _session_lake(spark, tmp_path, lake, [("2026-06-30", [("2026-06-30", 3), ("2026-06-29", 5)]),
                                          ("2026-06-26", [("2026-06-26", 7)])])
    run_session_stream(spark, lake, ckpt)
    got, want = _stream_sessions(spark, lake), _batch_sessions(spark, lake)
    assert set(got) == {"2026-06-26", "2026-06-29", "2026-06-30"} and all(got[d] == want[d] for d in got)
    before = got
    run_session_stream(spark, lake, ckpt)  # nothing new
    run_session_stream(spark, lake, str(tmp_path / "other"), max_files_per_trigger=1)  # all again, one commit at a time
    assert _stream_sessions(spark, lake) == before


def test_timer_emits_what_no_later_file_follows(spark, tmp_path):
    import datetime as dt
    import time

    import pytest

    from tapeworks.streaming.sessions import run_session_stream
    lake, ckpt = str(tmp_path / "lake"), str(tmp_path / "ckpt")
    _session_lake(spark, tmp_path, lake, FILES)
    with pytest.raises(ValueError):
        run_session_stream(spark, lake, ckpt, wait=dt.timedelta(seconds=1))
    want, folder = _batch_sessions(spark, lake), tmp_path / "lake" / "sessions" / "feed=RV"
    query = run_session_stream(spark, lake, ckpt, available_now=False, every="1 second", wait=dt.timedelta(milliseconds=100))
    try:
        end = time.monotonic() + 120
        while len(list(folder.glob("session_date=*"))) < len(want) and time.monotonic() < end:
            time.sleep(1)
    finally:
        query.stop()
    assert _stream_sessions(spark, lake) == want
