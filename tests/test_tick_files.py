"""Tick text and archives through the real sources: contract cases."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tapeworks.plans.ticks import missing_ticks, process_archives, process_text, read_ticks, write_ticks
from tests.conftest import tick_line, tick_text, txt_name, write_zip

DAY = "2026-06-30"


def _verdict(batch, feed="RV", day=DAY):
    rows = batch.verdicts.where((F.col("feed") == feed) & (F.col("file_date") == day)).collect()
    assert len(rows) == 1
    return rows[0]


def _one_zip(tmp_path, lines, feed="RV", day=DAY, header=None, **kw):
    folder = tmp_path / "zips"
    folder.mkdir(exist_ok=True)
    data = tick_text(lines, **({"header": header} if header is not None else {}), **kw)
    write_zip(str(folder), feed, day, {txt_name(feed, day): data})
    return str(folder)


def test_typed_columns_and_order(spark, tmp_path):
    loc = _one_zip(tmp_path, [
        tick_line(time="100000006", trade_id="30", buyer="", seller="0"),
        tick_line(time="100000006", trade_id="10", symbol="PETR4Ç"),
        tick_line(time="100000006", trade_id="20", action="2", price="-1"),
    ])
    b = process_archives(spark, loc)
    v = _verdict(b)
    assert v.status == "OK" and v.data_lines == 3
    rows = b.ticks.orderBy("source_row").collect()
    assert [r.trade_id for r in rows] == [30, 10, 20]          # TXT order, not trade_id
    assert [r.source_row for r in rows] == [2, 3, 4]
    r0 = rows[0]
    assert r0.buyer_broker is None and r0.seller_broker == "0"
    assert rows[1].symbol == "PETR4Ç"                      # latin-1 decoded
    assert rows[2].price == -1.0 and rows[2].update_action == 2
    ms = b.ticks.select(F.unix_millis("timestamp").alias("ms")).first().ms
    assert ms == int(dt.datetime(2026, 6, 30, 13, 0, 0, 6000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert b.ticks.columns[2:] == ["source_row", "symbol", "trade_date", "reference_date",
                                   "timestamp", "time_raw", "price", "quantity",
                                   "update_action", "session_type", "channel_type",
                                   "trade_id", "buyer_broker", "seller_broker"]


def test_blank_lines_keep_physical_numbers(spark, tmp_path):
    loc = _one_zip(tmp_path, [tick_line(trade_id="1"), "", tick_line(trade_id="2")],
                   newline="\r\n")
    b = process_archives(spark, loc)
    assert [r.source_row for r in b.ticks.orderBy("source_row").collect()] == [2, 4]
    v = _verdict(b)
    assert v.blank_lines == 1 and v.data_lines == 2


@pytest.mark.parametrize("bad,rule,value", [
    ({"qty": "abc"}, "quantity_pattern", "abc"),
    ({"qty": "4294967296"}, "quantity_range", "4294967296"),
    ({"action": "256"}, "update_action_range", "256"),
    ({"action": ""}, "update_action_pattern", ""),
    ({"action": "0001"}, "update_action_pattern", "0001"),
    ({"price": "1,2,3"}, "price", "1,2,3"),
    ({"price": "1,"}, "price", "1,"),
    ({"trade_id": "-1"}, "trade_id_pattern", "-1"),
    ({"trade_date": "2026-02-30"}, "trade_date", "2026-02-30"),
    ({"trade_date": "0000-01-01"}, "trade_date", "0000-01-01"),
    ({"ref": "2026-06-29"}, "reference_date", "2026-06-29"),
    ({"session": " 1"}, "session_type_pattern", " 1"),
    ({"channel": "+2"}, "channel_type_pattern", "+2"),
])
def test_bad_values_reject_the_file(spark, tmp_path, bad, rule, value):
    loc = _one_zip(tmp_path, [tick_line(), tick_line(**bad), tick_line(**bad)])
    b = process_archives(spark, loc)
    v = _verdict(b)
    assert (v.status, v.rule, v.first_line, v.first_value, v.invalid_count) == \
        ("REJECTED", rule, 3, value, 2)
    assert b.ticks.count() == 0


def test_quantity_accepts_leading_zeros_within_digit_limit(spark, tmp_path):
    loc = _one_zip(tmp_path, [tick_line(qty="0001", action="000")])
    b = process_archives(spark, loc)
    r = b.ticks.first()
    assert r.quantity == 1 and r.update_action == 0


@pytest.mark.parametrize("lines,header,rule,line", [
    ([tick_line()], "Wrong;Header", "header", 1),
    ([tick_line(), "a;b"], None, "field_count", 3),
    ([tick_line(), tick_line() + ";X"], None, "field_count", 3),
    ([], None, "zero_rows", None),
])
def test_layout_violations(spark, tmp_path, lines, header, rule, line):
    loc = _one_zip(tmp_path, lines, header=header)
    v = _verdict(process_archives(spark, loc))
    assert (v.status, v.rule, v.first_line) == ("REJECTED", rule, line)


def test_field_count_beats_value_rules(spark, tmp_path):
    loc = _one_zip(tmp_path, [tick_line(price="x"), "a;b"])
    v = _verdict(process_archives(spark, loc))
    assert v.rule == "field_count" and v.first_value == "2"


def test_two_txt_members_rejected_and_missing_member(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    data = tick_text([tick_line()])
    write_zip(str(folder), "RV", DAY, {txt_name("RV", DAY): data, txt_name("RV", DAY, "_x"): data})
    write_zip(str(folder), "DERIV", DAY, {"other.txt": data})
    b = process_archives(spark, str(folder))
    assert _verdict(b, "RV").rule == "txt_ambiguous"
    assert _verdict(b, "DERIV").rule == "txt_missing"


def test_unreadable_times_are_kept_and_counted(spark, tmp_path):
    bad = ["", "25000000", "250000000", "106000000", "09O000000", "0900000000", "095960000"]
    loc = _one_zip(tmp_path, [tick_line(time=t, trade_id=str(i)) for i, t in enumerate(bad)]
                   + [tick_line(time="235959999")])
    b = process_archives(spark, loc)
    assert _verdict(b).status == "OK"
    p = b.provenance.first()
    assert (p.row_count, p.timestamp_null_count, p.source_txt_row_count) == (8, 7, 8)


def test_session_differs_from_calendar_day(spark, tmp_path):
    loc = _one_zip(tmp_path, [tick_line(time="170000000", trade_date="2026-07-01"),
                              tick_line(time="022900000", trade_date="2026-06-29")], feed="DERIV")
    b = process_archives(spark, loc)
    rows = b.ticks.orderBy("source_row").select(
        "trade_date", F.date_format(F.from_utc_timestamp("timestamp", "America/Sao_Paulo"),
                                    "yyyy-MM-dd").alias("local_day")).collect()
    assert [r.local_day for r in rows] == [DAY, DAY]            # timestamp uses the file day
    assert [r.trade_date for r in rows] == ["2026-07-01", "2026-06-29"]


def test_provenance_carries_archive_hash(spark, tmp_path):
    import hashlib
    loc = _one_zip(tmp_path, [tick_line()])
    zpath = os.path.join(loc, os.listdir(loc)[0])
    digest = hashlib.sha256(open(zpath, "rb").read()).hexdigest()
    p = process_archives(spark, loc).provenance.first()
    assert p.source_zip_sha256 == digest
    assert p.source_txt_name == txt_name("RV", DAY) and p.schema_version == 1


def test_text_source_matches_archive_source(spark, tmp_path):
    folder = tmp_path / "txt"
    folder.mkdir()
    lines = [tick_line(trade_id=str(i), time="1000%05d" % i) for i in range(50)]
    (folder / txt_name("RV", DAY)).write_bytes(tick_text(lines[:20] + [""] + lines[20:]))
    b = process_text(spark, str(folder))
    rows = b.ticks.orderBy("source_row").collect()
    assert len(rows) == 50 and rows[20].source_row == 23 and rows[19].source_row == 21


def test_text_source_numbers_lines_across_splits(spark, tmp_path):
    folder = tmp_path / "big"
    folder.mkdir()
    lines = [tick_line(trade_id=str(i)) if i % 37 else "" for i in range(1, 4001)]
    (folder / txt_name("DERIV", DAY)).write_bytes(tick_text(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        b = process_text(spark, str(folder))
        got = [r.source_row for r in b.ticks.select("source_row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [i + 1 for i in range(1, 4001) if i % 37]
    assert sorted(got) == expected


def test_write_and_read_back_by_dates(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    for day in ("2026-06-29", "2026-06-30"):
        write_zip(str(folder), "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * 3)})
    out = str(tmp_path / "lake")
    write_ticks(process_archives(spark, str(folder)), out)
    back = read_ticks(spark, out, "RV", ["2026-06-30"])
    assert back.count() == 3 and back.columns[0] == "source_row"
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    # re-run with skip: nothing is rewritten; provenance has one row per date
    write_ticks(process_archives(spark, str(folder)), out, skip_existing=True)
    assert spark.read.parquet(f"{out}/provenance").count() == 2


@pytest.mark.parametrize("day,time", [("2018-11-04", "003000000"), ("2018-02-17", "233000000")])
def test_dst_gap_and_overlap_reject_the_file(spark, tmp_path, day, time):
    loc = _one_zip(tmp_path, [tick_line(ref=day, time="120000000"), tick_line(ref=day, time=time)],
                   day=day)
    v = _verdict(process_archives(spark, loc), day=day)
    assert (v.status, v.rule, v.first_line, v.first_value) == ("REJECTED", "local_time_invalid", 3, time)


def test_dst_day_outside_the_gap_is_fine(spark, tmp_path):
    day = "2018-11-04"
    loc = _one_zip(tmp_path, [tick_line(ref=day, time="013000000")], day=day)
    b = process_archives(spark, loc)
    assert _verdict(b, day=day).status == "OK"
    ms = b.ticks.select(F.unix_millis("timestamp").alias("ms")).first().ms
    # 01:30 local on the first DST day is UTC-2
    assert ms == int(dt.datetime(2018, 11, 4, 3, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_hot_day_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    import glob

    from tapeworks.plans import ticks as T
    monkeypatch.setattr(T, "ROWS_PER_FILE", 10)
    loc = _one_zip(tmp_path, [tick_line(trade_id=str(i)) for i in range(35)])
    out = str(tmp_path / "lake")
    # AQE would merge these tiny chunks into one task; at scale it merges
    # only up to its advisory size, so a hot day stays spread out
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ticks(process_archives(spark, loc), out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{out}/ticks/feed=RV/year=2026/file_date={DAY}/*.parquet")
    assert len(files) >= 2
    back = read_ticks(spark, out, "RV", [DAY]).orderBy("source_row").collect()
    assert [r.source_row for r in back] == list(range(2, 37))


def test_run_log_from_batch(spark, tmp_path):
    from tapeworks.operators.runlog import date_summary
    from tapeworks.plans.ticks import run_log
    folder = tmp_path / "zips"
    folder.mkdir()
    write_zip(str(folder), "RV", DAY, {txt_name("RV", DAY): tick_text([tick_line()] * 3)})
    write_zip(str(folder), "DERIV", DAY, {txt_name("DERIV", DAY): tick_text([tick_line(price="x")])})
    log = {r.feed: r for r in run_log(process_archives(spark, str(folder))).collect()}
    assert log["RV"].tick_count == 3 and log["RV"].error is None and log["RV"].extract == "SUCCESS"
    assert log["DERIV"].extract == "FAILED" and log["DERIV"].error.startswith("extract: column PrecoNegocio")
    s = date_summary(run_log(process_archives(spark, str(folder)))).first()
    assert (s.total, s.succeeded, s.failed) == (2, 1, 1)


def _days_zip(folder, days, feed="RV", rows=3):
    for day in days:
        write_zip(str(folder), feed, day, {txt_name(feed, day): tick_text([tick_line(ref=day)] * rows)})
    return str(folder)


@pytest.mark.parametrize("skip", [False, True])
def test_two_batches_of_one_year_keep_each_other(spark, tmp_path, skip):
    out = str(tmp_path / "lake")
    for day in ("2026-06-29", "2026-06-30"):
        folder = tmp_path / day
        folder.mkdir()
        write_ticks(process_archives(spark, _days_zip(folder, [day])), out, skip_existing=skip)
    prov = spark.read.parquet(f"{out}/provenance")
    assert sorted(str(r.file_date) for r in prov.collect()) == ["2026-06-29", "2026-06-30"]
    assert spark.read.parquet(f"{out}/ticks").count() == 6


def test_read_by_every_kind_of_date_input(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    days = ["2026-06-25", "2026-06-26", "2026-06-27", "2026-06-29", "2026-06-30"]  # the 27th is a Saturday
    out = str(tmp_path / "lake")
    write_ticks(process_archives(spark, _days_zip(folder, days, rows=1)), out)

    def days_of(dates):
        df = read_ticks(spark, out, "RV", dates)
        assert "PartitionFilters: [isnotnull(feed" in df._jdf.queryExecution().executedPlan().toString()
        return sorted(r.reference_date for r in df.collect())

    assert days_of("2026-06-26") == ["2026-06-26"] == days_of(dt.date(2026, 6, 26))
    assert days_of(["2026-06-30", "2026-06-27", "2026-06-30"]) == ["2026-06-27", "2026-06-30"]
    assert days_of(("2026-06-25", "2026-06-30")) == ["2026-06-25", "2026-06-26", "2026-06-29", "2026-06-30"]
    gone = missing_ticks(spark, out, "RV", ("2026-06-24", "2026-07-01")).collect()
    assert sorted(str(r.file_date) for r in gone) == ["2026-06-24", "2026-07-01"]
    assert missing_ticks(spark, str(tmp_path / "nowhere"), "RV", "2026-06-24").count() == 1
    with pytest.raises(ValueError):
        read_ticks(spark, out, "RV", ("2026-06-24",))


def test_damaged_and_duplicate_archives_reject_only_their_dates(spark, tmp_path):
    folder = tmp_path / "zips"
    (folder / "again").mkdir(parents=True)
    good, broken, double = "2026-06-26", "2026-06-29", "2026-06-30"
    _days_zip(folder, [good, double])
    _days_zip(folder / "again", [double])
    lines = [tick_line(ref=broken, trade_id=str(i)) for i in range(5000)]
    path = write_zip(str(folder), "RV", broken, {txt_name("RV", broken): tick_text(lines)})
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0xFF  # inside the member's bytes: only reading it finds out
    open(path, "wb").write(bytes(data))
    (folder / "20260701_NEGOCIOSAVISTA.zip").write_bytes(b"not a zip")
    b = process_archives(spark, str(folder))
    got = {str(r.file_date): (r.status, r.rule) for r in b.verdicts.collect()}
    assert got == {good: ("OK", None), broken: ("REJECTED", "archive_unreadable"),
                   double: ("REJECTED", "archive_ambiguous"), "2026-07-01": ("REJECTED", "archive_unreadable")}
    assert b.ticks.count() == 3 and b.provenance.count() == 1


def test_second_and_empty_txt(spark, tmp_path):
    for sub in ("a", "b"):
        (tmp_path / "txt" / sub).mkdir(parents=True)
        (tmp_path / "txt" / sub / txt_name("RV", DAY)).write_bytes(tick_text([tick_line()]))
    (tmp_path / "txt" / "a" / txt_name("DERIV", DAY)).write_bytes(b"")
    (tmp_path / "txt" / "a" / txt_name("RV", "2026-06-29")).write_bytes(tick_text([tick_line(ref="2026-06-29")]))
    b = process_text(spark, [str(tmp_path / "txt" / s) for s in ("a", "b")])
    got = {(r.feed, str(r.file_date)): (r.status, r.rule) for r in b.verdicts.collect()}
    assert got == {("RV", DAY): ("REJECTED", "txt_ambiguous"), ("DERIV", DAY): ("REJECTED", "header"),
                   ("RV", "2026-06-29"): ("OK", None)}
    assert b.ticks.count() == 1


def test_numbering_survives_a_change_of_splits(spark, tmp_path):
    from tapeworks.sources.text import scan_lines
    (tmp_path / "t.txt").write_bytes(b"".join(b"line %d\n" % i for i in range(1, 5002)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = scan_lines(spark, str(tmp_path / "t.txt"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r.line_no: r.line for r in df.collect()}
    assert got == {i: f"line {i}" for i in range(1, 5002)}


def test_sink_refuses_files_with_too_few_rows(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    b = process_archives(spark, _days_zip(folder, ["2026-06-29", "2026-06-30"]))
    b.provenance = b.provenance.withColumn("row_count", F.when(
        F.col("file_date") == "2026-06-30", 2).otherwise(F.col("row_count")).cast("bigint"))
    out = str(tmp_path / "lake")
    refused = write_ticks(b, out).collect()
    assert [(str(r.file_date), r.problem) for r in refused] == [("2026-06-30", "row_count 2 != source_txt_row_count 3")]
    assert spark.read.parquet(f"{out}/ticks").count() == 3


@pytest.mark.parametrize("day,ok", [("1850-03-05", True), ("2150-03-05", True)])
def test_days_outside_the_transition_table_take_the_full_check(spark, tmp_path, day, ok):
    loc = _one_zip(tmp_path, [tick_line(ref=day, time="120000000")], day=day)
    assert (_verdict(process_archives(spark, loc), day=day).status == "OK") == ok


def test_verdict_plan_leaves_the_lines_in_place(spark, tmp_path):
    from tapeworks.operators import validate
    loc = _one_zip(tmp_path, [tick_line(), tick_line(price="x")])
    b = process_archives(spark, loc)
    lines = spark.createDataFrame([("RV", dt.date(2026, 6, 30), 2, "a;b")], "feed string, file_date date, source_row int, line string")
    plan = validate.file_verdicts(lines)._jdf.queryExecution().executedPlan().toString()
    sorted_joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert "BroadcastHashJoin" in plan and not any("source_row" in x for x in sorted_joins)
    assert b.verdicts.count() == 1
