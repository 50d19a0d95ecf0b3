"""Rebuild planning and execution against a local archive and lake."""

import datetime as dt

from pyspark.sql import functions as F

from tapeworks.plans.backfill import execute_rebuild, plan_rebuild
from tests.conftest import tick_line, tick_text, txt_name, write_zip


def test_plan_then_run_then_skip(spark, tmp_path):
    archive, lake = str(tmp_path / "archive"), str(tmp_path / "lake")
    (tmp_path / "archive").mkdir()
    for day in ("2026-06-29", "2026-06-30"):
        write_zip(archive, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * 2)})
    (tmp_path / "archive" / "notes.txt").write_text("not an archive")
    requested = spark.createDataFrame([("RV", dt.date(2026, 6, d)) for d in (29, 30)] +
                                      [("RV", dt.date(2026, 7, 1))], "feed string, file_date date")
    dry = {str(r.file_date): r.status for r in
           plan_rebuild(spark, archive, lake, requested, "b1", dry_run=True).collect()}
    assert dry == {"2026-06-29": "WOULD_RUN", "2026-06-30": "WOULD_RUN", "2026-07-01": "FAILED"}

    plan = plan_rebuild(spark, archive, lake, requested, "b1")
    report = {str(r.file_date): r for r in execute_rebuild(spark, archive, lake, plan, "b1").collect()}
    assert report["2026-06-29"].status == "OK" and report["2026-06-29"].row_count == 2
    assert report["2026-07-01"].status == "FAILED" and report["2026-07-01"].error
    assert spark.read.parquet(f"{lake}/ticks").count() == 4

    again = {str(r.file_date): r.status for r in plan_rebuild(spark, archive, lake, None, "b1").collect()}
    assert again == {"2026-06-29": "SKIPPED", "2026-06-30": "SKIPPED"}
    forced = plan_rebuild(spark, archive, lake, None, "b1", force=True)
    assert {r.status for r in forced.collect()} == {"RUN"}
    assert plan_rebuild(spark, archive, lake, None, "b2").where(F.col("status") == "RUN").count() == 2


def _dates(spark, *days, feed="RV"):
    return spark.createDataFrame([(feed, dt.date.fromisoformat(d)) for d in days], "feed string, file_date date")


def test_daily_run_skips_runs_and_reports(spark, tmp_path):
    from tapeworks.operators import runlog
    from tapeworks.plans.backfill import run_dates
    archive, lake = str(tmp_path / "archive"), str(tmp_path / "lake")
    (tmp_path / "archive").mkdir()
    for day, price in (("2026-06-29", "1,0"), ("2026-06-30", "x")):
        write_zip(archive, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day, price=price)] * 2)})
    asked = _dates(spark, "2026-06-29", "2026-06-30", "2026-07-01")
    log = {str(r.trade_date): r for r in run_dates(spark, archive, lake, asked, "b1").collect()}
    first = log["2026-06-29"]
    assert [first[s] for s in runlog.STAGES] == ["SUCCESS"] * 5 and first.tick_count == 2 and first.error is None
    assert first.finished > first.started
    assert log["2026-06-30"].extract == "FAILED" and log["2026-06-30"].s3_upload == "SKIPPED"
    assert log["2026-07-01"].download == "UNAVAILABLE" and log["2026-07-01"].error
    again = {str(r.trade_date): r for r in run_dates(spark, archive, lake, asked, "b1").collect()}
    assert [again["2026-06-29"][s] for s in runlog.STAGES] == ["SKIPPED"] * 5
    forced = {str(r.trade_date): r for r in run_dates(spark, archive, lake, asked, "b1", overwrite=True).collect()}
    assert forced["2026-06-29"].partition == "SUCCESS"
    none = run_dates(spark, archive, lake, _dates(spark, "2026-07-02"), "b1").collect()
    assert [r.download for r in none] == ["UNAVAILABLE"]
    lines = [r.line for r in runlog.summary_lines(run_dates(spark, archive, lake, asked)).orderBy(
        "part", "trade_date").collect()]
    assert "  Failed          : 2" in lines and lines[-1].startswith("    2026-07-01: download")


def test_verify_our_own_lake(spark, tmp_path):
    from tapeworks.plans.backfill import lake_facts, verify_archive
    archive, lake = str(tmp_path / "archive"), str(tmp_path / "lake")
    (tmp_path / "archive").mkdir()
    for day in ("2026-06-29", "2026-06-30"):
        write_zip(archive, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * 2)})
    assert [r.problem for r in verify_archive(spark, archive, lake_facts(spark, lake)).collect()] == ["no ticks Parquet"] * 2
    plan = plan_rebuild(spark, archive, lake, None, "b1")
    report = execute_rebuild(spark, archive, lake, plan, "b1").collect()
    assert all(r.status == "OK" and r.seconds > 0 for r in report)
    assert verify_archive(spark, archive, lake_facts(spark, lake)).collect() == []
    (tmp_path / "archive" / "20260629_NEGOCIOSAVISTA.zip").unlink()
    spark.range(3).write.mode("overwrite").parquet(f"{lake}/ticks/feed=RV/year=2026/file_date=2026-06-30")
    got = verify_archive(spark, archive, lake_facts(spark, lake)).orderBy("ord").collect()
    assert [r.message for r in got] == ["RV 2026-06-29: ticks Parquet without archived ZIP",
                                        "RV 2026-06-30: schema differs from the contract"]


def test_verify_flat_layout_by_footers(spark, tmp_path):
    import json

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tapeworks.plans.backfill import footer_facts, verify_archive
    from tapeworks.sources.inventory import _contract_arrow_schema
    archive = str(tmp_path / "archive")
    (tmp_path / "archive").mkdir()
    folder = tmp_path / "b3" / "rv" / "ticks" / "year=2026"
    folder.mkdir(parents=True)
    for day, rows in (("2026-06-29", 4), ("2026-06-30", 5)):
        write_zip(archive, "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)])})
        meta = {"k": json.dumps({"feed": "RV", "trade_date": day, "schema_version": 1, "row_count": 4,
                                 "source_txt_row_count": rows})}
        schema = _contract_arrow_schema().with_metadata(meta)
        pq.write_table(pa.Table.from_pylist([], schema=schema), str(folder / f"{day}.parquet"))
    got = verify_archive(spark, archive, footer_facts(spark, str(tmp_path / "b3"), "k")).collect()
    assert [r.message for r in got] == ["RV 2026-06-30: row_count 4 != source_txt_row_count 5"]


def test_store_schemes_are_spelt_for_arrow(monkeypatch):
    import pyarrow.fs as pafs

    from tapeworks.sources import inventory
    seen = []

    class Fake:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return None, uri

    monkeypatch.setattr(pafs, "FileSystem", Fake)
    for uri in ("s3a://b/k", "s3n://b/k", "abfss://c@a/k", "file:///x", "/x"):
        inventory.arrow_file(uri)
    assert seen == ["s3://b/k", "s3://b/k", "abfs://c@a/k", "file:///x", "/x"]
