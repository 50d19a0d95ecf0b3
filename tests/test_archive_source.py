"""Archives by ranges, the independent line count, the named source, the footer index and schema drift."""

import datetime as dt
import os
import resource
import zipfile

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import validate
from tapeworks.plans import lake
from tapeworks.plans.backfill import lake_facts, lake_footers, schema_groups
from tapeworks.plans.ticks import process_archives, process_text, write_ticks
from tapeworks.sources import archive_source, archives
from tapeworks.sources.text import physical_line_counts
from tests.conftest import tick_line, tick_text, txt_name, write_zip

DAY = "2026-06-30"


def test_memory_does_not_grow_with_the_archive(tmp_path):
    """A member of 300 MB of text: lines come in batches and the process stays small."""
    path = tmp_path / "20260630_NEGOCIOSAVISTA.zip"
    block = os.urandom(150_000).hex().encode() + b"\n" + b"x;" * 50_000 + b"\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z, z.open("30-06-2026_NEGOCIOSAVISTA_RV.txt", "w") as out:
        for _ in range(750):
            out.write(block)
    size = path.stat().st_size
    before, rows, summary = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0, None
    archives_batch, archives._BATCH_LINES = archives._BATCH_LINES, 64
    try:
        for b in archives.scan_path(str(path), "RV", dt.date(2026, 6, 30), "30-06-2026_NEGOCIOSAVISTA_RV"):
            if b.column("source_row")[0].as_py():
                rows += b.num_rows
            else:
                summary = b.to_pylist()[0]
    finally:
        archives._BATCH_LINES = archives_batch
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024
    assert rows == 1500 == summary["n_lines"] and summary["n_candidates"] == 1 and size > 290e6
    assert grown < size / 2, grown


def test_archives_are_opened_by_path_or_by_content(spark, tmp_path, monkeypatch):
    write_zip(str(tmp_path), "RV", DAY, {txt_name("RV", DAY): tick_text([tick_line(), tick_line()])})
    by_path = sorted(map(tuple, archives.scan_archives(spark, str(tmp_path)).collect()), key=str)
    monkeypatch.setattr(archives, "arrow_reads", lambda uri: False)
    assert sorted(map(tuple, archives.scan_archives(spark, str(tmp_path)).collect()), key=str) == by_path
    assert {r[-1] for r in by_path} == {None, 3}


def _verdict(spark, lines, n_lines):
    rows = [("RV", dt.date(2026, 6, 30), i + 1, x) for i, x in enumerate(lines) if x is not None]
    df = spark.createDataFrame(rows, "feed string, file_date date, source_row int, line string")
    counts = spark.createDataFrame([("RV", dt.date(2026, 6, 30), n_lines)], "feed string, file_date date, n_lines bigint")
    return validate.file_verdicts(df, None, counts).first()


def test_a_lost_line_fails_the_file_before_all_else(spark):
    from tapeworks import contract as C
    lines = [C.EXPECTED_HEADER, tick_line(), "", tick_line(price="x")]
    assert _verdict(spark, lines, 4).rule == "price"
    lost = _verdict(spark, [lines[0], None, *lines[2:]], 4)
    assert (lost.status, lost.rule, lost.invalid_count) == ("REJECTED", "line_count", 1)
    assert lost.message == "lines read and lines of the file differ by 1"
    assert _verdict(spark, lines, 2).rule == "line_count"


@pytest.mark.parametrize("end", ["", "\n", "\n\n", ";", ";\n"])
def test_counts_that_share_nothing_with_the_line_reader(spark, tmp_path, end):
    body = "\n".join([tick_line(trade_id=str(i)) for i in range(2000)])
    (tmp_path / "t.txt").write_text(body + end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = physical_line_counts(spark, str(tmp_path / "t.txt")).first().n_lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == len((body + end).splitlines())


def test_text_files_are_counted_twice(spark, tmp_path):
    (tmp_path / txt_name("RV", DAY)).write_bytes(tick_text([tick_line(), "", tick_line()]))
    b = process_text(spark, str(tmp_path))
    assert b.verdicts.first().status == "OK" and b.ticks.count() == 2


def test_named_source_batch_and_restarted_stream(spark, tmp_path):
    archive_source.register(spark)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    (tmp_path / "landing").mkdir()

    def run():
        stream = spark.readStream.format("tick_archives").load(landing)
        (stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-c").option("path", out)
         .trigger(availableNow=True).start().awaitTermination())

    write_zip(landing, "RV", DAY, {txt_name("RV", DAY): tick_text([tick_line()] * 3)})
    (tmp_path / "landing" / "notes.zip").write_bytes(b"not one of ours")
    run()
    assert spark.read.parquet(out).count() == 5  # header, three lines, summary
    for feed, day in (("DERIV", DAY), ("RV", "2026-07-01")):
        write_zip(landing, feed, day, {txt_name(feed, day): tick_text([tick_line(ref=day)])})
    run()
    run()
    batch = spark.read.format("tick_archives").load(landing)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, spark.read.parquet(out).collect())) == sorted(map(key, batch.collect()))
    scan = archives.scan_archives(spark, landing).drop("path")
    assert sorted(map(key, scan.collect())) == sorted(map(key, batch.drop("path").collect()))


def test_names_are_parsed_as_the_columns_do():
    assert archive_source.parse_name("20260630_NEGOCIOSAVISTA.zip")[:2] == ("RV", dt.date(2026, 6, 30))
    assert archive_source.parse_name("30-06-2026_NEGOCIOSAVISTA_DRV.zip")[2] == "30-06-2026_NEGOCIOSAVISTA_DRV"
    assert archive_source.parse_name("20260631_NEGOCIOSAVISTA.zip") is None and archive_source.parse_name("x.zip") is None


def _two_days(spark, tmp_path, n=1, days=("2026-06-29", DAY)):
    folder = tmp_path / "zips"
    folder.mkdir(exist_ok=True)
    for day in days:
        write_zip(str(folder), "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day)] * n)})
    return process_archives(spark, str(folder))


def test_a_second_look_opens_only_changed_files_and_drift_is_found(spark, tmp_path):
    out = str(tmp_path / "lake")
    write_ticks(_two_days(spark, tmp_path), out)

    def look():
        return sorted((str(r.file_date), r.opened, r.conforms) for r in lake_footers(spark, out).collect())

    assert look() == [("2026-06-29", True, True), (DAY, True, True)]
    assert look() == [("2026-06-29", False, True), (DAY, False, True)]
    again = tmp_path / "again"
    again.mkdir()
    write_ticks(_two_days(spark, again, 2, (DAY,)), out)
    assert look() == [("2026-06-29", False, True), (DAY, True, True)]
    rows = spark.read.parquet(f"{out}/ticks/{lake.date_folder('RV', dt.date(2026, 6, 29))}")
    rows = spark.createDataFrame(rows.withColumn("price", F.col("price").cast("float")).collect(), schema=rows.withColumn(
        "price", F.col("price").cast("float")).schema)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/ticks/{lake.date_folder('RV', dt.date(2026, 6, 29))}")
    assert [(d, c) for d, _, c in look()] == [("2026-06-29", False), (DAY, True)]
    assert {str(r.file_date): r.schema_matches for r in lake_facts(spark, out).collect()} == {"2026-06-29": False, DAY: True}
    groups = schema_groups(spark, out).collect()
    assert sorted((r.conforms, r.n_files) for r in groups) == [(False, 1), (True, 1)]
    assert "price float" in next(r.fields for r in groups if not r.conforms)


def test_a_reversed_range_holds_no_day(spark):
    from tapeworks.functions.calendar import resolve_dates
    assert resolve_dates(spark, ("2026-06-10", "2026-06-08")) == []
    assert len(resolve_dates(spark, ("2026-06-08", "2026-06-10"))) == 3
