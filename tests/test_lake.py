"""One commit for ticks and provenance, and the publish stage."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import runlog
from tapeworks.plans import lake, publish, ticks
from tapeworks.plans.backfill import archive_inventory, published_files, run_dates
from tapeworks.plans.ticks import existing_provenance, process_archives, read_ticks, run_log, write_ticks
from tests.conftest import tick_line, tick_text, txt_name, write_zip

DAYS = ("2026-06-29", "2026-06-30")


def _archives(folder, n=1, days=DAYS, price="1,0"):
    folder.mkdir(exist_ok=True)
    for day in days:
        write_zip(str(folder), "RV", day, {txt_name("RV", day): tick_text([tick_line(ref=day, price=price)] * n)})
    return str(folder)


def _state(spark, out):
    rows = read_ticks(spark, out, "RV", list(DAYS)).groupBy("reference_date", "price").count().collect()
    prov = existing_provenance(spark, out).collect()
    return (sorted((r.reference_date, r.price, r["count"]) for r in rows),
            sorted((r.trade_date, r.row_count, r.source_zip_sha256) for r in prov))


@pytest.mark.parametrize("step", ["stage", "measure", "move", "commit"])
def test_a_failure_before_the_commit_leaves_the_old_dates_whole(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "lake")
    write_ticks(process_archives(spark, _archives(tmp_path / "zips")), out)
    before = _state(spark, out)
    assert [c for _, _, c in before[0]] == [1, 1] and len(before[1]) == 2
    real, calls = getattr(lake.Generation, step), []

    def fails(self, *args):
        calls.append(args)
        if step in ("stage", "move") and len(calls) == 1:  # ticks are through, provenance is not
            return real(self, *args)
        raise OSError("the store is gone")

    monkeypatch.setattr(lake.Generation, step, fails)
    again = process_archives(spark, _archives(tmp_path / "zips", 3, price="2,0"))
    with pytest.raises(OSError, match="the store is gone"):
        write_ticks(again, out)
    assert _state(spark, out) == before
    if step == "commit":  # the next writer gets through, whatever the failed one left
        monkeypatch.setattr(lake.Generation, step, real)
        write_ticks(again, out)
        assert [(p, c) for _, p, c in _state(spark, out)[0]] == [(2.0, 3), (2.0, 3)]


def test_a_failure_behind_the_commit_leaves_the_new_dates_whole(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "lake")
    write_ticks(process_archives(spark, _archives(tmp_path / "zips")), out)
    real = lake.Generation.clean
    monkeypatch.setattr(lake.Generation, "clean", lambda *a: (_ for _ in ()).throw(OSError("late")))
    with pytest.raises(OSError):
        write_ticks(process_archives(spark, _archives(tmp_path / "zips", 3, price="2,0")), out)
    assert [(p, c) for _, p, c in _state(spark, out)[0]] == [(2.0, 3), (2.0, 3)]
    monkeypatch.setattr(lake.Generation, "clean", real)
    # the next write of the dates removes what the failed clean left, and old files of a write that never committed
    folder = f"{out}/ticks/{lake.date_folder('RV', dt.date(2026, 6, 30))}"
    stale = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    assert len(stale) == 2
    shutil.copy(f"{folder}/{stale[0]}", f"{folder}/g20200101T000000000000-{stale[0].split('-', 1)[1]}")
    write_ticks(process_archives(spark, _archives(tmp_path / "zips", 2)), out)
    assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) == 1
    assert spark.read.parquet(f"{out}/ticks").count() == 4


def test_writers_take_turns(spark, tmp_path, monkeypatch):
    """Two writers that see the same last version both get in, one after the other."""
    out = str(tmp_path / "lake")
    real, once = lake.Folder.names, []

    def names(self):
        found = real(self)
        if self.path.getName() == "commits" and not once:
            once.append(1)
            write_ticks(process_archives(spark, _archives(tmp_path / "b", 2, ("2026-06-30",))), out)
        return found

    monkeypatch.setattr(lake.Folder, "names", names)
    write_ticks(process_archives(spark, _archives(tmp_path / "a", 1, ("2026-06-29",))), out)
    log = lake.commit_log(spark, out).collect()
    assert sorted((r.version, str(r.file_date)) for r in log) == [(1, "2026-06-30"), (2, "2026-06-29")]
    assert [c for _, _, c in _state(spark, out)[0]] == [1, 2]


def test_counts_come_from_the_written_files(spark, tmp_path):
    """After the write the source is needed no more: counts, report and log do without it."""
    out, zips = str(tmp_path / "lake"), _archives(tmp_path / "zips", 3)
    b = process_archives(spark, zips)
    expected = sorted(map(tuple, ticks.provenance.tick_facts(b.ticks).collect()))
    write_ticks(b, out)
    b.ticks = b.ticks.limit(0)  # whoever read it now would count nothing
    shutil.rmtree(zips)
    assert sorted(map(tuple, b.facts.select("feed", "file_date", "row_count", "timestamp_null_count",
                                            "other_session_row_count").collect())) == expected
    assert [r.tick_count for r in run_log(b).collect()] == [3, 3]
    sessions = lake.current(spark, out).orderBy("file_date").collect()
    assert [[(str(s.session_date), s.n_trades) for s in r.sessions] for r in sessions] == [[(d, 3)] for d in DAYS]


def test_rows_lost_on_disk_stop_the_commit(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "lake")
    real = lake.Generation.staged_ticks
    monkeypatch.setattr(lake.Generation, "staged_ticks", lambda self: real(self).where("source_row > 2"))
    with pytest.raises(RuntimeError, match="the write saw 6 rows, 4 stand"):
        write_ticks(process_archives(spark, _archives(tmp_path / "zips", 3)), out)
    assert existing_provenance(spark, out) is None


# --- Publish stage ---

def _asked(spark, *days):
    return spark.createDataFrame([("RV", dt.date.fromisoformat(d)) for d in days], "feed string, file_date date")


def test_publish_has_its_own_outcome(spark, tmp_path):
    zips, out = _archives(tmp_path / "zips"), str(tmp_path / "lake")
    stores = {"archive_store": str(tmp_path / "a"), "ticks_store": str(tmp_path / "t")}
    log = run_dates(spark, zips, out, _asked(spark, *DAYS), **stores).collect()
    assert all([r[s] for s in runlog.STAGES] == ["SUCCESS"] * 5 and r.error is None for r in log)
    copied = sorted(os.path.relpath(os.path.join(d, f), tmp_path) for s in "at" for d, _, n in os.walk(tmp_path / s) for f in n)
    assert copied[0] == "a/b3/bdi/tick_by_tick_rv/20260629_NEGOCIOSAVISTA.zip" and len(copied) == 4
    assert spark.read.parquet(*[str(tmp_path / f) for f in copied[2:]]).count() == 2


@pytest.mark.parametrize("archive_ok,ticks_ok,price,error", [
    (False, True, "1,0", ["archive upload: "]), (True, False, "1,0", ["ticks upload: "]),
    (False, False, "1,0", ["archive upload: ", "ticks upload: "]), (False, True, "x", ["archive upload: ", "extract: "])])
def test_upload_failures_stop_nothing_and_keep_their_order(spark, tmp_path, archive_ok, ticks_ok, price, error):
    day = DAYS[0]
    zips, out = _archives(tmp_path / "zips", days=[day], price=price), str(tmp_path / "lake")
    (tmp_path / "blocked").write_text("a file where a folder should be")
    store = {k: str(tmp_path / ("ok" if ok else "blocked")) for k, ok in (("archive_store", archive_ok), ("ticks_store", ticks_ok))}
    r = run_dates(spark, zips, out, _asked(spark, day), **store).collect()[0]
    good = price != "x"
    assert r.s3_upload == ("SUCCESS" if archive_ok else "FAILED") and r.extract == ("SUCCESS" if good else "FAILED")
    assert r.ticks_s3_upload == ("SKIPPED" if not good else "SUCCESS" if ticks_ok else "FAILED")
    assert r.partition == ("SUCCESS" if good else "SKIPPED") and r.tick_count == (1 if good else None)
    places = [r.error.index(e) for e in error]
    assert places == sorted(places) and places[0] == 0


def test_a_failed_file_is_tried_again_and_named(spark, tmp_path):
    zips = _archives(tmp_path / "zips")
    files = publish.archive_targets(archive_inventory(spark, zips), str(tmp_path / "store"))
    lost = files.withColumn("src", F.when(F.dayofmonth("file_date") == 30, F.concat("src", F.lit(".gone"))).otherwise(F.col("src")))
    got = {str(r.file_date): r for r in publish.publish(lost, attempts=2).collect()}
    assert (got[DAYS[0]].status, got[DAYS[0]].attempts, got[DAYS[0]].error) == ("SUCCESS", 1, None)
    assert (got[DAYS[1]].status, got[DAYS[1]].attempts) == ("FAILED", 2) and "20260630" in got[DAYS[1]].error
    again = publish.publish(files.join(publish.publish(lost).where("status = 'FAILED'"), ["feed", "file_date"], "left_semi"))
    assert [r.status for r in again.collect()] == ["SUCCESS"]
    assert not [f for _, _, n in os.walk(tmp_path / "store") for f in n if f.endswith(".part")]


def test_a_status_outside_the_vocabulary_fails_the_log(spark, tmp_path):
    b = process_archives(spark, _archives(tmp_path / "zips"))
    bad = b.verdicts.select("feed", "file_date", F.lit("DONE").alias("status"), F.lit(None).cast("string").alias("error"))
    with pytest.raises(Exception, match="not a stage status: DONE"):
        run_log(b, archives_published=bad).collect()
