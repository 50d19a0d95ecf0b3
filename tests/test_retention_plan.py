"""Retention over listings of a local folder and a store."""

import datetime as dt

from tapeworks.operators import retention
from tapeworks.plans import retention_plan

TODAY = dt.date(2026, 7, 31)


def _touch(root, *names, size=10):
    for n in names:
        p = root / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * size)


def test_decisions_over_listings(spark, tmp_path, monkeypatch):
    local, store = tmp_path / "local", tmp_path / "store"
    _touch(local, "rv/zip/20260629_NEGOCIOSAVISTA.zip", "rv/zip/20260630_NEGOCIOSAVISTA.zip", "rv/zip/20260730_NEGOCIOSAVISTA.zip",
           "rv/zip/notes.txt", "rv/raw/2026-06-29.parquet", "rv/raw/2026-07-30.parquet", "rv/ticks/2026-06-29.parquet",
           "rv/ticks/2026-06-30.parquet", "rv/ticks/2026-02-30.parquet", "deriv/zip/29-06-2026_NEGOCIOSAVISTA_DRV.zip",
           "deriv/ticks/2026-06-29.parquet", "other/zip/20260629_NEGOCIOSAVISTA.zip", "rv/ticks/deep/2026-06-29.parquet")
    _touch(store, "b3/bdi/tick_by_tick_rv/20260629_NEGOCIOSAVISTA.zip", "b3/tick_by_tick/rv/ticks/year=2026/2026-06-29.parquet",
           "b3/tick_by_tick/rv/ticks/year=2026/2026-06-30/g1-part-0.parquet", "b3/bdi/tick_by_tick_deriv/29-06-2026_NEGOCIOSAVISTA_DRV.zip")
    got = retention_plan.plan(spark, str(local), str(store), TODAY, 28)
    decided = {(r.feed, r.kind, r.name): r.decision for r in got.collect()}
    assert decided == {
        ("RV", "zip", "20260629_NEGOCIOSAVISTA.zip"): "delete", ("RV", "zip", "20260630_NEGOCIOSAVISTA.zip"): "kept_missing_in_archive",
        ("RV", "zip", "20260730_NEGOCIOSAVISTA.zip"): "recent", ("RV", "zip", "notes.txt"): "ignored",
        ("RV", "raw", "2026-06-29.parquet"): "delete", ("RV", "raw", "2026-07-30.parquet"): "recent",
        ("RV", "ticks", "2026-06-29.parquet"): "delete", ("RV", "ticks", "2026-06-30.parquet"): "delete",
        ("RV", "ticks", "2026-02-30.parquet"): "ignored", ("DERIV", "zip", "29-06-2026_NEGOCIOSAVISTA_DRV.zip"): "delete",
        ("DERIV", "ticks", "2026-06-29.parquet"): "kept_missing_in_archive"}
    s = {r.feed: r for r in retention.summary(got).collect()}
    assert (s["RV"].deleted, s["RV"].ignored, s["RV"].freed_bytes, s["DERIV"].kept_missing_in_archive) == (4, 2, 40, 1)
    nowhere = retention_plan.plan(spark, str(local), str(tmp_path / "nowhere"), TODAY, 28)
    assert {r.decision for r in nowhere.where("kind <> 'raw'").collect()} == {"kept_missing_in_archive", "recent", "ignored"}
    monkeypatch.setattr(retention_plan, "store_keys", lambda *a: (_ for _ in ()).throw(OSError("no access")))
    failed = retention_plan.plan(spark, str(local), str(store), TODAY, 28)
    assert {r.decision for r in failed.where("kind <> 'raw'").collect()} == {"error", "recent", "ignored"}
    assert {r.decision for r in failed.where("kind = 'raw'").collect()} == {"delete", "recent"}
