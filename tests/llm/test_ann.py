import math

import numpy as np
import pytest

from tapeworks.llm import ann

SCHEMA = "vec_id long, embedding array<double>, score int"


def exact(rows, every, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    width = max(map(len, ok.values()))
    ids = np.array(sorted(ok))
    x = np.array([list(ok[i]) + [0.0] * (width - len(ok[i])) for i in ids])
    out = {}
    for i in ids[ids % every == 0].tolist():
        s = x @ x[np.searchsorted(ids, i)]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(4)


def test_recall_of_descent_and_search(spark):
    """Blocks far smaller than the table, so that descent and search do the work."""
    x = np.random.default_rng(1).normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = exact(rows, 20, 20)
    got = found(ann.nearest(frame(spark, rows), 20, 20, passes=3, leaf=100))
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q, w in got.items():
        assert all(abs(s - x[q] @ x[i]) < 1e-12 for i, s in w)
        assert w == sorted(w, key=lambda p: (-p[1], p[0]))


def test_uneven_lengths(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 12)) * rng.lognormal(0, .7, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = exact(rows, 20, 20)
    assert recall(found(ann.nearest(frame(spark, rows), 20, 20, passes=3, leaf=150)), want) >= 0.9


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in df.collect()]
    want = exact(rows, 20, 20)
    got = found(ann.ann_report(df))
    assert set(got) == set(want) and recall(got, want) >= 0.99


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, [0.5, 0.25, 0.0]) for i in range(100)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(40)]
    rows += [(200, None), (220, [None, 1.0, 0.0]), (240, [0.0, 0.0, 0.0]), (260, [float("nan"), 1.0, 0.0]), (280, []),
             (300, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (320, [2.0]), (20, [0.5, 0.25, 0.0]), (40, [9.0, 9.0, 9.0])]
    want = exact(rows, 20, 20)
    got = found(ann.ann_report(frame(spark, rows)))
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_few_and_no_rows(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (7, [2.0, 0.0])])
    assert list(map(tuple, ann.ann_report(df).collect())) == [(0, 1, 7, 2.0)]
    assert ann.ann_report(df.where("vec_id = 0")).collect() == []
    assert ann.ann_report(df.limit(0)).collect() == []


def test_negative_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(-700, 700)]
    for q in (20, -20, 0):  # the best match of a query is the row that negating its id and one less gives
        rows[700 - q - 1] = (-q - 1, [5 * x for x in dict(rows)[q]])
    want = exact(rows, 20, 20)
    got = found(ann.nearest(frame(spark, rows), 20, 20, passes=4, leaf=150))
    assert all(got[q][0][0] == want[q][0][0] == -q - 1 for q in (20, -20, 0)) and recall(got, want) >= 0.9


@pytest.mark.parametrize("n", [3000, 9000])
def test_uneven_lengths_with_default_settings(spark, n):
    """Normal vectors of 64 dimensions, whose lengths differ by about 9 %: hard, and more than one block."""
    x = np.random.default_rng(n).normal(size=(n, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = recall(found(ann.ann_report(frame(spark, rows))), exact(rows, 20, 20))
    print(n, got)
    assert got >= 0.9
