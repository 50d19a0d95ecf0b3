import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score int"


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * Fraction(x)) for x in v]
            ok[i] = min(ok.get(i, q), q)
    out = []
    for i, v in ok.items():
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok.items() if j != i)
            out += [(i, r + 1, j, -s if -2**63 <= -s < 2**63 else None) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def rows_of(rng, n, dims=8, scale=1.0):
    centres = rng.normal(size=(5, dims))
    v = centres[rng.integers(5, size=n)] + rng.normal(size=(n, dims)) * 0.2
    return [(i, (x * scale).tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("block,query_block,scale", [(8, 16, 1.0), (50, 2048, 0.01), (16, 7, 1e5)])
def test_equals_brute_force(spark, block, query_block, scale):
    rows = rows_of(np.random.default_rng(block), 400, scale=scale)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    q = topk.quantised(df)
    got = topk.top_k(q, q.where("id % 5 = 0"), 5, block, query_block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 5, 5)


def test_ties_copies_and_odd_rows(spark):
    rows = [(i, [0.5, 0.25]) for i in range(120)]
    rows += [(200, None), (250, [None, 1.0]), (300, [float("nan"), 1.0]), (350, [float("inf")]), (400, []), (450, [2.0]),
             (500, [0.1, 0.2, 0.3]), (None, [1.0, 1.0]), (550, [1e300, 0.0]), (50, [0.5, 0.25]), (100, [9.0, -9.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(4)
    assert sorted(map(tuple, topk.topk_report(df).collect()), key=str) == brute(rows, 5, 50)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (7, [2.0], 1)], SCHEMA)
    assert list(map(tuple, topk.topk_report(df).collect())) == [(0, 1, 7, 256 * 512)]
    assert topk.topk_report(df.where("vec_id = 0")).collect() == []
    assert topk.topk_report(df.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    m = rng.integers(-300, 300, (64, 16)) + np.repeat(rng.integers(-3000, 3000, (4, 16)), 16, 0)
    parts = np.split(m, 4)
    most, least = np.stack([p.max(0) for p in parts]), np.stack([p.min(0) for p in parts])
    b = topk.bounds(m, most, least)
    for k, p in enumerate(parts):
        assert (b[:, k] >= (m @ p.T).max(1)).all()


def test_table_equals_plain_products(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).collect()]
    assert sorted(map(tuple, topk.topk_report(df).collect()), key=str) == brute(rows, 5, 50)


@pytest.mark.parametrize("seed,share", [(1, 0.02), (2, 0.4), (3, 1.0)])
def test_components_of_any_size_and_negative_ids(spark, monkeypatch, seed, share):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(topk, "EXACT_BLOCK", 64)
    rows = []
    for i in range(-150, 150):
        v = (rng.normal(size=4) * 0.5).tolist()
        if rng.random() < share:
            v[rng.integers(4)] = float(rng.choice([2.0**21, -(2.0**21), 2.0**43 + 0.3, 1e300, -1e300, 1.7e308, 2.0**20, 1e10]))
        rows.append((i, v))
    rows += [(200, [2.0**20 - 1 / 256, 0.1]), (250, [2.0**21]), (250, [-(2.0**21)]), (-250, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    got = topk.nearest(df, 5, 10).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 5, 10)
    assert any(r.score is None for r in got) and any(r.query_id < 0 for r in got)
