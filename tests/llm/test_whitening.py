import math
from fractions import Fraction

import numpy as np
import pytest

from tapeworks.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string"


def brute(rows):
    """(kept ids, x, exact covariance as Fractions)."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(1024 * c) + 100000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in kept]
    n = len(x)
    s = [sum(r[d] for r in x) for d in range(dims)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(dims)] for i in range(dims)]
    return [i for i, _ in kept], x, s, cov


def check(spark, rows, parts=3, error=1e-8):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(parts)
    got = whitening.whitening_report(df).toPandas()
    ids, x, s, cov = brute(rows)
    n, dims = len(x), len(cov)
    k = min(8, dims)
    assert len(got) == n * k and set(got["n"]) == {n}
    v = np.array([[float(c) for c in r] for r in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    expect = sorted((i, sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True))) for i, r in zip(ids, x, strict=True))
    own = got[got["component"] == 1]
    assert sorted(zip(own["vec_id"], own["deviation"], strict=True)) == expect
    for c in range(k):
        own = got[got["component"] == c + 1]
        np.testing.assert_allclose(own["explained"], e[c] / np.trace(v), rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < error
    return got, np.array(x, float), s, n, e, u, ids


def test_equals_exact_covariance(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 12)) * 0.2 + rng.normal(size=12) + rng.normal(size=(300, 12)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    got, x, s, n, e, u, ids = check(spark, rows)
    want = (x - np.array(s) / n) @ u / np.sqrt(e)
    for c in range(8):
        own = got[got["component"] == c + 1].set_index("vec_id")["whitened"].reindex(ids).to_numpy()
        sign = np.sign(own @ want[:, c])
        np.testing.assert_allclose(own * sign, want[:, c], rtol=1e-6, atol=1e-8)


def test_far_from_zero_and_uneven_scales(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=5) * [1e-2, 1, 30, 1e3, 1e-2] + [1e6, -1e6, 0, 5e5, 1]).tolist()) for i in range(200)]
    check(spark, rows, error=1e-4)  # eigenvalues twelve powers of ten apart


def test_scatter_is_exact_at_any_size():
    rng = np.random.default_rng(2)
    for high in (1, 2, 900, 1 << 20, 1 << 40, 1 << 62):
        x = rng.integers(-high, high + 1, (131, 5))
        x[:, 3] = 7
        s, c = whitening.scatter(x)
        o = x.astype(object)
        assert list(s) == list(o.sum(axis=0))
        assert (c == np.triu(o.T @ o)).all()
        values = [int(y) for y in c.ravel()]
        parts = [p.to_pylist() for p in whitening.limbs(values)]
        assert [sum(p[i] << 32 * k for k, p in enumerate(parts)) for i in range(len(values))] == values


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, [None, 1.0]), (3, [nan]), (4, [inf, 0.0]), (5, [0.5, 0.25, -0.125]), (6, [0.1]), (6, [0.1]),
            (7, []), (8, [0.3, -0.9, 0.2]), (9, [-0.0, 0.0, 0.0])]
    got, *_ = check(spark, rows)
    assert sorted(set(got["vec_id"])) == [5, 6, 7, 8, 9] and (got["vec_id"] == 6).sum() == 6
    df = spark.createDataFrame([(None, [0.5, 1.0], 1, "x"), (3, [0.25, 1.0], 1, "x")], SCHEMA)
    out = whitening.whitening_report(df).toPandas()
    assert len(out) == 4 and out["vec_id"].isna().sum() == 2
    flat = out[out["component"] == 2]
    assert flat["whitened"].isna().all()  # no variance there
    np.testing.assert_allclose(np.abs(out[out["component"] == 1]["whitened"]), 1.0)


def test_huge_values(spark):
    rows = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(6)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = whitening.whitening_report(df).toPandas()
    assert len(out) == 12 and out["deviation"].isna().all()  # no long holds them
    model = whitening.fit(whitening.fit_rows(df))
    text = whitening.apply(whitening.fit_rows(df), ["vec_id"], model).toPandas()["deviation"]
    assert text.map(int).min() > 1 << 120


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])], [(1, [])]])
def test_few_or_constant_rows(spark, rows):
    out = whitening.whitening_report(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).toPandas()
    dims = max((len(v) for _, v in rows if v), default=0)
    assert len(out) == dims * sum(v is not None for _, v in rows)
    assert out["whitened"].isna().all() and out["identity_error"].isna().all()


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    out = whitening.whitening_report(df).toPandas()
    assert len(out) == 8 * df.count() and out["identity_error"].iloc[0] < 1e-9
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows])
    e = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    np.testing.assert_allclose(out.groupby("component")["explained"].first(), e[:8] / e.sum(), rtol=1e-9)
