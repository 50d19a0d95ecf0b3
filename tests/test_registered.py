"""Every registered query against its oracle SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tapeworks.plans.registered import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF_SMALL}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "status" in df.columns
