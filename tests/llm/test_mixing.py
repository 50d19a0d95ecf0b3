import random
import re
from collections import defaultdict

import numpy as np

from tapeworks.llm import mixing


def brute_targets(sizes):
    """{source: words} -> {source: target} by the rule, in plain Python."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        w = sum(weight[s] for s in order if s not in stopped) or 1
        target = {s: 3.0 * sizes[s] if s in stopped else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in stopped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        stopped |= over


def table(rng, n):
    sources = ["a", "b", "B", "é", "😀", "", None, "tiny", "z"]
    p = [.34, .2, .1, .1, .1, .05, .05, .01, .05]
    out = []
    for i in range(n):
        k = int(rng.choice([0, 1, 5, 20, 100, 700], p=[.02, .08, .3, .3, .2, .1]))
        out.append((i if i % 50 else None, " ".join(["w"] * k) if i % 33 else None, sources[rng.choice(len(sources), p=p)], i))
    return out + [(7, "same row again", "a", 1)] * 40


def check(rows, got, slack):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for i, r in enumerate(rows)}
    by = defaultdict(int)
    for i, r in enumerate(rows):
        by[r[2]] += size[i]
    want = brute_targets(dict(by))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == by[r.source] and abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    assert sorted(r.size for r in got) == sorted(size.values())
    for s, t in want.items():
        assert abs(taken[s] - t) <= slack, (s, taken[s], t)


def test_report(spark):
    rows = table(np.random.default_rng(1), 3000)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mixing_report(df.repartition(3)).collect()
    assert len(got) == len(rows)
    check(rows, got, 700)
    again = mixing.mixing_report(df.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_many_chunks_and_levels(spark):
    rows = table(np.random.default_rng(2), 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(4)
    got = mixing.mix(df, ["doc_id", "source"], chunk_rows=16, fan_in=4).collect()
    assert len(got) == len(rows)
    check(rows, got, 700)


def test_flight_keeps_totals_and_decides_all_but_two():
    rng = np.random.default_rng(3)
    x, p = rng.integers(0, 500, 1000), np.full(1000, 0.37)
    out = mixing.flight(x, p, random.Random(1))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ x - p @ x) < 1e-3


def test_inclusion_probabilities_hold():
    x = np.array([5, 9, 1, 30, 7, 7, 2, 11])
    total = sum(mixing.flight(x, np.full(8, .3), random.Random(i)) for i in range(4000)) / 4000
    assert np.abs(total - .3).max() < .04


def test_equal_sizes(spark):
    df = spark.createDataFrame([(i, "a b", "s") for i in range(9)], "doc_id long, text string, source string")
    assert sum(r.taken for r in mixing.mixing_report(df).collect()) == 18


def test_no_words_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mixing_report(df).collect()] == [(0.0, 0)] * 2
    assert mixing.mixing_report(df.limit(0)).collect() == []
