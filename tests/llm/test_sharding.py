import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tapeworks.llm import sharding


def check(rows, got, shards=16):
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    full = [counts.get(s, 0) for s in range(shards)]
    assert max(full) - min(full) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want


def kept_together(rows, got):
    """Share of links (copies beyond the first of a text) whose ends share a shard with the commonest place."""
    text = dict(rows)
    place = defaultdict(Counter)
    for r in got:
        place[text[r.doc_id]][r.shard] += 1
    copies = sum(sum(c.values()) - 1 for c in place.values())
    return sum(max(c.values()) - 1 for c in place.values()) / max(1, copies)


def test_counts_slots_and_copies_together(spark):
    rng = np.random.default_rng(1)
    texts = [f"text {i}" for i in range(600)] + [f"copy {i}" for i in range(120) for _ in range(rng.integers(2, 5))]
    rows = [(i, t) for i, t in enumerate(rng.permutation(texts).tolist())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.sharding_report(df).collect()
    check(rows, got)
    assert kept_together(rows, got) > 0.8  # an even spread would keep about a tenth
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_group_larger_than_a_shard(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i % 300}") for i in range(900)]
    got = sharding.sharding_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    check(rows, got)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (1, "é😀"), (1, "é😀"), (2, "x" * 100000), (3, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    check(rows, sharding.sharding_report(df).collect())
    assert sharding.sharding_report(df.limit(0)).collect() == []


def test_all_equal_and_all_distinct(spark):
    for make in (lambda i: "same", lambda i: f"t{i}"):
        rows = [(i, make(i)) for i in range(100)]
        check(rows, sharding.sharding_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())


def test_large_group_fills_few_shards(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(4800)]
    got = sharding.sharding_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    check(rows, got)
    place = sorted(Counter(r.shard for r in got if r.doc_id % 3 == 0).values(), reverse=True)
    pairs = sum(n * (n - 1) for n in place) / (1600 * 1599)
    print(place, round(pairs, 3))
    assert sum(place[:6]) >= 0.98 * 1600 and pairs > 0.16


def most_pairs(sizes, room):
    """The most pairs of a group in one shard that any placing of the groups reaches (plain search)."""
    if not sizes:
        return 0
    n, best = sizes[0], 0

    def split(left, shard, room, pairs):
        nonlocal best
        if shard == len(room):
            if not left:
                best = max(best, pairs + most_pairs(sizes[1:], tuple(sorted(room))))
            return
        for x in range(min(left, room[shard]), -1, -1):
            split(left - x, shard + 1, room[:shard] + (room[shard] - x,) + room[shard + 1:], pairs + x * (x - 1) // 2)

    split(n, 0, room, 0)
    return best


def test_pairs_against_the_best_placing(spark):
    """Small tables, all placings tried: near the best on average, and every one within the quotas."""
    rng, shares = np.random.default_rng(11), []
    for _ in range(5):
        shards, sizes = 3, [int(x) for x in rng.integers(2, 7, rng.integers(2, 5))]
        singles = int(rng.integers(3, 9))
        texts = [f"g{i}" for i, n in enumerate(sizes) for _ in range(n)] + [f"s{i}" for i in range(singles)]
        rows = [(i, t) for i, t in enumerate(rng.permutation(texts).tolist())]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        got = sharding.shard_documents(df, ["doc_id"], shards=shards).collect()
        check(rows, got, shards)
        text, place = dict(rows), Counter()
        for r in got:
            place[text[r.doc_id], r.shard] += 1
        total = len(rows)
        best = most_pairs(sizes, tuple(total // shards + (s < total % shards) for s in range(shards)))
        shares.append(sum(n * (n - 1) // 2 for n in place.values()) / best)
    print([round(x, 2) for x in shares])
    assert max(shares) <= 1 and np.mean(shares) >= 0.75


def test_tasks_take_chunks_of_a_hot_group(spark):
    """A third of the rows are one text; the joins of the grouping see it cut by chunk."""
    n = 40_000
    df = spark.range(n, numPartitions=2).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = sharding.shard_documents(df, ["doc_id"], rounds=2)
    place = got.groupBy("shard").count().collect()
    assert {r["count"] for r in place} == {n // 16}
    rows = sharding.tag_rows(df, "chunk", "node").withColumn("chunk", F.shiftright("node", sharding.CHUNK_BITS))
    most = rows.groupBy("text", "chunk").count().agg(F.max("count")).first()[0]
    assert most <= (1 << sharding.CHUNK_BITS) and rows.select("chunk").distinct().count() >= 10
