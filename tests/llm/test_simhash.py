import numpy as np
import pytest
import xxhash

from tapeworks.llm import simhash
from tapeworks.llm.common import WorkTables


def brute_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w.encode() for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, bits=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


BASE = "the quick brown fox jumps over the lazy dog and runs into the dark forest where nobody lives " * 6
TEXTS = [None, "", " \t\n", "One", "one", "ONE two", "é😀 Ünï ß", "a b c", "A B\x0bC", BASE, BASE.upper(), BASE + " end",
         BASE + " x y", "word " * 70000, "İstanbul KK", BASE * 3]


def test_fingerprints_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, fp int").repartition(3)
    for r in simhash.fingerprints(df, ["doc_id"]).collect():
        assert r.fp % 2**64 == brute_print(TEXTS[r.doc_id]), r.doc_id


def test_report_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "one"), (None, "lonely null id row"), (9, BASE), (5, "ONE two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = simhash.simhash_report(df).collect()
    prints = [brute_print(t) for _, t in rows]
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in
                   zip(rows, prints, brute_components([i for i, _ in rows], prints))), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def clustered(rng, n, heads=12):
    centres = rng.integers(0, 2**63, heads, dtype=np.uint64)
    out = set()
    while len(out) < n:
        x = int(centres[rng.integers(heads)])
        for _ in range(rng.integers(0, 5)):
            x ^= 1 << int(rng.integers(64))
        out.add(x)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("leaf", [8, 64, 100_000])
def test_trie_join_finds_every_link(spark, leaf):
    """Crowded prefixes: a dozen centres, so nodes must go on splitting."""
    values = clustered(np.random.default_rng(leaf), 600)
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    tables = WorkTables(spark, "test")
    got = {r.node % 2**64: r.root % 2**64 for r in simhash.components(
        simhash.links(tables.keep(prints, "p"), tables, 2, leaf), tables).collect()}
    ids = [int(v) for v in values]
    signed = [int(v) for v in values.view(np.int64)]
    want = brute_components(signed, ids)
    assert {i: w % 2**64 for i, w in zip(ids, want)} == {i: got.get(i, i) for i in ids}


def test_walk_yields_exactly_the_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    v = clustered(np.random.default_rng(5), 300)
    got = {(int(i), int(j)) for a, b in simhash.walk(v, v, 3, True) for i, j in zip(a, b)}
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3}
    assert got == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    out = simhash.components(edges, WorkTables(spark, "test")).collect()
    assert len(out) == 300 and {r.root for r in out} == {0}


def test_empty_table(spark):
    assert simhash.simhash_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
