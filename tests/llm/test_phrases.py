import re

import numpy as np
import pytest

from tapeworks.llm import phrases

SCHEMA = "doc_id long, text string, h int, spans string, seg int"


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, texts, strict=True):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i:i + window])] < d:
                    gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def check(spark, rows, window, parts=4):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    got = phrases.remove_repeats(df, ["doc_id"], window=window).collect()
    want = brute(rows, window)
    assert sorted(map(tuple, got), key=str) == want
    return want


def corpus(rng, n, vocabulary, passages, length=60):
    shared = [list(rng.choice(vocabulary, size=rng.integers(5, length))) for _ in range(passages)]
    rows = []
    for i in range(n):
        w = list(rng.choice(vocabulary, size=rng.integers(0, length)))
        for _ in range(rng.integers(0, 4)):
            p = shared[rng.integers(len(shared))]
            a, b = sorted(rng.integers(0, len(p) + 1, 2))
            at = rng.integers(0, len(w) + 1)
            w[at:at] = p[a:b]
        rows.append((int(i * 7 % n), str(rng.choice([" ", "\n", "\t  "])).join(w)))
    return rows


@pytest.mark.parametrize("window,words,passages", [(6, 400, 10), (7, 400, 40), (4, 6, 5), (5, 2, 3), (1, 30, 3), (2, 50, 6)])
def test_equals_brute_force(spark, window, words, passages):
    rng = np.random.default_rng(window)
    rows = corpus(rng, 120, [f"w{i}" for i in range(words)], passages)
    want = check(spark, rows, window)
    assert sum(r[2] for r in want)


def test_hot_anchors_and_shards(spark, monkeypatch):
    """A third of all documents share a passage; anchors are hot, shards many, tasks small."""
    rng = np.random.default_rng(8)
    rows = corpus(rng, 150, [f"w{i}" for i in range(300)], 20)
    line = " ".join(f"c{i}" for i in range(20))
    rows = [(i, f"{t} {line}" if i % 3 == 0 else t) for i, t in rows] + [(i + 1000, rows[7][1]) for i in range(60)]
    monkeypatch.setattr(phrases, "HOT_ROWS", 10)
    monkeypatch.setattr(phrases, "HOT_PART", 1 << 40)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 100)
    monkeypatch.setattr(phrases, "TASK_WORDS", 150)
    check(spark, rows, 6)


def test_phrase_inside_many_passages():
    """Tiles that many passages hold are no phrases; windows take their place, so that a hit names one place."""
    line = [b"x%d" % i for i in range(7)]
    found = [(i, [b"a%d" % i, b"b%d" % i, *line, b"c%d" % i]) for i in range(50)]
    p = phrases.Phrases(found, 8, 4)
    for i, words in found:
        assert p.locate(1000, words) and p.locate(i, words) == []
        assert {(a, b) for a, b in p.locate(1000, [b"?", *words])} == {(1, 11)}
    hits = list(p.automaton.iter("".join(p.code[w] for w in found[3][1])))
    assert all(i == 3 for _, (i, _, _) in hits)


def test_odd_rows(spark):
    long_ = " ".join(["same"] * 3000)
    t = " ".join(f"v{i}" for i in range(30))
    rows = [(5, t), (5, t), (5, f"{t} more"), (9, t), (None, t), (3, None), (4, ""), (6, " \n\t"), (7, long_), (8, long_ + " end"),
            (-4, f"é日 {t}"), (10, "\x1c\x85 " + t), (2, "v1 v2")]
    want = check(spark, rows, 8)
    assert (None, 30, 0, t) in want and (9, 30, 30, "") in want
    check(spark, [(1, long_)], 8)
    assert phrases.phrases_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()], phrases.WINDOW)
    got = phrases.remove_repeats(df, ["doc_id"]).collect()
    assert sorted(map(tuple, got), key=str) == want
