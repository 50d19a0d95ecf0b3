import zlib

import numpy as np

from tapeworks.llm import toxicity

SMALL, MIDDLE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def read(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def brute_grams(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text).encode()
    b = b" " + folded + b" "
    return {b[i:i + n] for n in toxicity.SIZES for i in range(len(b) - n + 1)}


def packed(gram):
    return len(gram) << 56 | int.from_bytes(gram, "big")


def test_grams_match_brute_force():
    for text in ["", "a", "ab", "Hé\tLLO\nthere 😀", "x" * 300]:
        got = {int(g) for a in toxicity.grams(text.encode()) for g in a}
        assert got == {packed(g) for g in brute_grams(text)}


def test_counts_match_brute_force(spark):
    rows = [(True, b"you scum"), (True, b"scum!"), (False, b"hello you"), (False, b"")]
    got = {(r.gram, r.toxic, r.clean) for r in toxicity.gram_counts(
        spark.createDataFrame(rows, "toxic boolean, _text binary").repartition(3)).collect()}
    want = {}
    for y, t in rows:
        for g in brute_grams(t.decode()):
            want.setdefault(packed(g), [0, 0])[y] += 1
    assert got == {(g, n[1], n[0]) for g, n in want.items()}


def test_scores_match_brute_force(spark):
    docs, labels = read(spark, SMALL)
    model = toxicity.fit(docs, labels)
    weight = dict(zip(model.grams.tolist(), model.weights, strict=True))
    for r in toxicity.score(docs.limit(60), ["text"], model).collect():
        z = model.bias + sum(weight.get(packed(g), 0.0) for g in brute_grams(r.text))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_held_out_quality_and_split(spark):
    docs, labels = read(spark, MIDDLE)
    got = toxicity.toxicity_report(docs, labels).toPandas()
    want = [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]
    assert got["held_out"].tolist() == want and len(got) == docs.count()
    known = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert len(known) > 1000
    p, y = known["predicted"] == 1, known["toxic"] == 1
    assert (p & y).sum() / y.sum() > 0.8 and (p & ~y).sum() / (~y).sum() < 0.02


def test_held_out_labels_never_matter(spark):
    docs, labels = read(spark, SMALL)
    flipped = labels.withColumn("toxic", (1 - labels["toxic"]).cast("int")).where(toxicity.held_out()).union(
        labels.where(~toxicity.held_out()).select("doc_id", "quality", "toxic").select("doc_id", "quality", "toxic"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped.select(*labels.columns))
    assert (a.grams == b.grams).all() and np.allclose(a.weights, b.weights) and np.isclose(a.bias, b.bias)


def test_odd_rows(spark):
    _, labels = read(spark, SMALL)
    rows = [(None, None, 1), (None, "scum idiot trash", 2), (1, "", 3), (1, "", 3), (2, "x" * 200000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    train, _ = read(spark, SMALL)
    out = toxicity.score(docs, ["doc_id"], toxicity.fit(train, labels)).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    none = toxicity.toxicity_report(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.held_out for r in none if r.doc_id is None} == {False}
    assert toxicity.toxicity_report(docs.limit(0), labels).collect() == []
