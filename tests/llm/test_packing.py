import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapeworks.llm import packing

TEXTS = [None, "", "one", "é😀 ünï\n\n  tabs\t\there", "word " * 1022, "word " * 1023, "word " * 1024, "x y z " * 9000, "<|endoftext|> a",
         " " * 5000, "a" * 5000, "don't 12345 !!!", "日本語 текст"]


def check(rows, got, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        starts = sorted({0} | {len(ids) - k * capacity for k in range(1, len(ids) // capacity + 1)})
        for k, (s, e) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            want[i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())] += 1
    have, bins = defaultdict(int), defaultdict(list)
    for r in got:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(spark):
    rows = list(enumerate(TEXTS)) + [(2, "one"), (None, "no id"), (7, TEXTS[7])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece int").repartition(3)
    check(rows, packing.packing_report(df).collect(), 1024)


def test_many_chunks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(1, 60))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    n = check(rows, packing.pack(df, ["doc_id"], capacity=64, chunk_rows=50).collect(), 64)
    encode = packing.load_tokenizer()
    total = sum(len(encode(t)) + 1 for _, t in rows)
    assert n <= 1.12 * total / 64


def test_evolution_never_loses_pieces_and_never_gets_worse():
    rng = random.Random(1)
    length = np.array([rng.randint(1, 1023) for _ in range(600)])
    people = packing.founders(length, 1024, 4, rng)
    first = max(packing.fitness(p, length, 1024) for p in people)
    end = packing.evolve(length, people, 1024, 6, rng)
    assert packing.fitness(end[0], length, 1024) >= first
    for p in end:
        assert len(p) == 600 and np.bincount(p, weights=length).max() <= 1024 and (np.bincount(p) > 0).all()
    child = packing.cross(people[0], people[1], length, 1024, rng)
    assert np.bincount(child, weights=length).max() <= 1024 and len(child) == 600


def test_empty_table(spark):
    assert packing.packing_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


ENCODE = packing.load_tokenizer()
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_equal_the_tokenizers_library(text):
    assert ENCODE(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers_on_whole_corpus_texts():
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    texts = [t for t in texts if t]
    for t, e in zip(texts, TOKENIZER.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(ENCODE(t)) == e.ids
