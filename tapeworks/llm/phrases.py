"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` consecutive words.  Words of a document go if a window
covers them whose word sequence also starts in a document with a smaller id.

1. *Anchors.*  Of the ``GRAM``-word grams inside a window the one with the
   least hash is its anchor, so equal windows have equal anchors and one word
   in thirteen starts one.  An anchor that only one document has cannot stand
   in a recurring window.  Anchors are counted by partial aggregates; those of
   many occurrences (a list whose length is bounded) are joined by broadcast,
   all others by shuffle.
2. *Recurring passages.*  Every anchor belongs to the shard of the smallest
   document that has it.  Stretches of windows with recurring anchors are cut
   out of their documents, a segment per document and shard, numbered by
   document.  The hash of each window in them finds the first place of a
   sequence that several segments have; consecutive first places are a passage.
3. *Automata.*  A shard's passages become one Aho-Corasick automaton.  Words
   are numbered and written in a fixed number of letters.  A passage is cut
   into tiles of ``GRAM`` words, so each of its windows holds a whole tile; a
   tile that names one place is a phrase, and a window without such a tile is
   one itself.  So a hit always names one place in one passage.
4. *Streaming.*  The shard's segments run through its automaton, dealt over as
   many tasks as their words need (each with the shard's passages).  A hit is
   extended word by word along its passage; runs of ``WINDOW`` words or more
   from a smaller document are removed.  This comparison is exact, so a
   collision of hashes can't remove a word.  It could hide a window behind
   another one's first place; among n recurring windows one is hidden with a
   chance of about n / 2^64.

Nothing is capped: texts, groups of copies and passages count whole.  A task
holds one shard's passages and a bounded share of its segments, at least one.

Defined results: a null text has no words; texts under ``WINDOW`` words stay
whole; rows without an id stay whole and are no source; rows that repeat an id
are one document with several texts, they never remove each other's words;
empty table, empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WorkTables, partitions, tag_rows

WINDOW = 50
GRAM = 25
#: An anchor with at least so many rows, and at least this part of all, is joined by broadcast.
HOT_ROWS = 10_000
HOT_PART = 1000
SHARD_WORDS = 250_000
TASK_WORDS = 500_000
MOST_SHARDS = 1 << 20
BATCH_BYTES = 4 << 20
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class WordHashes(dict):
    """64-bit hash of each word seen; emptied when it holds a million."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest
        if len(self) > 1_000_000:
            self.clear()
        self[word] = out = xxh3_64_intdigest(word)
        return out

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.uint64, sum(map(len, texts)))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, by differences of polynomial prefix sums."""
    out = np.empty(max(0, len(h) - k + 1), np.uint64)
    if not len(out):
        return out
    size = min(len(out), BLOCK)
    up = np.full(size + k - 1, BASE)
    down = np.full(size, BASE_INVERSE)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    for i in range(0, len(out), size):
        part = h[i:i + size + k - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        n = len(part) - k + 1
        out[i:i + n] = mixed((sums[k:] - sums[:-k]) * down[:n])
    return out


def sliding_min(v: np.ndarray, span: int) -> np.ndarray:
    size = 1
    while size * 2 <= span:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (span - size)], v[span - size:]) if size < span else v


def anchors_of(texts: list[list[bytes]], hashes: WordHashes, window: int = WINDOW, gram: int = GRAM):
    """(text, anchor, first window, last window) of each run of windows with one anchor."""
    count = np.array([len(t) for t in texts], np.int64)
    h = hashes.of(texts)
    if len(h) < window:
        return [np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64)]
    anchor = sliding_min(sequence_hashes(h, gram), window - gram + 1)
    begin = np.cumsum(count) - count
    text = np.repeat(np.arange(len(texts)), count)[:len(anchor)]
    place = np.arange(len(anchor)) - begin[text]
    at = np.flatnonzero(place + window <= count[text])  # windows inside one text
    text, place, anchor = text[at], place[at], anchor[at]
    new = np.r_[True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])][:len(at)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)][:len(first)] - 1
    return text[first], anchor[first], place[first], place[last]


def text_groups(texts: list[bytes]):
    """Ranges of texts of about ``BATCH_BYTES``."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def named(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, h, text): documents are named by id and a hash of their text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(t).alias("h"), t.alias("text"))


def anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            texts = binary(b.column(2))
            for i, j in text_groups(texts):
                text, anchor, first, last = anchors_of([t.split() for t in texts[i:j]], hashes, window, gram)
                rows = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(anchor.view(np.int64)), pa.array(first), pa.array(last)],
                    names=["doc_id", "h", "a", "first", "last"])

    return docs.mapInArrow(run, "doc_id long, h long, a long, first long, last long")


def recurring_runs(anchors: DataFrame, tables: WorkTables) -> DataFrame:
    """(doc_id, h, first, last, m): runs whose anchor several documents have, m the smallest of them."""
    several = tables.keep(anchors.groupBy("a").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("_x"), F.count("a").alias("n"))
                          .where("m < _x").drop("_x"), "several")
    hot_from = max(HOT_ROWS, anchors.count() // HOT_PART)  # so at most HOT_PART anchors are hot
    hot = F.broadcast(several.where(F.col("n") >= hot_from).drop("n"))
    some = anchors.join(hot, "a")
    rest = anchors.join(hot.select("a"), "a", "left_anti").join(several.where(F.col("n") < hot_from).drop("n"), "a")
    return tables.keep(some.unionByName(rest).select("doc_id", "h", "first", "last", "m"), "runs")


def numbered(rows: DataFrame, order: list[str], tables: WorkTables, out: str) -> DataFrame:
    """A gapless number in the given order: a task's place in the order, then the row's place in the task."""
    laid = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    laid = tables.keep(tag_rows(laid), "laid")
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (laid.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))  # a row per writing task
               .select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    place = F.col("_off") + F.col("_pos").bitwiseAND((1 << 33) - 1)
    return laid.join(F.broadcast(offsets), "_chunk").withColumn(out, place).drop("_chunk", "_pos", "_off")


def stretches(runs: list[dict]) -> list[tuple[int, int]]:
    """Runs of windows joined where they meet or overlap: (first, last)."""
    out: list[list[int]] = []
    for a, b in sorted((r["first"], r["last"]) for r in runs):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SEGMENT = "seg long, shard long, doc_id long, h long, begins array<long>, pieces array<string>, words long"


def segments(docs: DataFrame, laid: DataFrame, window: int) -> DataFrame:
    """The stretches' words, a row per document and shard."""
    rows = (docs.dropDuplicates(["doc_id", "h"]).join(laid, ["doc_id", "h"])
            .select("seg", "shard", "doc_id", "h", "runs", "text"))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                words = binary(row.column(5))[0].split()
                cut = stretches(row.column(4)[0].as_py())
                pieces = [b" ".join(words[s:e + window]).decode() for s, e in cut]
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:4], pa.array([[s for s, _ in cut]], pa.list_(pa.int64())), pa.array([pieces], pa.list_(pa.string())),
                     pa.array([sum(e - s + window for s, e in cut)], pa.int64())],
                    names=["seg", "shard", "doc_id", "h", "begins", "pieces", "words"])

    return rows.mapInArrow(run, SEGMENT)


def first_places(segs: DataFrame, window: int, bits: int) -> DataFrame:
    """(seg, at): places of the first windows of word sequences that several segments have."""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            for seg, begins, pieces in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                for s, p in zip(begins, pieces, strict=True):
                    key = sequence_hashes(hashes.of([p.encode().split()]), window)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array((seg << bits) + s + np.arange(len(key)))], names=["key", "place"])

    rows = segs.select("seg", "begins", "pieces").mapInArrow(run, "key long, place long")
    # fixed-width buffers: one row per sequence and task is shuffled, however many documents have it
    seen = rows.groupBy("key").agg(F.min("place").alias("one"), F.max("place").alias("other"))
    return (seen.where(F.shiftright("one", bits) != F.shiftright("other", bits))
            .select(F.shiftright("one", bits).alias("seg"), F.col("one").bitwiseAND((1 << bits) - 1).alias("at")))


def passages(segs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(shard, m, words): the recurring passages, from the first document that has them."""
    rows = (segs.join(places.groupBy("seg").agg(F.sort_array(F.collect_list("at")).alias("at")), "seg")
            .select("shard", "doc_id", "begins", "pieces", "at"))

    def run(batches):
        for b in batches:
            for shard, doc, begins, pieces, at in zip(*[c.to_pylist() for c in b.columns], strict=True):
                out, at = [], np.array(at)
                for s, p in zip(begins, pieces, strict=True):
                    words = p.encode().split()
                    own = at[(at >= s) & (at <= s + len(words) - window)] - s
                    for run_ in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1) if len(own) else []:
                        out.append(b" ".join(words[run_[0]:run_[-1] + window]).decode())
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(out), pa.int64()), pa.array([doc] * len(out), pa.int64()),
                                                  pa.array(out, pa.string())], names=["shard", "m", "passage"])

    return rows.mapInArrow(run, "shard long, m long, passage string")


class Phrases:
    """One automaton over the phrases of some passages: (source document, words)."""

    def __init__(self, found: list[tuple[int, list[bytes]]], window: int = WINDOW, gram: int = GRAM):
        import ahocorasick
        self.window, self.gram = window, gram
        self.source = [m for m, _ in found]
        number: dict[bytes, int] = {}
        self.ids = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for _, words in found]
        self.width = 1
        while 64 ** self.width < len(number) + 1:
            self.width += 1
        # letters differ by their place in a word, so a phrase can only match at a word's start
        self.code = {w: "".join(chr(0x100 + 64 * p + (i >> 6 * p) % 64) for p in range(self.width)) for w, i in number.items()}
        self.number, self.gap = number, "\x01" * self.width
        tiles: dict[str, list[tuple[int, int]]] = {}
        coded = ["".join(map(self.code.__getitem__, words)) for _, words in found]
        for i, (text, ids) in enumerate(zip(coded, self.ids, strict=True)):
            for o in {*range(0, len(ids) - gram + 1, gram), len(ids) - gram}:
                tiles.setdefault(text[o * self.width:(o + gram) * self.width], []).append((i, o))
        self.automaton = ahocorasick.Automaton()
        single = [np.zeros(len(ids) + 1, np.int64) for ids in self.ids]
        for tile, places in tiles.items():
            if len(places) == 1:
                self.automaton.add_word(tile, (*places[0], gram))
                single[places[0][0]][places[0][1]] = 1
        for i, text in enumerate(coded):
            covered = np.cumsum(single[i])  # single tiles that start up to each word
            for o in range(len(self.ids[i]) - window + 1):
                if covered[o + window - gram] == (covered[o - 1] if o else 0):
                    self.automaton.add_word(text[o * self.width:(o + window) * self.width], (i, o, window))
        if len(self.automaton):
            self.automaton.make_automaton()

    def common(self, text: np.ndarray, p: int, passage: np.ndarray, o: int, step: int) -> int:
        """How many words agree from these places on (step 1) or before them (step -1)."""
        n, size = 0, 64
        most = min(len(text) - p, len(passage) - o) if step > 0 else min(p, o)
        while n < most:
            size = min(size, most - n)
            a, b = (text[p + n:p + n + size], passage[o + n:o + n + size]) if step > 0 else \
                (text[p - n - size:p - n][::-1], passage[o - n - size:o - n][::-1])
            differ = np.flatnonzero(a != b)
            if len(differ):
                return n + int(differ[0])
            n, size = n + size, size * 2
        return n

    def locate(self, doc: int, words: list[bytes]) -> list[tuple[int, int]]:
        """Words [start, stop) that a passage of a smaller document also has, in runs of a window or more."""
        if len(words) < self.window or not len(self.automaton):
            return []
        text, out, seen = None, [], {}
        for end, (i, o, size) in self.automaton.iter("".join([self.code.get(w, self.gap) for w in words])):
            p = (end + 1) // self.width - size
            if self.source[i] >= doc or seen.get((i, p - o), -1) >= p + size:
                continue
            if text is None:
                text = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
            left = self.common(text, p, self.ids[i], o, -1)
            stop = p + self.common(text, p, self.ids[i], o, 1)
            seen[i, p - o] = stop
            if stop - p + left >= self.window:
                out.append((p - left, stop))
        return out


def located(segs: DataFrame, found: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, h, start, stop): what the shards' automata find, words removed by a run."""
    share = (segs.groupBy("shard").agg(F.sum("words").alias("_w"))
             .select("shard", F.expr(f"1 + _w div {TASK_WORDS}").alias("salts")))
    share = F.broadcast(share)  # at most MOST_SHARDS rows of two numbers
    left = segs.join(share, "shard").withColumn("salt", F.pmod(F.xxhash64("seg"), F.col("salts"))).select(
        "shard", "salt", "doc_id", "h", "begins", "pieces")
    right = found.join(share, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "m", "passage")

    def run(key, segment: pd.DataFrame, passage: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(passage):
            phrases = Phrases([(m, p.encode().split()) for m, p in zip(passage["m"], passage["passage"], strict=True)], window, gram)
            for doc, h, begins, pieces in zip(segment["doc_id"], segment["h"], segment["begins"], segment["pieces"], strict=True):
                for s, p in zip(begins, pieces, strict=True):
                    out += [(doc, h, s + a, s + b) for a, b in phrases.locate(doc, p.encode().split())]
        return pd.DataFrame(out, columns=["doc_id", "h", "start", "stop"]).astype("int64")

    return (left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt"))
            .applyInPandas(run, "doc_id long, h long, start long, stop long"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int | None = None) -> DataFrame:
    """(doc_id, h, spans): words to remove, per id and text (h: hash of the text)."""
    spark, gram = docs.sparkSession, gram or max(1, window // 2)
    tables = WorkTables(spark, "phrases")
    docs = named(docs, id_col, text).where("doc_id IS NOT NULL")
    anchors = tables.keep(anchor_rows(docs, window, gram), "anchors")
    runs = recurring_runs(anchors, tables)
    tables.drop(anchors)
    size, last = runs.agg(F.sum(F.col("last") - F.col("first") + 1), F.max("last")).first()
    shards = min(MOST_SHARDS, 1 + (size or 0) // SHARD_WORDS)
    bits = max(1, int(last or 0).bit_length())
    per_shard = (runs.withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards))).groupBy("doc_id", "h", "shard")
                 .agg(F.collect_set(F.struct("first", "last")).alias("runs")))
    laid = numbered(per_shard, ["doc_id", "h", "shard"], tables, "seg")
    segs = tables.keep(segments(docs, laid, window), "segments")
    most = segs.agg(F.max("seg")).first()[0] or 0
    if most.bit_length() + bits > 63:
        raise ValueError(f"{most} segments of up to 2^{bits} words do not fit one number")
    found = tables.keep(passages(segs, first_places(segs, window, bits), window), "passages")
    return tables.keep(located(segs, found, window, gram).groupBy("doc_id", "h").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   gram: int | None = None) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_removed`` and ``kept``: the words that stay, joined by one space."""
    spans = repeated_spans(docs, id_col, text, window, gram)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], F.col(id_col).cast("long").alias("_id"), F.xxhash64(t).alias("_h"), t.alias("_t"))
    on: Column = (rows["_id"] == spans["doc_id"]) & (rows["_h"] == spans["h"])
    rows = rows.join(spans, on, "left").select(*[rows[c] for c in keep], "_t", "spans")

    def run(batches):
        for b in batches:
            texts, spans = binary(b.column(len(keep))), b.column(len(keep) + 1).to_pylist()
            for i, j in text_groups(texts):
                n, gone, kept = [], [], []
                for t, cut in zip(texts[i:j], spans[i:j], strict=True):
                    words = t.split()
                    n.append(len(words))
                    if cut:
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, [c["start"] for c in cut], 1)
                        np.add.at(edge, [c["stop"] for c in cut], -1)
                        words = [words[x] for x in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, j - i) for c in b.columns[:len(keep)]], pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=[*keep, "n_words", "n_removed", "kept"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:len(keep)])
    return rows.mapInArrow(run, schema + "n_words long, n_removed long, kept string")


def phrases_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    done = remove_repeats(docs, ["doc_id"])
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS k
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs WHERE doc_id IS NOT NULL)),
least AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (
  SELECT r, list_distinct(flatten(list(range(i, i + {WINDOW})))) AS g FROM windows JOIN least USING (k) WHERE m < doc_id GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]), ' ') END) AS kept_sha256
FROM docs LEFT JOIN gone USING (r)
"""
