"""Toxicity: a character n-gram linear classifier with naive Bayes features.

A feature is the presence of an n-gram of 3 to 6 bytes in the text (A-Z
lower-cased, white space as one blank byte, a blank before and after).  An
n-gram of up to 7 bytes fits a 64-bit integer with its length, so features are
exact, without hash collisions.  Spark counts in how many toxic and in how
many clean training texts each n-gram occurs; the log of the ratio of the two
smoothed rates is the feature's scale.  The ``FEATURES`` n-grams that depend
on the class most (chi-square) enter an L2-regularised logistic regression on
the scaled features.  Every text is then scored whole in one pass.

Bounds of the fit, the only ones: ``FIT_ROWS`` labelled rows per class, taken
by the smallest hashes of their ids, and ``FEATURES`` features.  Labels are
read only where crc32 of the id's text modulo 3 is not 1.

Defined results: a null text counts as empty and is scored by the bias;
without labels of both classes every score is the smoothed share of toxic
labels (one half without any); a null id is never held out; repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkTables

SIZES = (3, 4, 5, 6)
FIT_ROWS = 4000
FEATURES = 8192
LEAST_TEXTS = 3
PENALTY = 1.0
THRESHOLD = 0.7
TABLE_BITS = 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


@dataclass(frozen=True)
class Model:
    grams: np.ndarray  # sorted
    weights: np.ndarray  # of the scaled features, times their scale
    bias: float


def grams(text: bytes) -> list[np.ndarray]:
    """Every n-gram of the text as an integer: its length in the top byte, its bytes below."""
    a = np.frombuffer(b" " + text.translate(FOLD) + b" ", np.uint8).astype(np.uint64)
    out, held = [], a
    for n in range(2, max(SIZES) + 1):
        if len(a) < n:
            break
        held = (held[:-1] << np.uint64(8)) | a[n - 1:]
        if n in SIZES:
            out.append(held | np.uint64(n << 56))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, rows: int) -> DataFrame:
    """(toxic, _text) of at most ``rows`` ids per class."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg((F.max("toxic") > 0).alias("toxic")))
    order = [F.xxhash64(F.lit("fit"), F.col(id_col)), F.col(id_col)]
    chosen = (known.where("toxic").orderBy(*order).limit(rows)
              .union(known.where("not toxic").orderBy(*order).limit(rows)))
    # bounded by its two limits: at most 2 x rows ids
    return (docs.select(id_col, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
            .join(F.broadcast(chosen.withColumnRenamed(id_col, "_id")), F.col(id_col) == F.col("_id"))
            .groupBy("_id", "toxic").agg(F.min("_text").alias("_text")).select("toxic", "_text"))


def gram_counts(train: DataFrame) -> DataFrame:
    """(gram, toxic, clean): in how many texts of each class the n-gram occurs."""
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                flags = part.column(0).to_numpy(zero_copy_only=False)
                seen: list[list[np.ndarray]] = [[], []]
                for y, t in zip(flags, part.column(1), strict=True):
                    seen[int(y)] += [np.unique(g) for g in grams(t.as_py())]
                counted = [np.unique(np.concatenate(s), return_counts=True) if s else
                           (np.empty(0, np.uint64), np.empty(0, np.int64)) for s in seen]
                both = np.union1d(counted[0][0], counted[1][0])
                n = np.zeros((2, len(both)), np.int64)
                for k in (0, 1):
                    n[k, np.searchsorted(both, counted[k][0])] = counted[k][1]
                yield pa.RecordBatch.from_arrays([pa.array(both.view(np.int64)), pa.array(n[1]), pa.array(n[0])],
                                                 names=["gram", "toxic", "clean"])

    return (train.select("toxic", "_text").mapInArrow(run, "gram long, toxic long, clean long")
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def present(text: bytes, table: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Indices of the model's n-grams that occur in the text."""
    found = []
    shift = np.uint64(64 - TABLE_BITS)
    for g in grams(text):
        likely = g[table[(g * SPREAD) >> shift]]
        if len(likely):
            at = np.searchsorted(names, likely)
            at[at == len(names)] = 0
            found.append(at[names[at] == likely])
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def lookup(names: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << TABLE_BITS, bool)
    table[(names * SPREAD) >> np.uint64(64 - TABLE_BITS)] = True
    return table


def regress(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, penalty: float = PENALTY,
            steps: int = 20, inner: int = 30) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on scaled presence features (Newton, conjugate gradients)."""
    n, f = len(y), len(scale)
    length = np.array([len(r) for r in rows], np.int64)
    col, ends = np.concatenate(rows), np.append(0, np.cumsum(length))
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], 1 << 20)), [0, n]))
    parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))  # rows of about a million features

    def margin(v: np.ndarray) -> np.ndarray:
        weight, out = scale * v[:f], np.zeros(n)
        for i, j in parts:
            at = np.repeat(np.arange(j - i), length[i:j])
            out[i:j] = np.bincount(at, weight[col[ends[i]:ends[j]]], j - i)
        return out + v[f]

    def back(g: np.ndarray) -> np.ndarray:
        out = np.zeros(f)
        for i, j in parts:
            out += np.bincount(col[ends[i]:ends[j]], np.repeat(g[i:j], length[i:j]), f)
        return np.append(scale * out, g.sum())

    ridge = np.append(np.full(f, penalty), 1e-6)  # the bias is free

    def loss(v: np.ndarray) -> float:
        z = margin(v)
        return float(np.logaddexp(0, np.where(y > 0, -z, z)).sum() + ridge @ v ** 2 / 2)

    v, now = np.zeros(f + 1), n * float(np.log(2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(margin(v), -40, 40)))
        gradient, curve = back(p - y) + ridge * v, p * (1 - p)
        step, rest = np.zeros(f + 1), -gradient
        way, size = rest, float(rest @ rest)
        for _ in range(inner):
            if size < 1e-2 * float(gradient @ gradient):
                break
            bent = back(curve * margin(way)) + ridge * way
            far = size / float(way @ bent)
            step, rest = step + far * way, rest - far * bent
            size, old = float(rest @ rest), size
            way = rest + size / old * way
        part = 1.0
        while loss(v + part * step) > now and part > 1e-4:
            part /= 2
        v = v + part * step
        last, now = now, loss(v)
        if last - now < 1e-6 * n:
            break
    return v[:f], float(v[f]) + centring(margin(v), y)


def centring(z: np.ndarray, y: np.ndarray) -> float:
    """What to add to the bias so that the threshold lies midway between the classes, if they are apart.

    A text with a single telling word scores less than the training texts,
    which hold several; far from the clean ones, it should still count.
    """
    clean, toxic = np.quantile(z[y == 0], 0.999), np.quantile(z[y == 1], 0.01)
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - (clean + toxic) / 2) if toxic > clean else 0.0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
        rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    tables = WorkTables(docs.sparkSession, "toxicity")
    train = tables.keep(training_rows(docs, labels, id_col, text, rows), "train")
    n = {bool(r[0]): r[1] for r in train.groupBy("toxic").agg(F.count(F.lit(1))).collect()}
    n1, n0 = n.get(True, 0), n.get(False, 0)
    if not n1 or not n0:
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log((n1 + .5) / (n0 + .5))))
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = n1 - a, n0 - b
    chi = (a * d - b * c) ** 2 / ((a + b) * (c + d) + F.lit(1e-9))
    best = (gram_counts(train).where(a + b >= LEAST_TEXTS).withColumn("chi", chi)
            .orderBy(F.desc("chi"), "gram").limit(features).collect())  # bounded by ``features``
    if not best:
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log((n1 + .5) / (n0 + .5))))
    names = np.array([r.gram for r in best], np.int64).view(np.uint64)
    order = np.argsort(names)
    names, table = names[order], lookup(names)
    toxic, clean = (np.array([r[k] for r in best], float)[order] for k in (1, 2))
    scale = np.log((toxic + 1) / (n1 + 2)) - np.log((clean + 1) / (n0 + 2))

    def run(batches):
        for x in batches:
            found = [present(t.as_py(), table, names).astype("<u2").tobytes() for t in x.column(1)]
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(found, pa.binary())], names=["toxic", "found"])

    # at most 2 x ``rows`` rows of at most ``features`` two-byte numbers
    seen = sorted(map(tuple, train.select("toxic", "_text").mapInArrow(run, "toxic boolean, found binary").collect()))
    w, bias = regress([np.frombuffer(f, "<u2") for _, f in seen], np.array([y for y, _ in seen], float), scale)
    return Model(names, w * scale, bias)


def score(docs: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep`` columns and ``score``."""
    src = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    schema = docs.select(*keep, F.lit(0.0).alias("score")).schema

    def run(batches):
        table = lookup(model.grams)
        for b in batches:
            z = np.array([model.weights[present(t.as_py(), table, model.grams)].sum() for t in b.column(len(keep))])
            p = 1 / (1 + np.exp(-np.clip(z + model.bias, -40, 40)))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(p, pa.float64())],
                                             names=[*keep, "score"])

    return src.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return score(docs, ["doc_id"], fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
