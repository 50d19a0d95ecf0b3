"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents is wanted;
the whole part is taken outright and the fraction is every document's
inclusion probability.  The flight phase moves these probabilities along the
null space of the balancing constraints (documents and words of the source):
three undecided documents always admit a direction that changes neither total,
and following it until a probability reaches 0 or 1 decides at least one.  It
runs inside chunks of a source, at most two documents per chunk stay
undecided, and those meet in ever fewer chunks until one per source is left.
The landing problem of at most two documents per source takes the outcome
whose words come nearest.

Chunks and order come from hashes of the document id and size, and each chunk
has its own seed, so reruns agree.  A source of any size is spread over as
many chunks as it needs; rows that repeat one id more often than a chunk holds
are spread too.

Defined results: a null text has size 0; a null source is a source, ordered
last; sources without words have target 0; repeated rows and null ids are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkTables, number_rows, tag_rows

CHUNK = 2_000
FAN_IN = 256
MOST = 3  # times a document, and a source, is repeated at most
EDGE = 1e-9


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(units: DataFrame, tables: WorkTables, source: str = "source") -> DataFrame:
    """Per source: words, documents, weight (1, 2, 3, repeating in code-point order, null last), target.

    Targets share all words by weight; those above ``MOST`` times their source
    stop there and the excess is shared again.  The level (words per unit of
    weight) only rises, so a round needs no more state than the level.
    """
    order = [F.col(source).isNull(), F.col(source)]
    sums = units.groupBy(source).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    tagged = tables.keep(tag_rows(sums.repartitionByRange(*order).sortWithinPartitions(*order)), "sources")
    ranked = tables.keep(number_rows(tagged, [], "rank").select(
        source, "source_size", "n", (F.col("rank") % 3 + 1).alias("weight")), "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped, stopped = F.lit(False), -1
    while True:
        now, held, weight = ranked.agg(
            F.count_if(capped), F.sum(F.when(capped, MOST * F.col("source_size")).otherwise(0)),
            F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        rest, weight = total - (held or 0), weight or 1
        if now == stopped:
            break
        stopped, capped = now, MOST * F.col("source_size") < F.lit(rest / weight) * F.col("weight")
    target = F.when(capped, MOST * F.col("source_size").cast("double")).otherwise(
        F.lit(float(rest)) * F.col("weight") / F.lit(float(weight)))
    return tables.keep(ranked.withColumn("target", target), "targets")


def flight(size: np.ndarray, prob: np.ndarray, rng: random.Random) -> np.ndarray:
    """Inclusion probabilities after the flight: all but two at most are 0 or 1."""
    x, p = size.tolist(), prob.tolist()
    slots: list[int] = []
    for i in range(len(x) + 1):
        if i < len(x):
            if EDGE < p[i] < 1 - EDGE:
                slots.append(i)
            if len(slots) < 3:
                continue
            a, b, c = slots
            u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])  # keeps the sum and the sum weighted by size
            if not any(u):
                u = (1, -1, 0)
        elif len(slots) >= 2 and x[slots[0]] == x[slots[1]]:
            u = (1, -1, 0)
        else:
            break
        up = down = float("inf")
        for k, d in zip(slots, u, strict=False):
            if d > 0:
                up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
            elif d < 0:
                up, down = min(up, p[k] / -d), min(down, (1 - p[k]) / -d)
        go = up if rng.random() * (up + down) < down else -down
        for k, d in zip(slots, u, strict=False):
            p[k] += go * d
            if p[k] < EDGE:
                p[k] = 0.0
            elif p[k] > 1 - EDGE:
                p[k] = 1.0
        slots = [k for k in slots if 0 < p[k] < 1]
    return np.array(p)


def land(size: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Rounds the last undecided documents to the outcome nearest in words, then in documents."""
    out = prob.copy()
    left = np.flatnonzero((prob > 0) & (prob < 1))
    best = None
    for code in range(1 << len(left)):
        s = np.array([code >> k & 1 for k in range(len(left))], float)
        miss = (abs(float(size[left] @ (s - prob[left]))), abs(float((s - prob[left]).sum())), code)
        if best is None or miss < best[0]:
            best = (miss, s)
    out[left] = best[1]
    return out


def sample(units: DataFrame, tables: WorkTables, seed: int, chunk_rows: int = CHUNK,
           fan_in: int = FAN_IN) -> DataFrame:
    """(pos, add): 0 or 1 further copies.  ``units``: pos, stratum, n, key, size, prob."""
    schema = "pos long, stratum string, chunk long, key long, size long, prob double"

    def round_of(last: bool):
        def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["key", "size", "pos"], ignore_index=True)
            size = pdf["size"].to_numpy()
            prob = flight(size, pdf["prob"].to_numpy(), random.Random(f"{seed}|{key[0]}|{key[1]}|{last}"))
            pdf["prob"] = land(size, prob) if last else prob
            return pdf[["pos", "stratum", "chunk", "key", "size", "prob"]]

        return run

    count = F.ceil(F.col("n") / chunk_rows).cast("long")
    often = (units.groupBy("stratum", "key").agg(F.count(F.lit(1)).alias("_m"))
             .where(F.col("_m") > chunk_rows).select(F.col("stratum").alias("_s"), F.col("key").alias("_k"), "_m"))
    spread = units.join(often, units["stratum"].eqNullSafe(F.col("_s")) & (F.col("key") == F.col("_k")), "left")
    salted = F.when(F.col("_m").isNull(), F.col("key")).otherwise(F.xxhash64("key", "pos"))
    rows = spread.select("pos", "stratum", F.pmod(salted, count).alias("chunk"), "key", "size", "prob")
    chunks = units.agg(F.max(count)).first()[0] or 1
    settled = None
    while True:
        done = tables.keep(rows.groupBy("stratum", "chunk").applyInPandas(round_of(chunks == 1), schema), "flight")
        now = done.where("prob in (0.0, 1.0)").select("pos", F.col("prob").cast("long").alias("add"))
        settled = now if settled is None else settled.union(now)
        if chunks == 1:
            return settled
        rows = done.where("prob not in (0.0, 1.0)").withColumn("chunk", F.expr(f"chunk div {fan_in}"))
        chunks = -(-chunks // fan_in)


def mix(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text",
        source: str = "source", seed: int = 7, chunk_rows: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """``keep`` columns, size, source_size, target, copies and taken (words) per row."""
    tables = WorkTables(docs.sparkSession, "mixing")
    named = docs.select(*keep, words(F.col(text)).alias("size"), F.col(source).alias("_source"),
                        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_key"))
    rows = tables.keep(tag_rows(named), "rows")
    targets = source_targets(rows.select(F.col("_source").alias("source"), "size"), tables)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.select(
        F.col("source").alias("_plan"), "source_size", "target", "n",
        F.floor(ratio + EDGE).alias("whole"), F.greatest(ratio - F.floor(ratio + EDGE), F.lit(0.0)).alias("part"))
    narrow = rows.select("_source", "_pos", "_key", "size").join(
        plan, F.col("_source").eqNullSafe(F.col("_plan")))
    units = narrow.where(F.col("part") > EDGE).select(
        F.col("_pos").alias("pos"), F.col("_source").alias("stratum"), "n",
        F.xxhash64("_key", "size").alias("key"), "size", F.col("part").alias("prob"))
    add = sample(units, tables, seed, chunk_rows, fan_in)
    return (rows.join(plan, F.col("_source").eqNullSafe(F.col("_plan")))
            .join(add, F.col("_pos") == F.col("pos"), "left")
            .withColumn("copies", F.col("whole") + F.coalesce("add", F.lit(0)))
            .select(*keep, "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixing_report(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return mix(docs, ["doc_id", "source"]).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")
