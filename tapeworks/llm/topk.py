"""Exact top-k search by block-at-a-time pruning.

Components are terms and quantised components their weights.  Documents are
put in an order that brings similar ones together (nearest of a few pivots,
then nearness), and ranges of that order are blocks.  A block keeps each
term's greatest and least weight and a forward index (ids and weights).  For a
query, a block's bound is the sum over its terms of what the term can give at
most.  The query scores its block of the highest bound first, which fixes a
threshold; then, superblock by superblock, it takes blocks by falling bound,
scores them through their forward indexes, and stops when the next bound is
below its kth score.  A bound equal to it is still scored, since ties go to
smaller ids, so the result is exact.

Queries and superblocks meet by an equality join on the superblock, both in
bounded blocks: a task holds ``SUPER`` blocks and one block of queries.

Rows with a component of ``LIMIT`` or more in size, whose integer products could
overflow, are scored on a path of their own: against every query, and as
queries against every row, in blocks and in integers of any size.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part, nor do rows without an id; of rows that repeat an id the least
vector counts; a shorter vector's missing components are zero; a score that no
long holds keeps its rank and is null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WorkTables, number_rows, tag_rows

SCALE = 256
BLOCK = 256
SUPER = 64
QUERY_BLOCK = 2048
PIVOTS = 64
#: Components from here on take the path of any size.
LIMIT = float(1 << 20)
EXACT_BLOCK = 512

BLOCKS = "ids binary, weights binary, most binary, least binary, n int, terms int"


def finite(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, q): one row per id; q are doubles with floor(256 * q) = 256 * q, whatever their size."""
    values = F.col(vector).cast("array<double>")
    fit = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def floored(x):  # from 2^44 on a double is a multiple of 1/256 anyway
        return F.when(F.abs(x) < float(1 << 44), F.floor(x * SCALE).cast("double") / SCALE).otherwise(x)

    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & fit)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(values, floored).alias("q"))
            .groupBy("id").agg(F.min("q").alias("q")))


def is_small():
    return F.forall("q", lambda x: F.abs(x) < LIMIT)


def weights_of(rows: DataFrame) -> DataFrame:
    """(id, w): integer weights of rows whose components are below ``LIMIT``."""
    return rows.where(is_small()).select("id", F.transform("q", lambda x: (x * SCALE).cast("int")).alias("w"))


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, w) of the rows whose components are below ``LIMIT``: one row per id, integer weights."""
    return weights_of(finite(vectors, id_col, vector))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    length = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(length), int(length.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < length[:, None]] = flat
    return out


def widened(m: np.ndarray, terms: int) -> np.ndarray:
    return m if m.shape[1] == terms else np.pad(m, ((0, 0), (0, terms - m.shape[1])))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of rows: by floats where they are exact, else by integers."""
    terms = max(a.shape[1], b.shape[1])
    a, b = widened(a, terms), widened(b, terms)
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, terms)
    if most < 2.0 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Per query and block: the highest score a document of the block can have."""
    return dot(np.maximum(queries, 0), most) + dot(np.minimum(queries, 0), least)


def ordered(rows: DataFrame) -> DataFrame:
    """(id, w, pivot, far): the place of each row in the order of documents."""
    pivots = [r.w for r in rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()]
    width = max(map(len, pivots), default=0)
    centre = np.array([w + [0] * (width - len(w)) for w in pivots], np.int64).reshape(len(pivots), width)

    def run(batches):
        for b in batches:
            near = dot(matrix(b.column(1)), centre)
            best = near.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(best.astype(np.int32)), pa.array(-near[np.arange(len(best)), best])],
                names=["id", "w", "pivot", "far"])

    return rows.mapInArrow(run, "id long, w array<int>, pivot int, far long")


def blocks(rows: DataFrame, tables: WorkTables, size: int) -> DataFrame:
    """The index: a row per block with its number and superblock."""
    def run(batches):
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        for i in range(0, table.num_rows if table else 0, size):
            part = table.slice(i, size).combine_chunks()
            m = matrix(part.column("w").combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column("id").to_numpy().astype("<i8").tobytes()]),
                 *[pa.array([x.astype("<i4").tobytes()]) for x in (m, m.max(0), m.min(0))],
                 pa.array([len(m)], pa.int32()), pa.array([m.shape[1]], pa.int32())],
                names=["ids", "weights", "most", "least", "n", "terms"])

    parts = max(1, -(-rows.count() // (size * 32)))  # a task orders a bounded number of rows
    laid = ordered(rows).repartitionByRange(parts, "pivot", "far", "id").sortWithinPartitions("pivot", "far", "id")
    built = tables.keep(tag_rows(laid.select("id", "w").mapInArrow(run, BLOCKS)), "blocks")
    numbers = number_rows(built.select("_chunk", "_pos"), [], "block").select(F.col("_pos").alias("_at"), "block")
    return tables.keep(built.join(numbers, F.col("_pos") == F.col("_at")).select(
        "block", F.expr(f"block div {SUPER}").alias("super"), "ids", "weights", "most", "least", "n", "terms"), "index")


def unpack(pdf: pd.DataFrame, column: str) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i4").reshape(-1, t).astype(np.int64) if t else np.zeros((n if column == "weights" else 1, 0), np.int64)
            for x, t, n in zip(pdf[column], pdf["terms"], pdf["n"], strict=True)]


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([widened(p, width) for p in parts])


def query_matrix(pdf: pd.DataFrame) -> np.ndarray:
    width = max(map(len, pdf["w"]), default=0)
    return np.array([list(w) + [0] * (width - len(w)) for w in pdf["w"]], np.int64).reshape(len(pdf), width)


class Best:
    """The k best (score, id) of each query so far; ties to smaller ids."""

    def __init__(self, own: np.ndarray, k: int, floor: np.ndarray):
        self.own, self.k = own, k
        self.score = np.full((len(own), k), np.iinfo(np.int64).min)
        self.id = np.full((len(own), k), np.iinfo(np.int64).max)
        self.floor = floor  # what the kth score is known to reach

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        score = np.where(ids[None, :] == self.own[q, None], np.iinfo(np.int64).min, score)
        some = score.max(1) >= self.floor[q]
        q, score = q[some], score[some]
        if len(q):
            all_s = np.concatenate([self.score[q], score], 1)
            all_i = np.concatenate([self.id[q], np.broadcast_to(ids, score.shape)], 1)
            top = np.lexsort((all_i, -1 - all_s), axis=1)[:, :self.k]  # -1 - s: no overflow at the least integer
            self.score[q], self.id[q] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)
            self.floor[q] = np.maximum(self.floor[q], self.score[q, -1])


def search_blocks(queries: np.ndarray, best: Best, index: pd.DataFrame) -> int:
    """Block-at-a-time: each query takes blocks by falling bound until the bound is below its kth score."""
    bound = bounds(queries, stacked(unpack(index, "most")), stacked(unpack(index, "least")))
    weights = unpack(index, "weights")
    ids = [np.frombuffer(x, "<i8") for x in index["ids"]]
    order, scored = np.argsort(-bound, axis=1, kind="stable"), 0
    live = np.arange(len(queries))
    for r in range(bound.shape[1]):
        live = live[bound[live, order[live, r]] >= best.floor[live]]
        if not len(live):
            break
        turn = order[live, r]
        for b in np.unique(turn).tolist():
            q = live[turn == b]
            best.add(q, ids[b], dot(queries[q], weights[b]))
            scored += len(q)
    return scored


def top_k(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score); ``rows`` and ``queries``: id, w."""
    tables = WorkTables(rows.sparkSession, "topk")
    rows = tables.keep(rows, "rows")
    index = blocks(rows, tables, block)
    supers = index.agg(F.max("super")).first()[0]
    asked = tables.keep(tag_rows(queries.select("id", "w")), "queries")
    asked = tables.keep(number_rows(asked, [], "_n").select(
        F.expr(f"_n div {query_block}").alias("part"), F.col("id").alias("query_id"), "w"), "parts")
    everywhere = asked.withColumn("super", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(supers or 0).cast("long"))))

    def first_block(key, q: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(own):
            return pd.DataFrame({"query_id": [], "block": [], "bound": []})
        own = own.sort_values("block", ignore_index=True)
        bound = bounds(query_matrix(q), stacked(unpack(own, "most")), stacked(unpack(own, "least")))
        at = bound.argmax(1)
        return pd.DataFrame({"query_id": q["query_id"], "block": own["block"].to_numpy()[at],
                             "bound": bound[np.arange(len(q)), at]})

    summaries = index.select("super", "block", "most", "least", "n", "terms")
    parts = asked.agg(F.max("part")).first()[0] or 0

    def for_each_part(df: DataFrame) -> DataFrame:
        return df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts).cast("long"))))

    tops = (everywhere.groupBy("super", "part").cogroup(for_each_part(summaries).groupBy("super", "part"))
            .applyInPandas(first_block, "query_id long, block long, bound long")
            .groupBy("query_id").agg(F.max_by("block", F.struct(F.col("bound"), -F.col("block"))).alias("block")))

    def seed(key, q: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(own):
            return pd.DataFrame({"query_id": [], "floor": []})
        best = Best(q["query_id"].to_numpy(), k, np.full(len(q), np.iinfo(np.int64).min))
        best.add(np.arange(len(q)), np.frombuffer(own["ids"].iloc[0], "<i8"), dot(query_matrix(q), unpack(own, "weights")[0]))
        return pd.DataFrame({"query_id": q["query_id"], "floor": best.score[:, -1]})

    chosen = tables.keep(asked.join(tops, "query_id"), "first")
    floors = tables.keep(chosen.groupBy("block").cogroup(index.groupBy("block")).applyInPandas(
        seed, "query_id long, floor long"), "floors")

    def search(key, q: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(own):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        best = Best(q["query_id"].to_numpy(), k, q["floor"].to_numpy().copy())
        search_blocks(query_matrix(q), best, own.sort_values("block", ignore_index=True))
        found = best.score > np.iinfo(np.int64).min
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), found.sum(1)),
                             "vec_id": best.id[found], "score": best.score[found]})

    ready = everywhere.join(floors, "query_id")
    found = (ready.groupBy("super", "part").cogroup(for_each_part(index).groupBy("super", "part"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def exact_integers(column: pd.Series) -> np.ndarray:
    """floor(256 * q) as Python integers, rows filled up with zeros."""
    width = max(map(len, column), default=0)
    out = np.zeros((len(column), width), object)
    for i, v in enumerate(column):
        out[i, :len(v)] = [int(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE for x in map(float, v)]
    return out


def exact_pairs(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score text): the k best of each block of ``rows`` per query; both sides: id, q."""
    parts = max(1, -(-queries.count() // EXACT_BLOCK))
    sides = max(1, -(-rows.count() // EXACT_BLOCK))

    def spread(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x, y = exact_integers(a["q"]), exact_integers(b["q"])
            both = min(x.shape[1], y.shape[1])
            ids = b["id"].tolist()
            scores = x[:, :both] @ y[:, :both].T if both else np.zeros((len(a), len(b)), object)
            for q, row in zip(a["id"].tolist(), scores, strict=True):
                best = sorted((-s, i) for s, i in zip(row.tolist(), ids, strict=True) if i != q)[:k]
                out += [(q, i, str(-s)) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return (spread(queries, "part", parts, "side", sides).groupBy("part", "side")
            .cogroup(spread(rows, "side", sides, "part", parts).groupBy("part", "side"))
            .applyInPandas(run, "query_id long, vec_id long, score string"))


def merged_best(pairs: DataFrame, k: int, groups: int) -> DataFrame:
    """The k best of each query, by scores of any size; a score that no long holds is null."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q, own in pdf.groupby("query_id"):
            best = sorted((-int(s), i) for s, i in zip(own["score"], own["vec_id"].tolist(), strict=True))[:k]
            out += [(q, r + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for r, (s, i) in enumerate(best)]
        query, rank, vec, score = zip(*out, strict=True) if out else ((), (), (), ())
        return pd.DataFrame({"query_id": query, "rank": rank, "vec_id": vec, "score": pd.array(score, "Int64")})  # never floats

    return (pairs.withColumn("_g", F.pmod(F.xxhash64("query_id"), F.lit(groups))).groupBy("_g")
            .applyInPandas(run, "query_id long, rank int, vec_id long, score long"))


def nearest(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ids divisible by ``every`` against all other rows."""
    tables = WorkTables(vectors.sparkSession, "topk-rows")
    rows = tables.keep(finite(vectors, id_col, vector), "rows")
    small, asked = weights_of(rows), F.col("id") % every == 0
    found = top_k(small, small.where(asked), k)
    large = tables.keep(rows.where(~is_small()), "large")
    if large.isEmpty():
        return found
    queries = rows.where(asked)
    pairs = (found.select("query_id", "vec_id", F.col("score").cast("string").alias("score"))
             .unionByName(exact_pairs(queries, large, k))
             .unionByName(exact_pairs(large.where(asked), rows.where(is_small()), k)))
    return merged_best(pairs, k, max(1, -(-queries.count() // QUERY_BLOCK)))


def topk_report(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The columns of the registered query: ids divisible by ``every`` against all rows."""
    return nearest(vectors, k, every)


ORACLE = f"""
WITH fit AS (
  SELECT vec_id AS id, min(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS HUGEINT))) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY 1),
scored AS (
  SELECT q.id AS query_id, d.id AS vec_id,
         coalesce(list_sum(list_transform(list_zip(q.w, d.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS score
  FROM fit q JOIN fit d ON q.id <> d.id WHERE q.id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, TRY_CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5
"""
