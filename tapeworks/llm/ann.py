"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors form one class, so a vector that occurs any number of times is
one node of the graph.  A node's neighbours are the nodes of the largest inner
product with it, whatever the lengths, so a query's own links already are
candidates of its answer.

The graph starts from blocks: several times the nodes are ordered by the signs
of random projections, cut into blocks of ``LEAF`` and compared within a block.
NN-descent then joins, for every node, the nodes it neighbours and a sample of
those it is neighboured by (a Spark join that brings their vectors to the
centre); pairs with a new link are compared, and only those that beat a node's
worst neighbour are sent to it and merged.  The sample is what NN-descent
prescribes: a long vector is everyone's neighbour, and comparing all of them
there would cost the square of their number.  Rounds end when few links change
or after ``MOST_ROUNDS``; which of both ended them is logged.

A query keeps a beam of the best nodes seen.  Each round joins the beam's
unexpanded nodes with the graph, scores their neighbours and merges them, until
no beam changes.  The beam's nodes are scored on the original vectors in
double precision, classes are expanded to their members, and ties go to
smaller ids.

Working vectors are one byte per component with a scale, for candidates only.
Tasks hold a number of nodes or blocks fixed here; all tables grow in rows.
The only sample is of ``SAMPLE`` vectors (smallest hashes), which places the
projections' thresholds.

Defined results: vectors that are null, zero, or hold a null or non-finite
component, and rows without an id, take no part; of rows that repeat an id the
least vector counts; missing components of shorter vectors are zero; an empty
table gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WorkTables

log = logging.getLogger(__name__)

LINKS = 32  # neighbours a node keeps
PASSES = 16
PASS_KEEPS = 20
LEAF = 2048
BEAM = 64
SETTLED = 0.02  # share of links that may change in the last round
MOST_ROUNDS = 8
SAMPLE = 2000
ENTRIES = 16  # longest vectors, and as many others, where every search starts besides the query's own node
TASK_NODES = 2048
REVERSE = 32  # nodes that point at a centre and are compared there, fresh links first
SHORTEST = np.float32(-3e38)

LINKS_DDL = "u long, v long, s float"
LISTS = "u long, v array<long>, s array<float>, old boolean"
GRAPH = "u long, v array<long>, s array<float>, fresh array<boolean>"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): one row per id that takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite
                          & F.exists(vector, lambda x: x != 0))
            .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(vector).alias("x")))


def classes(rows: DataFrame, tables: WorkTables) -> tuple[DataFrame, DataFrame]:
    """(node, x) per distinct vector, and (id, node) per row; a node is the least id of its class."""
    keyed = rows.withColumn("h", F.xxhash64("x"))
    all_classes = tables.keep(keyed.groupBy("h", "x").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("n")), "classes")
    crowded = all_classes.where("n > 1").select(F.col("h").alias("_h"), F.col("x").alias("_x"), "node")
    home = (all_classes.where("n = 1").select(F.col("node").alias("id"), "node")
            .union(keyed.join(crowded, (F.col("h") == F.col("_h")) & (F.col("x") == F.col("_x"))).select("id", "node")))
    return all_classes.select("node", "x"), tables.keep(home, "home")


def dense(column: pa.Array) -> np.ndarray:
    length = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1]) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def packed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per component, and each row's scale."""
    scale = np.maximum(np.abs(x).max(1, initial=0), 1e-300) / 127
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def pack(nodes: DataFrame, width: int, longest: float) -> DataFrame:
    """(node, b, scale, more): working vectors of ``width`` components; ``more``: what the length lacks to the longest."""
    def run(batches):
        for batch in batches:
            x = dense(batch.column(1))
            x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
            b, scale = packed(x)
            more = np.sqrt(np.maximum(longest ** 2 - (x ** 2).sum(1), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in b], pa.binary()), pa.array(scale), pa.array(more)],
                names=["node", "b", "scale", "more"])

    return nodes.select("node", "x").mapInArrow(run, "node long, b binary, scale double, more double")


def unpacked(table: pa.Table | pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of b and scale."""
    if not table.num_rows:
        return np.zeros((0, width), np.float32)
    raw = table.column("b")
    raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
    b = np.frombuffer(b"".join(raw.to_pylist()), np.int8).reshape(-1, width).astype(np.float32)
    return b * table.column("scale").to_numpy().astype(np.float32)[:, None]


def whole(batches) -> pa.Table | None:
    held = list(batches)
    return pa.Table.from_batches(held) if held else None


def lists(u: np.ndarray, v: np.ndarray, s: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """One row per u; the rows given are in order of u."""
    names, start = np.unique(u, return_index=True)
    ends = pa.array(np.append(start, len(u)).astype(np.int32))
    cols = {"u": pa.array(names), "v": pa.ListArray.from_arrays(ends, pa.array(v)),
            "s": pa.ListArray.from_arrays(ends, pa.array(s.astype(np.float32)))}
    for k, x in more.items():
        cols[k] = pa.array(np.full(len(names), x)) if np.isscalar(x) else pa.ListArray.from_arrays(ends, pa.array(x))
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def links_of(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s.astype(np.float32))], names=["u", "v", "s"])


def as_lists(links: DataFrame) -> DataFrame:
    return links.select("u", F.array("v").alias("v"), F.array("s").alias("s"), F.lit(False).alias("old"))


def first_of(key: np.ndarray) -> np.ndarray:
    """Place of each row among the rows of its key; ``key`` is in order."""
    return np.arange(len(key)) - np.searchsorted(key, key)


def merged(rows: DataFrame, keeps: int, tasks: int, all_fresh: bool = False, own: bool = False) -> DataFrame:
    """Per u the ``keeps`` nearest of all its lists; links that no old list held are fresh.

    A node is no neighbour of its own; ``own``: u is a query, which may be among its candidates.
    """
    def run(batches):
        t = whole(batches)
        if t is None or not t.num_rows:
            return
        v = t.column("v").combine_chunks()
        n = np.diff(v.offsets.to_numpy())
        u, old = (np.repeat(t.column(c).to_numpy(), n) for c in ("u", "old"))
        v, s = (t.column(c).combine_chunks().flatten().to_numpy() for c in ("v", "s"))
        o = np.lexsort((~old, v, u))
        u, v, s, old = u[o], v[o], s[o], old[o]
        new = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])) & (own | (u != v))
        u, v, s, old = u[new], v[new], s[new], old[new]
        o = np.lexsort((v, -s, u))
        o = o[first_of(u[o]) < keeps]
        if len(o):
            yield lists(u[o], v[o], s[o], fresh=~old[o] | all_fresh)

    return rows.repartition(tasks, "u").mapInArrow(run, GRAPH)


def start(nodes: DataFrame, sample: np.ndarray, count: int, width: int, tasks: int, passes: int, leaf: int,
          seed: int) -> DataFrame:
    """Lists of neighbours from blocks of nodes with like signs under random projections."""
    bits = max(1, int(np.ceil(np.log2(max(1, count / leaf)))) + 2)
    planes = np.random.default_rng(seed).normal(size=(passes, width, bits))
    cuts = np.stack([np.median(sample @ p, 0) for p in planes])

    def coded(batches):
        for b in batches:
            x = unpacked(b, width)
            for k in range(passes):
                y = x @ planes[k]
                code = ((y > cuts[k]) << np.arange(bits)[::-1]).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k, np.int32)), pa.array(code.astype(np.int64)), pa.array(y[:, -1]),
                     *[b.column(c) for c in ("node", "b", "scale")]],
                    names=["pass", "code", "y", "node", "b", "scale"])

    def near(batches):
        t = whole(batches)
        if t is None or not t.num_rows:
            return
        turn = t.column("pass").to_numpy()
        for k in np.unique(turn).tolist():
            own = t.filter(pa.array(turn == k))
            for i in range(0, own.num_rows, leaf):
                part = own.slice(i, leaf)
                x, node = unpacked(part, width), part.column("node").to_numpy()
                s = x @ x.T
                np.fill_diagonal(s, SHORTEST)
                keeps = min(PASS_KEEPS, len(x) - 1)
                if keeps:
                    top = np.argpartition(-s, keeps - 1, 1)[:, :keeps]
                    o = np.argsort(node)
                    yield lists(np.repeat(node[o], keeps), node[top[o]].ravel(),
                                np.take_along_axis(s, top, 1)[o].ravel(), old=False)

    rows = nodes.select("node", "b", "scale").mapInArrow(coded, "pass int, code long, y double, node long, b binary, scale double")
    order = ["pass", "code", "y", "node"]
    parts = max(1, -(-count * passes // (4 * leaf)))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(near, LISTS)


def descend(graph: DataFrame, nodes: DataFrame, width: int, tasks: int, turn: int = 0) -> DataFrame:
    """One NN-descent round: lists of better neighbours, found among the neighbours of each node."""
    worst = graph.select(F.col("u").alias("_u"), F.when(
        F.size("s") >= LINKS, F.array_min("s")).otherwise(F.lit(float(SHORTEST))).alias("worst"))
    members = nodes.join(worst, F.col("node") == F.col("_u"), "left").drop("_u", "more")
    links = graph.select("u", F.explode(F.arrays_zip("v", "fresh")).alias("l")).select("u", "l.v", "l.fresh")
    # the first few by rank: Spark limits them in each task before they meet at a centre
    some = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64("u", "v", F.lit(turn))))
    back = links.withColumn("_r", some).where(F.col("_r") <= REVERSE)
    both = links.select(F.col("u").alias("centre"), F.col("v").alias("member"), "fresh").union(
        back.select(F.col("v").alias("centre"), F.col("u").alias("member"), "fresh"))

    def local(batches):
        t = whole(batches)
        if t is None or not t.num_rows:
            return
        t = t.sort_by([("centre", "ascending"), ("node", "ascending"), ("fresh", "descending")])
        centre, node = t.column("centre").to_numpy(), t.column("node").to_numpy()
        single = np.append(True, (centre[1:] != centre[:-1]) | (node[1:] != node[:-1]))
        t = t.filter(pa.array(single))
        centre, node = centre[single], node[single]
        fresh, worst = t.column("fresh").to_numpy(), t.column("worst").fill_null(float(SHORTEST)).to_numpy()
        x = unpacked(t, width)
        ends = np.append(np.flatnonzero(np.append(True, centre[1:] != centre[:-1])), len(centre))
        found = [[], [], []]
        for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            for i in range(a, z, 1024):  # a node many point at is compared in strips
                j = min(z, i + 1024)
                s = x[i:j] @ x[a:z].T
                good = (s > worst[i:j, None]) & (fresh[i:j, None] | fresh[None, a:z]) & (node[i:j, None] != node[None, a:z])
                p, q = np.nonzero(good)
                for held, value in zip(found, (node[i:j][p], node[a:z][q], s[p, q]), strict=True):
                    held.append(value)
        u, v, s = map(np.concatenate, found)
        o = np.lexsort((v, u))
        u, v, s = u[o], v[o], s[o]
        if len(u):
            single = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))
            yield links_of(u[single], v[single], s[single])

    near = both.join(members, both["member"] == members["node"]).select(
        "centre", "node", "fresh", "b", "scale", "worst")
    return as_lists(near.repartition(tasks, "centre").mapInArrow(local, LINKS_DDL))


def neighbour_graph(nodes: DataFrame, sample: np.ndarray, count: int, width: int, tables: WorkTables,
                    passes: int = PASSES, leaf: int = LEAF, seed: int = 5) -> DataFrame:
    """GRAPH rows of every node that has a neighbour."""
    tasks = max(1, -(-count // TASK_NODES))
    graph = tables.keep(merged(start(nodes, sample, count, width, tasks, passes, leaf, seed), LINKS, tasks, True), "graph")
    for turn in range(MOST_ROUNDS):
        old = graph.select("u", "v", "s", F.lit(True).alias("old"))
        better = tables.keep(merged(old.union(descend(graph, nodes, width, tasks, turn)), LINKS, tasks), "graph")
        tables.drop(graph)
        graph = better
        fresh = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        log.info("descent round %d: %d of %d links changed", turn + 1, fresh, LINKS * count)
        if fresh < SETTLED * LINKS * count:
            log.info("descent settled after %d rounds", turn + 1)
            return graph
    log.info("descent stopped after %d rounds, unsettled", MOST_ROUNDS)
    return graph


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, width: int, tables: WorkTables,
           beam: int = BEAM, entries: list[int] = ()) -> DataFrame:
    """(q, node): each query's beam after greedy search from ``entry`` and ``entries``; ``queries``: q, entry, b, scale."""
    count = queries.count()
    tasks = max(1, -(-count // (TASK_NODES // 4)))
    asked = queries.select("q", F.col("b").alias("qb"), F.col("scale").alias("qs"))

    def scored(batches):
        for t in batches:
            if t.num_rows:
                x = unpacked(t, width)
                q = np.frombuffer(b"".join(t.column("qb").to_pylist()), np.int8).reshape(-1, width)
                s = (x * q).sum(1) * t.column("qs").to_numpy()
                yield links_of(t.column("q").to_numpy(), t.column("node").to_numpy(), s)

    def step(pairs: DataFrame) -> DataFrame:
        return as_lists(pairs.join(nodes, "node").join(asked, "q").select(
            "q", "node", "b", "scale", "qb", "qs").mapInArrow(scored, LINKS_DDL))

    def keep_best(rows: DataFrame) -> DataFrame:
        return tables.keep(merged(rows, beam, tasks, own=True), "beam")

    first = queries.select("q", F.explode(F.array_distinct(F.array("entry", *map(F.lit, entries)))).alias("node"))
    state = keep_best(step(first))
    out = graph.select(F.col("u").alias("node"), F.col("v").alias("next"))
    for step_no in range(4 * MOST_ROUNDS):
        edge = state.select(F.col("u").alias("q"), F.explode(F.arrays_zip("v", "fresh")).alias("l")).where(
            "l.fresh").select("q", F.col("l.v").alias("node"))
        if edge.isEmpty():
            log.info("search settled after %d rounds", step_no)
            break
        wider = edge.join(out, "node").select("q", F.explode("next").alias("node")).distinct()
        old = state.select("u", "v", "s", F.lit(True).alias("old"))
        better = keep_best(old.union(step(wider)))
        tables.drop(state)
        state = better
    else:
        log.info("search stopped after %d rounds, unsettled", 4 * MOST_ROUNDS)
    return state.select(F.col("u").alias("q"), F.explode("v").alias("node"))


def nearest(vectors: DataFrame, every: int, k: int, id_col: str = "vec_id", vector: str = "embedding",
            passes: int = PASSES, leaf: int = LEAF, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id is divisible by ``every``, against all others."""
    tables = WorkTables(vectors.sparkSession, "ann")
    rows = tables.keep(usable(vectors, id_col, vector), "rows")
    exact, home = classes(rows, tables)
    shape = exact.agg(F.max(F.size("x")), F.max(F.aggregate(
        "x", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), F.count(F.lit(1))).first()
    width, longest, count = shape[0] or 0, float(shape[1] or 0) ** 0.5, shape[2]
    nodes = tables.keep(pack(exact, width, longest), "nodes")
    few = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toArrow()
    graph = neighbour_graph(nodes, unpacked(few, width), count, width, tables, passes, leaf)
    asked = home.where(F.col("id") % every == 0)
    starts = tables.keep(asked.select(F.col("node").alias("q")).distinct().join(nodes, F.col("q") == F.col("node")).select(
        "q", F.col("node").alias("entry"), "b", "scale"), "starts")
    far = nodes.orderBy("more", "node").limit(ENTRIES).select("node").union(
        nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).select("node")).distinct()
    entries = [r.node for r in far.collect()]  # at most 2 x ENTRIES
    found = search(graph, nodes, starts, width, tables, beam, entries)

    def product(batches):
        for b in batches:
            q, x = dense(b.column(2)), dense(b.column(3))
            both = min(q.shape[1], x.shape[1])
            s = np.einsum("ij,ij->i", q[:, :both], x[:, :both])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], names=["q", "node", "score"])

    pairs = found.union(starts.select("q", F.col("q").alias("node"))).distinct()
    left = exact.select(F.col("node").alias("q"), F.col("x").cast("array<double>").alias("qx"))
    scores = tables.keep(pairs.join(exact, "node").join(left, "q").select(
        "q", "node", "qx", F.col("x").cast("array<double>").alias("x"))
        .mapInArrow(product, "q long, node long, score double"), "scores")
    least = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    members = tables.keep(home.withColumn("_r", least).where(F.col("_r") <= k + 1).select("node", "id"), "members")
    # at most the beam's nodes with k + 1 members each; one place more than asked, for the query itself
    best = scores.join(members, "node").groupBy("q").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("less"), "id"))), 1, k + 1).alias("best"))
    own = asked.select("id", "node").withColumnRenamed("id", "query_id")
    return (own.join(best, F.col("node") == F.col("q"))
            .select("query_id", F.posexplode(F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("r", "x"))
            .select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                    (-F.col("x.less")).alias("score")))


def ann_report(vectors: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return nearest(vectors, 20, 20)
