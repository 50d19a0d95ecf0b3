"""SimHash near-duplicates: fingerprints, a binary-trie self-join, components.

Fingerprints: words of the text with A-Z lower-cased, every shingle of
``shingle`` words hashed by XXH64 (seed 42); a bit is 1 if set in over half of
the hashes.  Equal fingerprints are collapsed before anything else, so a group
of any number of copies is one trie leaf.

The self-join walks pairs of trie nodes together, from (root, root) down.
A pair carries the bits in which the two prefixes differ; children whose sum
of differing bits exceeds the budget are pruned with all that lies below
them.  The top of the trie is walked by Spark joins, ``STEP`` bits at a time,
on the table of node sizes; a pair leaves that loop as soon as both nodes are
small (``LEAF`` fingerprints), so a crowded prefix goes on splitting until its
parts are small, and every pair of small nodes is walked to the last bit
inside one task with bounded memory.  A task returns a spanning forest of the
links it finds (links within a pair connect the same fingerprints through
fewer edges), so no group's links are expanded into all its pairs.

Components are found by alternating large-star and small-star joins.

Defined results: a null text counts as empty; without words the fingerprint
is zero, linked like any other; fewer words than a shingle make one shingle of
the whole sequence.  Rows with a null id take part and get their component's
smallest id (null if it has none); repeated ids and rows each keep their row;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkTables, one_of_each

STEP = 4
LEAF = 16_384
#: Node pairs one task expands at a time.
BLOCK = 1 << 18


def fingerprint(text: bytes, shingle: int = 3) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    grams = zip(*[words[i:] for i in range(shingle)])
    join = b" ".join
    votes, n = np.zeros(64, np.int64), len(words) - shingle + 1
    hashes = np.fromiter((xxh64_intdigest(join(g), 42) for g in grams), np.uint64, n)
    for i in range(0, n, 1 << 16):
        votes += np.unpackbits(hashes[i:i + (1 << 16), None].view(np.uint8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > n).tolist())


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint's 64 bits as a signed long)."""
    src = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(len(keep))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(keep))], pa.array(fp.view(np.int64), pa.int64())],
                names=[*keep, "fp"])

    return src.mapInArrow(run, schema)


def prefix(fp: Column, depth: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(prints: DataFrame, tables: WorkTables, bits: int, leaf: int = LEAF) -> list[tuple[int, DataFrame]]:
    """Walks the top of the trie; per depth the pairs (a <= b) both of whose nodes are small."""
    spark = prints.sparkSession
    depth, out = 0, []
    pairs = (prints.agg(F.count(F.lit(1)).alias("na"))
             .select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "na",
                     F.col("na").alias("nb")))
    while True:
        pairs = tables.keep(pairs, f"pairs{depth}")
        small = (F.col("na") <= leaf) & (F.col("nb") <= leaf) | F.lit(depth == 64)
        out.append((depth, pairs.where(small & (F.col("na") > 0)).select("a", "b")))
        large = pairs.where(~small)
        if depth == 64 or large.isEmpty():
            return out
        depth += STEP
        up = F.shiftright(F.col("node"), STEP)
        nodes = tables.keep(prints.groupBy(prefix(F.col("fp"), depth).alias("node"))
                            .agg(F.count(F.lit(1)).alias("n")), f"nodes{depth}")
        left = nodes.select(up.alias("a"), F.col("node").alias("a2"), F.col("n").alias("na2"))
        right = nodes.select(up.alias("b"), F.col("node").alias("b2"), F.col("n").alias("nb2"))
        # the differing bits so far are those of the two prefixes; more than the budget ends the branch
        pairs = (large.select("a", "b").join(left, "a").join(right, "b")
                 .where((F.col("a2") <= F.col("b2"))
                        & (F.bit_count(F.col("a2").bitwiseXOR(F.col("b2"))) <= bits))
                 .select(F.col("a2").alias("a"), F.col("b2").alias("b"), F.col("na2").alias("na"),
                         F.col("nb2").alias("nb")))


def walk(a: np.ndarray, b: np.ndarray, bits: int, same: bool):
    """Walks two sorted sets of fingerprints as tries, yielding linked index pairs in blocks.

    A trie node is a range of a sorted array; its children are the parts
    before and after the first element with the next bit set.  Pairs of nodes
    are kept as arrays of ranges with their count of differing bits and
    expanded depth first in blocks, so memory stays bounded.
    """
    if not len(a) or not len(b):
        return
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], np.int64))]
    while stack:
        depth, p = stack.pop()
        if len(p) > BLOCK:
            stack += [(depth, p[i:i + BLOCK]) for i in range(0, len(p), BLOCK)]
            continue
        one = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
        if one.any():  # two single fingerprints: their distance decides at once
            i, j = p[one, 0], p[one, 2]
            near = np.bitwise_count(a[i] ^ b[j]) <= bits
            if same:
                near &= i < j
            yield i[near], j[near]
            p = p[~one]
        if not len(p):
            continue
        if depth == 64:  # sets hold distinct values, so ranges are single by now
            raise AssertionError("fingerprints repeat")
        bit = np.uint64(1 << (63 - depth))
        cut_a, cut_b = split(a, p[:, 0], p[:, 1], bit, depth), split(b, p[:, 2], p[:, 3], bit, depth)
        kids = []
        for x in (0, 1):
            for y in (0, 1):
                lo_a, hi_a = (p[:, 0], cut_a) if x == 0 else (cut_a, p[:, 1])
                lo_b, hi_b = (p[:, 2], cut_b) if y == 0 else (cut_b, p[:, 3])
                off = p[:, 4] + (x != y)
                live = (lo_a < hi_a) & (lo_b < hi_b) & (off <= bits)
                if same:
                    live &= lo_a <= lo_b
                kids.append(np.stack([lo_a, hi_a, lo_b, hi_b, off], 1)[live])
        stack.append((depth + 1, np.concatenate(kids)))


def split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64, depth: int) -> np.ndarray:
    """First index in [lo, hi) whose value has ``bit`` set; all of a range share the bits above it."""
    top = (values[lo] >> np.uint64(64 - depth)) << np.uint64(64 - depth) if depth else np.zeros(len(lo), np.uint64)
    return np.clip(np.searchsorted(values, top | bit), lo, hi)


def forest(n: int, links) -> list[tuple[int, int]]:
    """Edges (node, root) of the components that the links make of n nodes."""
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in links:
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in np.flatnonzero(root != np.arange(n)).tolist()]


def links(prints: DataFrame, tables: WorkTables, bits: int, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that connect every two distinct fingerprints within ``bits`` bits."""
    rows = None
    for depth, pairs in node_pairs(prints, tables, bits, leaf):
        own = prints.select("fp", prefix(F.col("fp"), depth).alias("node"))
        unit = F.struct(F.lit(depth).alias("depth"), "a", "b").alias("unit")
        left = own.join(pairs, own["node"] == pairs["a"]).select(unit, F.lit(0).cast("byte").alias("side"), "fp")
        right = (own.join(pairs.where("a <> b"), own["node"] == F.col("b"))
                 .select(unit, F.lit(1).cast("byte").alias("side"), "fp"))
        rows = left.union(right) if rows is None else rows.union(left).union(right)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        fp, side = pdf["fp"].to_numpy().view(np.uint64), pdf["side"].to_numpy()
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        same = not len(b)
        found = walk(a, a if same else b, bits, same)
        values = a if same else np.concatenate([a, b])
        edges = forest(len(values), found if same else ((i, j + len(a)) for i, j in found))
        u, v = np.array(edges, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"u": values[u].view(np.int64), "v": values[v].view(np.int64)})

    return rows.groupBy("unit").applyInPandas(run, "u long, v long")


def components(edges: DataFrame, tables: WorkTables) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with an edge.

    Large-star hangs a node's larger neighbours on its smallest neighbour,
    small-star its smaller ones; both keep the components, and they end as
    stars.  Neighbour minima are partial aggregates, so a crowded node costs
    its edges' count once.
    """
    old = None
    edges = tables.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = tables.keep(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = (hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        fresh = tables.keep(small, "small")
        same = _signature(fresh) == _signature(edges)
        for t in (old, large):
            tables.drop(t)
        old, edges = edges, fresh
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(edges: DataFrame):
    h = F.xxhash64("u", "v")
    return edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(0xFFFFFFFF))).first()


def near_duplicates(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text",
                    shingle: int = 3, bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """``keep`` columns (with ``id_col``), ``fp``, ``root`` (the component's least fingerprint) and ``component_id``."""
    tables = WorkTables(docs.sparkSession, "simhash")
    rows = tables.keep(fingerprints(docs, keep, text, shingle), "rows")
    prints = tables.keep(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "prints")
    roots = components(links(prints.select("fp"), tables, bits, leaf), tables)
    linked = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    label = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    final = tables.keep(linked.join(label, "root").select(F.col("fp").alias("_fp"), "root", "component_id"), "labels")
    return rows.join(final, rows["fp"] == final["_fp"]).select(*keep, "fp", "root", "component_id")


def representatives(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text",
                    shingle: int = 3, bits: int = 2) -> DataFrame:
    """``keep`` columns of one row per component: that with the smallest id (a null id last).

    A row is named by its id and a hash of its text, so the groups are worked
    out on narrow rows; texts move once, to the chosen names.  Rows that
    repeat id and text are one document.
    """
    docs = docs.select(*dict.fromkeys([*keep, id_col, text]))
    name = F.xxhash64(F.col(text)).alias("_h")
    near = near_duplicates(docs.select(id_col, text, name), [id_col, "_h"], id_col, text, shingle, bits)
    # rows of a component by its root: partial aggregates, whatever its size
    best = near.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"),
                                                   F.col("_h").alias("_name"))).alias("best"))
    chosen = best.select(F.col("best._id").alias(id_col), F.col("best._name").alias("_h"))
    return one_of_each(docs.withColumn("_h", name), chosen, [id_col, "_h"]).select(*keep)


def simhash_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return near_duplicates(docs, ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
