"""Balanced label propagation into shards, in DataFrame functions only.

Documents start evenly over the shards.  Documents of equal text are a group,
and each round counts every group's documents per shard; the fullest shards
that still have room, as many as the group needs, are where the others of it
want to go.  Moves obey quotas: between two shards as many go one way as the
other (a swap leaves both sizes), and beyond that only into free room below
the shard's capacity.  Movers are counted per pair of shards and numbered
without gaps, so quotas are met exactly and sizes never exceed capacity.
Documents without links join no round; they fill the shards up at the end, so
the counts are at most one apart whatever the links are.

A group larger than a shard thus fills as few shards as it can, and no pairs
of its documents are made.

Law ``rows``: shard sizes in documents are at most one apart.

Defined results: a null text has size 1 and the checksum of the empty text,
and null texts link with each other, not with empty texts; repeated rows and
ids are separate documents; an empty table gives an empty result; only the
asked columns pass through.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkTables, number_rows, tag_rows

SHARDS = 16
ROUNDS = 8
CHUNK_BITS = 12  # 4,096 rows
#: A shard with less than this part of its capacity left counts as full (quotas are rounded down).
SLACK = 100


def capacities(total: int, shards: int) -> Column:
    """Documents that shard ``shard`` may hold."""
    return F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)


def wishes(state: DataFrame, sizes: DataFrame, round_no: int) -> DataFrame:
    """(node, chunk, from, to): documents of which a fuller shard of their group has room.

    A group votes by its population per shard, so no pairs are made.  It has as
    many targets as it needs shards: its fullest ones, those with room first.
    """
    room = sizes.select(F.col("shard").alias("_s"), "capacity", (F.col("capacity") - F.col("held")).alias("_room"))
    counts = state.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("_w"))
    aims = (counts.join(F.broadcast(room), F.col("shard") == F.col("_s")).groupBy("group").agg(
        F.sort_array(F.collect_list(F.struct((F.col("_room") * SLACK > F.col("capacity")).alias("free"), F.col("_w").alias("w"),
                                             F.xxhash64("group", "shard", F.lit(round_no)).alias("tie"), "shard")), False).alias("_all"),
        F.ceil(F.sum("_w") / F.greatest(F.min("capacity"), F.lit(1))).cast("int").alias("_need"))
        .select(F.col("group").alias("_g"), F.slice("_all", F.lit(1), F.greatest("_need", F.lit(1))).alias("_aims"),
                F.map_from_entries(F.transform("_all", lambda x: F.struct(x["shard"], x["w"]))).alias("_held")))
    # by group and chunk: a group of any size meets its aims in as many tasks as chunks hold it
    here = state.select(F.col("group").alias("_g"), F.col("chunk").alias("_c")).distinct().join(aims, "_g")
    aim = F.get("_aims", F.pmod(F.xxhash64("node", F.lit(round_no)), F.size("_aims")).cast("int"))
    return (state.join(here, (F.col("group") == F.col("_g")) & (F.col("chunk") == F.col("_c"))).where(~F.exists("_aims", lambda x: x["shard"] == F.col("shard")))
            .withColumn("_aim", aim).where(F.col("_aim.w") >= F.try_element_at("_held", F.col("shard")))
            .select("node", "chunk", F.col("shard").alias("from"), F.col("_aim.shard").alias("to")))


def quotas(moves: DataFrame, sizes: DataFrame) -> DataFrame:
    """(from, to, quota): matched swaps, and shares of the free room for the rest.

    ``sizes``: shard, held, capacity.  All tables here have a row per pair of shards.
    """
    pairs = moves.groupBy("from", "to").agg(F.count(F.lit(1)).alias("n"))
    back = pairs.select(F.col("to").alias("_f"), F.col("from").alias("_t"), F.col("n").alias("_back"))
    matched = (pairs.join(back, (pairs["from"] == F.col("_f")) & (pairs["to"] == F.col("_t")), "left")
               .select("from", "to", "n", F.least("n", F.coalesce("_back", F.lit(0))).alias("swap")))
    room = sizes.select(F.col("shard").alias("to"), (F.col("capacity") - F.col("held")).alias("room"))
    rest = matched.groupBy("to").agg(F.sum(F.col("n") - F.col("swap")).alias("rest"))
    share = F.floor(F.col("room") * (F.col("n") - F.col("swap")) / F.greatest("rest", F.lit(1)))
    return (matched.join(room, "to").join(rest, "to")
            .select("from", "to", (F.col("swap") + F.least(F.col("n") - F.col("swap"), share)).alias("quota")))


def propagate(nodes: DataFrame, capacity: DataFrame, tables: WorkTables,
              rounds: int = ROUNDS, shards: int = SHARDS) -> DataFrame:
    """(node, chunk, shard) after ``rounds`` rounds.

    ``nodes``: node (unique), chunk (a few thousand rows that one task wrote), group;
    ``capacity``: shard, capacity.
    """
    numbered = number_rows(nodes, [], "_n", "chunk", "node")
    state = tables.keep(numbered.select("node", "chunk", "group", (F.col("_n") % shards).cast("int").alias("shard")), "state")
    for r in range(rounds):
        held = state.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
        sizes = capacity.join(held, "shard", "left").select("shard", "capacity", F.coalesce("held", F.lit(0)).alias("held"))
        moves = tables.keep(wishes(state, sizes, r), "wishes")
        if moves.isEmpty():
            break  # every group is as much together as it wants to be
        allowed = tables.keep(quotas(moves, sizes), "quotas")
        ranked = number_rows(moves, ["from", "to"], "_n", "chunk", "node")
        accepted = (ranked.join(allowed, ["from", "to"]).where("_n < quota")
                    .select("node", F.col("to").alias("_to")))
        fresh = tables.keep(state.join(accepted, "node", "left").select(
            "node", "chunk", "group", F.coalesce("_to", "shard").alias("shard")), "state")
        for t in (state, moves, allowed):
            tables.drop(t)
        state = fresh
    return state


def fill_up(singles: DataFrame, linked: DataFrame, capacity: DataFrame) -> DataFrame:
    """Gives documents without links (node, chunk) the room that the linked ones left.

    Returns node, shard and slot.  A document's number among all of them says
    which shard's room it falls into and its place there, after the linked ones.
    """
    held = linked.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    sizes = capacity.join(held, "shard", "left").orderBy("shard").select(
        "capacity", F.coalesce("held", F.lit(0)).alias("held")).collect()  # a row per shard
    ends = list(accumulate(r.capacity - r.held for r in sizes))
    shard = F.aggregate(F.array(*map(F.lit, ends)).cast("array<long>"), F.lit(0),
                        lambda acc, end: acc + F.when(F.col("_n") >= end, 1).otherwise(0))
    before = F.array(*[F.lit(r.held - start) for r, start in zip(sizes, [0, *ends], strict=False)]).cast("array<long>")
    numbered = number_rows(singles, [], "_n", "chunk", "node").withColumn("shard", shard.cast("int"))
    return numbered.select("node", "shard", (F.col("_n") + F.get(before, F.col("shard"))).alias("slot"))


def shard_documents(docs: DataFrame, keep: list[str], text: str = "text", shards: int = SHARDS,
                    rounds: int = ROUNDS) -> DataFrame:
    """``keep`` columns, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    tables = WorkTables(spark, "sharding")
    t = F.col(text).cast("string")
    # a chunk is a few thousand rows of one writer, so no task of the numbering or of a join takes more of one group
    chunked = lambda df: tag_rows(df, "chunk", "node").withColumn("chunk", F.shiftright("node", CHUNK_BITS))
    rows = tables.keep(chunked(docs.select(
        *keep, (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(t.cast("binary"))), F.lit(b"")).alias("_digest"))), "rows")
    total = rows.count()
    capacity = tables.keep(spark.range(shards).select(F.col("id").cast("int").alias("shard")).select(
        "shard", capacities(total, shards).cast("long").alias("capacity")), "capacity")
    key = ["_digest", "size"]
    heads = tables.keep(rows.groupBy(*key, "chunk").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("copies")), "heads")
    groups = heads.groupBy(*key).agg(F.min("head").alias("head"), F.sum("copies").alias("copies")).where("copies > 1")
    # a group meets its head once per chunk, then each chunk's rows meet that
    known = heads.select(*key, "chunk").join(groups.select(*key, "head"), key)
    grouped = tables.keep(rows.select("node", "chunk", *key).join(known, [*key, "chunk"], "left").select(
        "node", "chunk", "head"), "grouped")
    linked = propagate(grouped.where("head is not null").select("node", "chunk", F.col("head").alias("group")), capacity, tables, rounds, shards)
    singles = fill_up(grouped.where("head is null").select("node", "chunk"), linked, capacity)
    first = number_rows(linked, ["shard"], "slot", "chunk", "node").select("node", "shard", "slot")
    slots = tables.keep(first.union(singles), "slots").withColumnRenamed("node", "_node")
    return rows.join(slots, F.col("node") == F.col("_node")).select(*keep, "size", "text_crc32", "shard", "slot")


def sharding_report(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return shard_documents(docs, ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
