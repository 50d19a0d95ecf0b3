"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Every document becomes its token ids and an end mark; only documents longer
than a sequence are cut, their first piece being the shorter one, so that the
rest are full sequences of their own and one piece per document remains to be
packed.

The pieces are dealt into chunks of ``CHUNK`` rows; a chunk is one packing
problem, so the work grows with the rows and no task holds more.  For each
chunk several islands evolve populations of packings side by side (a Spark
group each).  Crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold an injected document a second time, and
best-fits the displaced documents back.  After each epoch every island sends
its elite to the next one through a Spark shuffle.  The best packing of any
island wins.  A packing is kept only as one bin number per piece.

Defined results: a null text counts as empty (one piece holding the end
mark); repeated rows and ids are separate documents; an empty table gives an
empty result; only the asked columns pass through.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkTables, number_rows, partitions, tag_rows

CAPACITY = 1024
END_ID = 2
CHUNK = 4096
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 3
POPULATION = 4

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


def load_tokenizer(path: str | None = None):
    """Encoder of the byte-level vocabulary in ``path`` (a tokenizers file), else of the installed one.

    The file's vocabulary is run by tiktoken, which gives the ids that the
    tokenizers library gives in a quarter of its time.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
             if token not in special}
    coder = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens=special)
    return lambda text: coder.encode_to_numpy(text, allowed_special="all")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first may be shorter, the rest are full."""
    first = length % capacity or capacity
    return [(0, min(first, length))] + [(s, capacity) for s in range(first, length, capacity)]


def tokenised(docs: DataFrame, keep: list[str], text: str = "text", capacity: int = CAPACITY,
              path: str | None = None) -> DataFrame:
    """``keep`` columns and ``pieces`` of every document, in one streaming pass."""
    src = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    schema = docs.select(*keep, F.lit(None).cast(PIECES).alias("pieces")).schema
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                               ("ids_crc32", pa.int64())]))

    def pieces(ids: np.ndarray) -> list[dict]:
        packed = np.append(ids, END_ID).astype("<u4")
        return [{"piece": i, "start": s, "length": n, "ids_crc32": zlib.crc32(packed[s:s + n].tobytes())}
                for i, (s, n) in enumerate(cut(len(packed), capacity))]

    def run(batches):
        encode = load_tokenizer(path)
        for b in batches:
            out = [pieces(encode(t.as_py())) for t in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(out, kind)],
                                             names=[*keep, "pieces"])

    return src.mapInArrow(run, schema)


def best_fit(order, length: list[int], bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Puts each piece of ``order`` where the least room is left, opening bins as needed."""
    free = sorted((r, k) for k, r in enumerate(room) if r)
    for x in order:
        n = length[x]
        at = bisect_left(free, (n, -1))
        if at < len(free):
            r, k = free.pop(at)
            bins[k].append(x)
        else:
            r, k = capacity, len(bins)
            bins.append([x])
            room.append(capacity)
        room[k] = r - n
        if r > n:
            insort(free, (r - n, k))


def by_bin(where: np.ndarray) -> list[list[int]]:
    order = np.argsort(where, kind="stable")
    ends = np.flatnonzero(np.diff(where[order])) + 1
    return [x.tolist() for x in np.split(order, ends)]


def numbered(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def fitness(where: np.ndarray, length: np.ndarray, capacity: int) -> float:
    """Fewer bins first; among equals the mean square fill, which favours full bins."""
    fill = np.bincount(where, weights=length) / capacity
    return -len(fill) + float((fill ** 2).mean())


def cross(base: np.ndarray, donor: np.ndarray, length: np.ndarray, capacity: int,
          rng: random.Random) -> np.ndarray:
    """A child: well-filled donor bins whole, the base's bins that they do not touch, best fit for the rest."""
    fill = np.bincount(donor, weights=length)
    good = np.flatnonzero(fill >= capacity * rng.choice((1.0, 1.0, 0.999, 0.995)))
    if not len(good):
        good = np.argsort(-fill)[:max(1, len(fill) // 4)]
    share = rng.choice((0.3, 0.6, 1.0))
    chosen = np.zeros(len(fill), bool)
    chosen[[k for k in good.tolist() if rng.random() < share] or good[:1]] = True
    injected = chosen[donor]
    touched = np.zeros(base.max() + 1, bool)
    touched[base[injected]] = True
    base_fill = np.bincount(base, weights=length)
    # bins that hold an injected document go, and with them some of the least filled
    weak = (base_fill < capacity * 0.98) & (np.array([rng.random() for _ in base_fill]) < 0.5)
    stays = ~injected & ~(touched | weak)[base]
    child = np.full(len(length), -1, np.int64)
    child[injected] = donor[injected]
    child[stays] = base[stays] + len(fill)
    placed = injected | stays
    _, child[placed] = np.unique(child[placed], return_inverse=True)
    bins = by_bin(child[placed])
    index = np.flatnonzero(placed)
    bins = [index[b].tolist() for b in bins] if placed.any() else []
    sizes = length.tolist()
    room = [capacity - sum(sizes[x] for x in b) for b in bins]
    loose = np.flatnonzero(~placed)
    loose = loose[np.argsort(-length[loose], kind="stable")]
    best_fit(loose.tolist(), sizes, bins, room, capacity)
    return numbered(bins, len(length))


def founders(length: np.ndarray, capacity: int, count: int, rng: random.Random) -> list[np.ndarray]:
    """Best fit over the pieces by falling length, exactly and with lengths blurred."""
    out, sizes = [], length.tolist()
    for i in range(count):
        blur = length * np.array([1 + rng.uniform(-.08, .08) * (i > 0) for _ in sizes])
        bins: list[list[int]] = []
        best_fit(np.argsort(-blur, kind="stable").tolist(), sizes, bins, [], capacity)
        out.append(numbered(bins, len(sizes)))
    return out


def evolve(length: np.ndarray, people: list[np.ndarray], capacity: int, generations: int,
           rng: random.Random) -> list[np.ndarray]:
    """Steady-state evolution: each child replaces the worst if it is fitter."""
    least = -(-int(length.sum()) // capacity)
    ranked = sorted(((fitness(p, length, capacity), i, p) for i, p in enumerate(people)), key=lambda x: (-x[0], x[1]))
    serial = len(ranked)
    for _ in range(generations * len(people)):
        if ranked[0][2].max() + 1 <= least:
            break  # no packing can have fewer bins
        a, b = rng.sample(range(len(ranked)), 2) if len(ranked) > 1 else (0, 0)
        child = cross(ranked[a][2], ranked[b][2], length, capacity, rng)
        fit = fitness(child, length, capacity)
        if fit > ranked[-1][0]:
            ranked[-1] = (fit, serial, child)
            serial += 1
            ranked.sort(key=lambda x: (-x[0], x[1]))
    return [p for _, _, p in ranked]


ISLAND = "chunk long, island int, rank int, fitness double, places binary"


def evolved(problems: DataFrame, people: DataFrame | None, epoch: int, capacity: int, islands: int,
            chunks: int, seed: int) -> DataFrame:
    """One epoch on every island; ``problems``: chunk, lengths (of its pieces, in order)."""
    def run(key, own: pd.DataFrame, pop: pd.DataFrame | None) -> pd.DataFrame:
        chunk, island = int(key[0]), int(key[1])
        rng = random.Random(f"{seed}|{chunk}|{island}|{epoch}")
        length = np.asarray(own["lengths"].iloc[0], np.int64)
        if pop is None:
            start = founders(length, capacity, POPULATION, rng)
        else:
            pop = pop.sort_values(["fitness", "rank"], ascending=[False, True])
            start = [np.frombuffer(p, np.int32) for p in pop["places"].head(POPULATION)]
        end = evolve(length, start, capacity, GENERATIONS, rng)
        return pd.DataFrame({"chunk": chunk, "island": island, "rank": range(len(end)),
                             "fitness": [fitness(p, length, capacity) for p in end],
                             "places": [p.astype(np.int32).tobytes() for p in end]})

    # tasks by their work, which is the same for every island, and not by bytes
    tasks = max(partitions(problems.sparkSession), chunks * islands // 64)
    spread = (problems.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
              .repartition(tasks, "chunk", "island"))
    if people is None:
        return spread.groupBy("chunk", "island").applyInPandas(lambda key, own: run(key, own, None), ISLAND)
    moved = people.where("rank = 0").withColumn(  # elites visit the next island, and stay at home
        "island", ((F.col("island") + 1) % islands).cast("int"))
    people = people.union(moved).repartition(tasks, "chunk", "island")
    return (spread.groupBy("chunk", "island").cogroup(people.groupBy("chunk", "island"))
            .applyInPandas(run, ISLAND))


def pack(docs: DataFrame, keep: list[str], text: str = "text", capacity: int = CAPACITY,
         path: str | None = None, chunk_rows: int = CHUNK, islands: int = ISLANDS, epochs: int = EPOCHS,
         seed: int = 11) -> DataFrame:
    """Per piece: ``keep`` columns, piece, start, length, ids_crc32, sequence_id and offset."""
    tables = WorkTables(docs.sparkSession, "packing")
    whole = tokenised(docs, keep, text, capacity, path)
    pieces = tables.keep(tag_rows(whole.select(*keep, F.explode("pieces").alias("p")).select(*keep, "p.*")), "pieces")
    # full pieces are sequences of their own; the others are dealt out by a gapless number
    small = number_rows(pieces.where(F.col("length") < capacity).select("_chunk", "_pos", "length"), [], "number")
    total = small.count()
    chunks = max(1, -(-total // chunk_rows))
    small = tables.keep(small.select(
        "_pos", "length", (F.col("number") % chunks).alias("chunk"),
        F.floor(F.col("number") / chunks).cast("int").alias("item")), "small")
    problems = tables.keep(small.groupBy("chunk").agg(F.array_sort(F.collect_list(
        F.struct("item", "length"))).alias("items")).select("chunk", F.col("items.length").alias("lengths")), "problems")
    people = None
    for epoch in range(epochs):
        people = tables.keep(evolved(problems, people, epoch, capacity, islands, chunks, seed), "islands")

    def placed(pdf: pd.DataFrame) -> pd.DataFrame:
        best = pdf.sort_values(["fitness", "island", "rank"], ascending=[False, True, True]).iloc[0]
        where = np.frombuffer(best["places"], np.int32)
        length = np.asarray(best["lengths"], np.int64)
        order = np.argsort(where, kind="stable")
        run = np.cumsum(length[order]) - length[order]
        first = np.searchsorted(where[order], where[order])
        offset = np.empty(len(where), np.int64)
        offset[order] = run - run[first]
        return pd.DataFrame({"chunk": best["chunk"], "item": np.arange(len(where), dtype=np.int32), "bin": where,
                             "offset": offset})

    elite = people.where("rank = 0").join(problems, "chunk")
    found = elite.groupBy("chunk").applyInPandas(placed, "chunk long, item int, bin int, offset long")
    home = small.join(found, ["chunk", "item"]).select(
        F.col("_pos").alias("_at"), (2 * (F.col("chunk") * (1 << 24) + F.col("bin"))).alias("bin_id"),
        F.col("offset").alias("bin_offset"))
    columns = [*keep, "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") >= capacity).select(
        *columns, (2 * F.col("_pos") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity).join(home, F.col("_pos") == F.col("_at")).select(
        *columns, F.col("bin_id").alias("sequence_id"), F.col("bin_offset").alias("offset"))
    return full.union(part)


def packing_report(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return pack(docs, ["doc_id"])
