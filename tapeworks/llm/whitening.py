"""Embedding whitening from a bit-sliced scatter matrix.

Every component c becomes the integer floor(1024 * c) + 100000.  A block of
rows is shifted to its own least value per dimension; the bits of what is
left are packed across rows, so that plane b of a dimension is one row of
64-bit words.  The cross-product of two dimensions is then a weighted sum of
popcounts: plane a of one AND plane b of the other counts 2^(a+b) a bit.  The
shift is taken out again in integers of any size, and a task's sums leave it
as limbs of 32 bits, which Spark adds up as plain longs.  So n, the sums S and
the scatter are exact whatever the number of rows; n * scatter - S S' centres
them before the first division, and only that matrix is decomposed.

The driver holds one matrix of dimensions x dimensions; its size depends on
the length of a vector, never on the number of rows.

Defined results: vectors that are null or hold a null or non-finite component
are dropped; a shorter vector's missing components are zero; rows without an
id and rows that repeat an id or a vector all count and are all returned;
floor(1024 * c) beyond 2^62 in size is held at 2^62; a deviation that no long
holds is null in the report (the operator returns it as text); a component
without variance (its eigenvalue is rounding noise of the largest) has no
whitened value and takes no part in the identity error; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkTables

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Entries of the integer matrix that a block holds at most.
BLOCK_ENTRIES = 1 << 20
LIMBS = 5  # 160 bits: products of two 64-bit values over 2^31 rows a task
LIMB_BITS = 32
LIMIT = 1 << 62


def fit_rows(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there and finite throughout, as ``_v``: array<double>."""
    values = F.col(vector).cast("array<double>")
    fit = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & fit).withColumn("_v", values)


def integers(column: pa.ListArray, dims: int) -> np.ndarray:
    """(rows, dims) of floor(1024 * c) + 100000; missing components are zero."""
    length = np.diff(column.offsets.to_numpy())
    c = np.zeros((len(length), dims))
    c[np.arange(dims) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(c * SCALE), -float(LIMIT), float(LIMIT)).astype(np.int64) + SHIFT


def slices(column: pa.Array, dims: int):
    size = max(1, BLOCK_ENTRIES // max(1, dims))
    for i in range(0, len(column), size):
        yield pa.concat_arrays([column.slice(i, size)])


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes that hold a bit, by dimension: words (planes, rows / 64), their dimension, their bit."""
    rows, dims = u.shape
    columns = np.ascontiguousarray(u.T)
    width = int(u.max(initial=0)).bit_length()
    packed = np.zeros((dims, width, -(-rows // 64) * 8), np.uint8)
    for b in range(width):
        bits = (columns >> np.uint64(b)) & np.uint64(1)
        packed[:, b, :-(-rows // 8)] = np.packbits(bits.astype(np.uint8), axis=1)
    words = packed.reshape(dims * width, packed.shape[2]).view(np.uint64)
    dim, bit = np.divmod(np.arange(dims * width), max(1, width))
    some = words.any(axis=1)
    return words[some], dim[some], bit[some]


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products (upper triangle) of the columns, as Python integers."""
    rows, dims = x.shape
    low = x.min(axis=0, initial=0 if not rows else np.iinfo(np.int64).max)
    u = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2^64: exact, as no range reaches that
    words, dim, bit = bit_planes(u)
    wide = 2 * int(bit.max(initial=0)) + rows.bit_length() + 3 + dims.bit_length() > 62
    kind = object if wide else np.int64
    weight = np.array([1 << int(b) for b in bit], kind)
    sums, cross = np.zeros(dims, object), np.zeros((dims, dims), object)
    if len(words):
        first = np.flatnonzero(np.r_[True, np.diff(dim) > 0])
        sums[dim[first]] = np.add.reduceat(np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(kind) * weight, first)
        acc = np.zeros((dims, dims), kind)
        for p in range(len(words)):
            count = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64).astype(kind) * weight[p:] * weight[p]
            count[1:][dim[p + 1:] == dim[p]] *= 2  # two planes of one dimension meet in both orders
            starts = np.flatnonzero(np.r_[True, np.diff(dim[p:]) > 0])
            acc[dim[p], dim[p:][starts]] += np.add.reduceat(count, starts)
        cross += acc
    low = low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, np.triu(cross)


def limbs(values: list[int]) -> list[pa.Array]:
    """Columns whose sums over rows, weighted by 2^(32 k), are the sums of the values; the last one has the sign."""
    mask = (1 << LIMB_BITS) - 1
    columns = [[(v >> LIMB_BITS * k) & mask for v in values] for k in range(LIMBS - 1)]
    columns.append([v >> LIMB_BITS * (LIMBS - 1) for v in values])
    return [pa.array(c, pa.int64()) for c in columns]


@dataclass(frozen=True)
class Whitening:
    """n vectors, their sums S, and the leading eigenpairs of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray      # falling
    vectors: np.ndarray     # (dims, components), unit columns
    trace: float
    usable: np.ndarray      # components with variance


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (``_v``: array<double>), None if there are none."""
    dims = rows.agg(F.max(F.size("_v"))).first()[0]
    if dims is None:
        return None

    def run(batches):
        n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            for part in slices(b.column(0), dims):
                x = integers(part, dims)
                s, c = scatter(x)
                n, sums, cross = n + len(x), sums + s, cross + c
        if n:
            i, j = np.triu_indices(dims)
            at = [(-1, -1), *((d, -1) for d in range(dims)), *zip(i.tolist(), j.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in at], pa.int32()), pa.array([b for _, b in at], pa.int32()),
                 *limbs([n, *map(int, sums), *map(int, cross[i, j])])],
                names=["i", "j", *[f"l{k}" for k in range(LIMBS)]])

    schema = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    total = (rows.select("_v").mapInArrow(run, schema).groupBy("i", "j")
             .agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).toArrow())
    value = {(i, j): sum(v << LIMB_BITS * k for k, v in enumerate(parts))
             for i, j, *parts in zip(*[c.to_pylist() for c in total.columns], strict=True)}
    n, sums = value[-1, -1], [value[d, -1] for d in range(dims)]
    v = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * value[i, j] - sums[i] * sums[j]) / (n * n)  # integers: rounded once
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    noise = dims * np.finfo(float).eps * (values[0] if len(values) else 0.0)
    return Whitening(n, sums, values, np.ascontiguousarray(vectors), float(np.trace(v)), values > noise)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as longs where they hold it and the sum of its squares, else as Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most >= LIMIT:
        x, sums = x.astype(object), np.array(sums, object)
    num = x * n - np.asarray(sums)
    far = max(abs(int(num.max(initial=0))), abs(int(num.min(initial=0))))
    return num if far * far * max(1, x.shape[1]) < LIMIT else num.astype(object)


def apply(rows: DataFrame, keep: list[str], model: Whitening) -> DataFrame:
    """``keep`` columns, ``deviation`` (text of an integer) and ``whitened`` (array, null without variance)."""
    dims, k = len(model.sums), len(model.values)
    scale = np.sqrt(np.where(model.usable, model.values, 1.0))

    def run(batches):
        for b in batches:
            at = 0
            for part in slices(b.column(b.num_columns - 1), dims):
                num = centred(integers(part, dims), model.n, model.sums)
                w = (num / model.n).astype(float) @ model.vectors / scale
                flat = pa.array(w.ravel(), mask=np.tile(~model.usable, len(part)))
                kept = b.slice(at, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:-1], pa.array([str(d) for d in (num * num).sum(axis=1)], pa.string()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * k), flat)],
                    names=[*keep, "deviation", "whitened"])
                at += len(part)

    rows = rows.select(*keep, "_v")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, deviation string, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened values' covariance minus the identity."""
    used = np.flatnonzero(model.usable).tolist()
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return None
    w = [F.col("whitened")[i] for i in range(len(model.values))]
    mean = whitened.agg(*[F.avg(x) for x in w]).first()
    off = {i: w[i] - F.lit(mean[i]) for i in used}
    got = whitened.agg(*[F.sum(off[i] * off[j]) for i, j in pairs]).first()
    return max(abs(c / model.n - (i == j)) for (i, j), c in zip(pairs, got, strict=True))


REPORT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whitening_report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The columns of the registered query: a row per remaining vector and component."""
    spark = vectors.sparkSession
    tables = WorkTables(spark, "whitening")
    rows = fit_rows(vectors)
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], REPORT)
    done = tables.keep(apply(rows, ["vec_id"], model), "whitened")
    explained = [float(e / model.trace) if model.trace else None for e in model.values]
    error = identity_error(done, model)
    return (done.select("vec_id", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
            .select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("_k") + 1).cast("int").alias("component"),
                    F.lit(model.n).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"),
                    "whitened",
                    F.array(*[F.lit(x).cast("double") for x in explained])[F.col("_k")].alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
