"""Shared pieces of the training-data operators: working tables and scalable numbering."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, delete_at_end

#: Rows an Arrow batch may carry into Python; texts can be 100 KB each.
TEXT_BATCH_ROWS = 1000


class WorkTables:
    """Tables a multi-step job writes to the shared checkpoint folder.

    ``keep`` writes a DataFrame once as Parquet and returns the re-read
    table, so no step is computed twice and a lost executor only costs
    re-reading files.  ``drop`` deletes a table that a later one replaces.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.step = 0
        delete_at_end(spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        path = f"{self.root}/{self.step:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._work_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_work_path", None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tag_rows(df: DataFrame, chunk: str = "_chunk", pos: str = "_pos") -> DataFrame:
    """Adds the writing task and the row's place in it; stable once the result is kept."""
    return df.withColumns({chunk: F.spark_partition_id(), pos: F.monotonically_increasing_id()})


def number_rows(df: DataFrame, groups: list[str], out: str, chunk: str = "_chunk",
                pos: str = "_pos") -> DataFrame:
    """0-based gapless number of each row inside its group, in (chunk, pos) order.

    ``df`` is a kept table tagged by ``tag_rows``.  Rows are counted per
    (group, chunk); a running sum over that small table gives each chunk's
    offset, and only rows of one (group, chunk) meet in a window.  A group of
    any size is thus spread over as many tasks as chunks wrote it.
    """
    counts = df.groupBy(*groups, chunk).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    if not groups:
        before = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(chunk).alias("_oc"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*groups, chunk).orderBy(pos)
    on: Column = F.col(chunk) == F.col("_oc")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    ranked = df.withColumn("_rank", F.row_number().over(inside))
    return (ranked.join(offsets, on, "left")
            .withColumn(out, (F.col("_off") + F.col("_rank") - 1).cast("long"))
            .drop("_rank", "_oc", "_off", *[f"_g{i}" for i in range(len(groups))]))


def one_of_each(docs: DataFrame, named: DataFrame, columns: list[str]) -> DataFrame:
    """One row of ``docs`` per name in ``named``, with ``named``'s further columns.

    ``columns`` make the name and may be null.  They become plain keys with a
    null flag, so the join and the choice of one row share one shuffle.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({f"_k{i}": F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(columns)}
                              | {f"_z{i}": F.col(c).isNull() for i, c in enumerate(columns)})

    keys = [f"{x}{i}" for i in range(len(columns)) for x in ("_k", "_z")]
    return keyed(docs).join(keyed(named).drop(*columns), keys).dropDuplicates(keys).drop(*keys)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")
