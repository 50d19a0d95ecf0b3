"""Row numbering inside very large groups without a per-group window.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group into one
task; a feed-day can hold a third of all rows.  The operators here number
rows the way ``zipWithIndex`` does, on DataFrames:

1. rows are laid out in order (a range sort, or the physical order of a
   text scan), so each group is a run of contiguous *chunks*;
2. ``monotonically_increasing_id`` gives each row its position inside its
   chunk (ids are consecutive within a Spark partition);
3. a tiny aggregate per (group, chunk) gives the chunk size and first id;
   a running sum over the chunks of a group (a window over that tiny table)
   gives each chunk's offset;
4. the offsets are joined back (AQE broadcasts them when they are small).

The positional ids must be the same in both uses of the input, so the tagged
rows are materialised once (Parquet in ``spark.checkpoint.dir``).  This holds
for a file scan too: its splits depend on settings, cores and neighbouring
files at the moment it is planned, and may differ when it is planned again.
A row whose chunk has no offset is an error, never a dropped row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_POS = "_tw_pos"
POS = _POS
_CHUNK = "_tw_chunk"


def _number_chunks(df: DataFrame, group_cols: list[str], chunk_cols: list[str],
                   out: str) -> DataFrame:
    stats = (df.groupBy(*group_cols, *chunk_cols)
               .agg(F.min(_POS).alias("_tw_first"), F.count(F.lit(1)).alias("_tw_n")))
    w = (Window.partitionBy(*group_cols).orderBy(*chunk_cols)
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stats.withColumn("_tw_off", F.coalesce(F.sum("_tw_n").over(w), F.lit(0)))
    offsets = offsets.select(*group_cols, *chunk_cols, "_tw_first", "_tw_off")
    # One row per (group, chunk): materialise it once, so every later use of
    # the numbered rows is a scan plus a join with a small table (AQE
    # broadcasts it when its size allows), not a re-run of the aggregate.
    offsets = cut_lineage(offsets)
    joined = df.join(offsets, on=[*group_cols, *chunk_cols], how="left")
    known = F.coalesce(F.col("_tw_off"), F.raise_error(F.lit("a line's chunk has no offset")).cast("bigint"))
    return joined.withColumn(
        out, (known + (F.col(_POS) - F.col("_tw_first")) + 1).cast("int")
    ).drop(_POS, "_tw_first", "_tw_off", *[c for c in chunk_cols if c.startswith("_tw_")])


def sequence_within(df: DataFrame, group_cols: list[str], order_cols: list,
                    out: str = "seq", project=None, lead: Column | None = None) -> DataFrame:
    """1-based rank of each row inside its group, by ``order_cols``.

    The ordering must be total within a group (ties get arbitrary but
    distinct numbers).  Cost: one range-partitioning sort, one checkpoint
    write, one small aggregate, one join back.

    ``project`` (DataFrame -> DataFrame, keeping ``group_cols`` and
    :data:`POS`) runs after the sort, inside the materialising stage - put
    expensive per-row work there so the sort's sampling pass never pays it.

    ``lead`` is one number that never falls along ``(*group_cols,
    *order_cols)``.  Rows are laid out by it first and by all columns where it
    ties, so it changes no number; most pairs of rows are then told apart by
    that number instead of column by column.
    """
    order = [*group_cols, *order_cols] if lead is None else [lead, *group_cols, *order_cols]
    # An explicit count (the cluster's shuffle parallelism): AQE would
    # otherwise coalesce small inputs into a couple of tasks, and the rows
    # carry CPU-heavy work (rendering, validation) after this point.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ordered.withColumn(_POS, F.monotonically_increasing_id())
    if project is not None:
        tagged = project(tagged)
    # the projection runs in the sort's own tasks, so the task number still is the chunk
    tagged = cut_lineage(tagged.withColumn(_CHUNK, F.spark_partition_id()))
    return _number_chunks(tagged, list(group_cols), [_CHUNK], out)


def physical_line_numbers(scan: DataFrame, file_col: str = "path",
                          out: str = "line_no") -> DataFrame:
    """Physical line numbers for a ``spark.read.text`` scan.

    ``scan`` must carry ``file_col`` (the file path) and ``_tw_block``
    (``_metadata.file_block_start``).  Each split is one chunk: its rows are
    contiguous inside one Spark partition and splits are ordered by their
    start offset inside a file.  Blank lines are rows too, so they consume
    a number.  The scan is materialised with its positions, so lines and
    offsets come from one reading of the files.
    """
    tagged = cut_lineage(scan.withColumn(_POS, F.monotonically_increasing_id()))
    return _number_chunks(tagged, [file_col], ["_tw_block"], out)
