"""Spark session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes.  ANSI mode stays on: all
# conversions of untrusted text go through try_* functions.
LIBRARY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Contract timestamps are millisecond instants; never INT96.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    # Dynamic overwrite replaces only the (feed, date) partitions a job touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "tapeworks",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library settings applied."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in LIBRARY_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a private scratch folder
    (tests); a cluster session without the setting is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster"
        )
    scratch = tempfile.mkdtemp(prefix="tapeworks-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder.

    One job writes it (columnar, compressed); the returned DataFrame reads
    it back, so later uses neither recompute nor re-shuffle the input and a
    lost executor only costs re-reading files.  Never a machine-local folder.
    The table lives until the program ends or the enclosing
    :func:`temporary_tables` block does.
    """
    spark = df.sparkSession
    target = f"{checkpoint_dir(spark).rstrip('/')}/tw-{uuid.uuid4().hex}"
    _TABLES.append((spark, target))
    df.write.parquet(target)
    return spark.read.parquet(target)


# Materialised tables of this program that have not been deleted yet.
_TABLES: list[tuple[SparkSession, str]] = []


def delete_at_end(spark: SparkSession, folder: str) -> None:
    """A working folder that goes when the program, or the enclosing block, ends."""
    _TABLES.append((spark, folder))


def _delete(tables: list[tuple[SparkSession, str]]) -> None:
    for spark, target in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_tables():
    """Tables that :func:`cut_lineage` writes inside the block are deleted after it.

    For jobs that run again and again (a stream's micro-batches) and have
    written their results when the block ends.
    """
    start = len(_TABLES)
    try:
        yield
    finally:
        mine = _TABLES[start:]
        del _TABLES[start:]
        _delete(mine)


@atexit.register
def _release() -> None:
    """At the end of the program; a session that is already stopped keeps its tables."""
    live = [(s, t) for s, t in _TABLES if getattr(s.sparkContext, "_jsc", None) is not None]
    _TABLES.clear()
    _delete(live)
