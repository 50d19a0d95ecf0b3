"""Publish stage: copies of archives and ticks in another store, with an outcome of its own.

Publishing never decides what is ingested and a failure of it never stops a
date: files are copied in tasks, each tried several times, and every date gets
a status and, if something failed, the errors of its files.  A copy goes to a
temporary name and is renamed when it is whole, so a repeated or lost task
does no harm, and what failed can be published again from the same list.
"""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import archive_key, basename, ticks_key
from ..operators import runlog
from ..operators.validate import FILE_KEYS
from ..session import cut_lineage
from ..sources.inventory import arrow_file

ATTEMPTS = 3
WAIT_SECONDS = 0.2
COPY_BYTES = 8 << 20

_COPIED = "feed string, file_date date, src string, error string, bytes long, attempts int"


def _copy(src: str, dst: str) -> int:
    """Bytes copied, a block at a time; the target appears only when it is whole."""
    (from_fs, a), (to_fs, b) = arrow_file(src), arrow_file(dst)
    to_fs.create_dir(b.rsplit("/", 1)[0], recursive=True)
    size, part = 0, f"{b}.{time.time_ns():x}.part"
    try:
        with from_fs.open_input_stream(a) as source, to_fs.open_output_stream(part) as out:
            while block := source.read(COPY_BYTES):
                out.write(block)
                size += len(block)
        to_fs.move(part, b)
    except Exception:
        if to_fs.get_file_info(part).type != pa.fs.FileType.NotFound:
            to_fs.delete_file(part)
        raise
    return size


def _copier(attempts: int):
    def run(batches):
        import pyarrow.fs  # noqa: F401
        for b in batches:
            for feed, day, src, dst in zip(*[c.to_pylist() for c in b.columns], strict=True):
                error, size, tried = None, None, 0
                while tried < attempts and size is None:
                    if tried:
                        time.sleep(WAIT_SECONDS * 2 ** (tried - 1))
                    tried += 1
                    try:
                        size = _copy(src, dst)
                    except Exception as exc:  # noqa: BLE001 - an outcome of this file
                        error = f"{src.rsplit('/', 1)[-1]}: {type(exc).__name__}: {exc}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([feed], pa.string()), pa.array([day], pa.date32()), pa.array([src]),
                     pa.array([error if size is None else None], pa.string()), pa.array([size], pa.int64()), pa.array([tried], pa.int32())],
                    names=["feed", "file_date", "src", "error", "bytes", "attempts"])

    return run


def publish(files: DataFrame, attempts: int = ATTEMPTS) -> DataFrame:
    """``(feed, file_date, status, error, n_files, bytes, attempts)`` of each date of ``files``.

    ``files``: (feed, file_date, src, dst), URIs.  Runs once, now.  A date is
    FAILED if any file of it is; its error names them in order.
    """
    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    copied = cut_lineage(files.select(*FILE_KEYS, "src", "dst").repartition(n, "src").mapInArrow(_copier(attempts), _COPIED))
    errors = F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("src", "error"))))
    return copied.groupBy(*FILE_KEYS).agg(
        F.when(F.count("error") > 0, runlog.FAILED).otherwise(runlog.SUCCESS).alias("status"),
        F.when(F.count("error") > 0, F.array_join(F.transform(errors, lambda e: e["error"]), "; ")).alias("error"),
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.max("attempts").alias("attempts"))


def archive_targets(inventory: DataFrame, store: str) -> DataFrame:
    """(feed, file_date, src, dst) of archives: ``(path, feed, file_date)`` as the archive inventory has them."""
    return inventory.select(*FILE_KEYS, F.col("path").alias("src"), F.concat(
        F.lit(f"{store.rstrip('/')}/"), archive_key(F.col("feed"), F.col("file_date"))).alias("dst"))


def ticks_targets(files: DataFrame, store: str) -> DataFrame:
    """(feed, file_date, src, dst) of the published ticks files ``(path, feed, file_date)``: a folder per day."""
    day = F.regexp_replace(ticks_key(F.col("feed"), F.col("file_date")), r"\.parquet$", "/")
    return files.select(*FILE_KEYS, F.col("path").alias("src"), F.concat(
        F.lit(f"{store.rstrip('/')}/"), day, basename(F.col("path"))).alias("dst"))
