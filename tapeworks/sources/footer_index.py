"""An index of Parquet footers, so that a check of many files opens only those that changed.

The index is a table with a row per file: what its footer says, and the path,
length and modification time it was read at.  A refresh joins the listing with
it, opens the files that are not in it as they are now, and writes the rows of
all listed files as the next version; files that are gone drop out.  A file
that can't be read is opened again each time.  The index is a cache: losing it
costs one full reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, delete_at_end
from .folders import Folder
from .inventory import FOOTER_SCHEMA, read_footers

STAMP = ["path", "length", "modification_time"]
INDEX_SCHEMA = f"{FOOTER_SCHEMA}, length bigint, modification_time timestamp"


def latest(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The last version and its rows; 0 and none if there is no index yet."""
    versions = [int(n.split("=")[1]) for n in Folder(spark, root).names() if n.startswith("version=")]
    if not versions:
        return 0, spark.createDataFrame([], INDEX_SCHEMA)
    return max(versions), spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/version={max(versions):010d}")


def refresh(files: DataFrame, root: str, footer_key: str = "") -> DataFrame:
    """Footer facts of ``files`` (path, length, modification_time), as :func:`.inventory.read_footers`
    gives them, plus ``opened``: whether this refresh had to read the file."""
    spark = files.sparkSession
    files = files.select(*STAMP)
    version, known = latest(spark, root)
    have = known.where("readable").join(files, STAMP, "left_semi")
    new = cut_lineage(files.join(known.where("readable").select(*STAMP), STAMP, "left_anti"))
    opened = new.join(read_footers(new, footer_key).drop("prov"), "path")
    columns = INDEX_SCHEMA.replace(",", "").split()[::2]
    rows = cut_lineage(have.select(*columns, F.lit(False).alias("opened")).unionByName(
        opened.select(*columns, F.lit(True).alias("opened"))))
    if not new.isEmpty() or have.count() != known.count():
        _write(spark, rows.drop("opened"), root, version)
    return rows


def _write(spark: SparkSession, rows: DataFrame, root: str, version: int) -> None:
    """The next version, complete or not at all; older ones than the last go."""
    folder, staged = Folder(spark, root), f"{root}/_next-{version + 1:010d}"
    folder.delete(f"_next-{version + 1:010d}")
    delete_at_end(spark, staged)
    rows.write.parquet(staged)
    if folder.rename_new(folder.child(f"_next-{version + 1:010d}"), f"version={version + 1:010d}"):
        for name in folder.names():
            if name.startswith("version=") and int(name.split("=")[1]) < version:
                folder.delete(name)
