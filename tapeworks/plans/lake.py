"""Published ticks and provenance become visible together, by one commit per batch.

A batch is written to a staging folder, checked there, moved into the date
folders under names that begin with its generation, and then committed: one
rename of a small folder to ``commits/version=N``, which fails if another
writer took the version.  Readers take, per feed and date, the files of the
generation that the last commit names.  Whatever fails before the rename
leaves every date as it was; whatever fails after it leaves superseded files,
which no reader takes and the next write of the date removes.

Layout: ``ticks/feed=/year=/file_date=/{generation}-*.parquet``, the same
under ``provenance``, and ``commits/version=N/*.json`` with one line per
published date: its generation, row count and trades per session.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..operators.validate import FILE_KEYS
from ..session import cut_lineage, delete_at_end
from ..sources.folders import Folder

COMMIT_SCHEMA = ("feed string, file_date date, generation string, row_count bigint, "
                 "sessions array<struct<session_date: date, n_trades: bigint, volume: bigint>>, version bigint")
TICKS_SCHEMA = ", ".join(f"{n} {t.simpleString()}" for n, t, _ in C.CONTRACT_FIELDS) + ", feed string, year int, file_date date"
GENERATION = r"^(g[0-9]{8}T[0-9]{12}-[0-9a-f]{8})-"
PARTITION = ["feed", "year", "file_date"]


def new_generation() -> str:
    return f"g{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


# --- Reading ---

def commit_log(spark: SparkSession, root: str) -> DataFrame | None:
    """Every committed (feed, file_date, generation, ...) with its version; None if nothing is published."""
    if not any(n.startswith("version=") for n in Folder(spark, f"{root}/commits").names()):
        return None
    return spark.read.schema(COMMIT_SCHEMA).json(f"{root}/commits")


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """``(feed, file_date, generation, row_count, sessions, version)`` of every published date."""
    log = commit_log(spark, root)
    if log is None:
        return None
    state = F.struct("generation", "row_count", "sessions", "version")
    return log.groupBy(*FILE_KEYS).agg(F.max_by(state, "version").alias("_s")).select(*FILE_KEYS, "_s.*")


def generation_of(name: Column) -> Column:
    """The generation in a file name; null for a file that no commit wrote."""
    g = F.regexp_extract(name, GENERATION, 1)
    return F.when(g != "", g)


def tick_paths(root: str, published: list) -> list[str]:
    return [f"{root}/ticks/{date_folder(r.feed, r.file_date)}/{r.generation}-*.parquet" for r in published]


def published_provenance(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    """The provenance rows of the committed generations."""
    live = current(spark, root)
    if live is None:
        return None
    rows = spark.read.schema(schema).parquet(f"{root}/provenance").withColumn(
        "generation", generation_of(F.col("_metadata.file_name")))
    return rows.join(live.select(*FILE_KEYS, "generation"), [*FILE_KEYS, "generation"], "left_semi").drop("generation")


# --- Writing ---

class Generation:
    """One batch on its way into the lake: staged, measured, moved, committed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.name = spark, root.rstrip("/"), new_generation()
        self.staging = f"{self.root}/_staging/{self.name}"
        delete_at_end(spark, self.staging)

    def stage(self, rows: DataFrame, table: str) -> int:
        """Writes the rows and returns how many the write itself saw."""
        seen = Observation()
        (rows.observe(seen, F.count(F.lit(1)).alias("n"))
         .write.partitionBy(*PARTITION).parquet(f"{self.staging}/{table}"))
        return seen.get["n"]

    def staged_ticks(self) -> DataFrame:
        return self.spark.read.schema(TICKS_SCHEMA).parquet(f"{self.staging}/ticks")

    def measure(self, written: int) -> tuple[DataFrame, DataFrame]:
        """Counts per file, and per file and session, of what stands on disk.

        The source is not read again: this scans four columns of the files
        just written.  They must hold as many rows as the write saw.
        """
        per = cut_lineage(self.staged_ticks().groupBy(*FILE_KEYS, "trade_date").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("timestamp").isNull()).alias("nulls"),
            F.count_if(F.col("trade_date") != F.col("reference_date")).alias("others"), F.sum("quantity").alias("volume")))
        facts = cut_lineage(per.groupBy(*FILE_KEYS).agg(
            F.sum("n").alias("row_count"), F.sum("nulls").alias("timestamp_null_count"),
            F.sum("others").alias("other_session_row_count")))
        found = facts.agg(F.sum("row_count")).first()[0] or 0
        if found != written:
            raise RuntimeError(f"the write saw {written} rows, {found} stand in {self.staging}")
        sessions = per.select(*FILE_KEYS, F.try_to_date("trade_date", "yyyy-MM-dd").alias("session_date"),
                              F.col("n").alias("n_trades"), "volume")
        return facts, sessions

    def move(self, table: str, refused: set[str]) -> None:
        """Moves staged files into their date folders; not visible before the commit.

        A rename per file on the driver, as Spark's own commit of a write does.
        """
        staged, target = Folder(self.spark, f"{self.staging}/{table}"), Folder(self.spark, f"{self.root}/{table}")
        for rel in staged.files():
            folder, name = rel.rsplit("/", 1)
            if folder not in refused and not target.rename_new(staged.child(rel), f"{folder}/{self.name}-{name}"):
                raise RuntimeError(f"{folder}/{self.name}-{name} is there already")

    def commit(self, facts: DataFrame, sessions: DataFrame) -> int:
        """Makes the moved files the published ones: the one step that readers see."""
        s = F.struct("session_date", "n_trades", "volume")
        rows = facts.join(sessions.groupBy(*FILE_KEYS).agg(F.array_sort(F.collect_list(s)).alias("sessions")), FILE_KEYS).select(
            *FILE_KEYS, F.lit(self.name).alias("generation"), "row_count", "sessions")
        rows.coalesce(1).write.json(f"{self.staging}/commit")  # a line per date
        log, made = Folder(self.spark, f"{self.root}/commits"), Folder(self.spark, f"{self.staging}/commit")
        while True:
            taken = [int(n.split("=")[1]) for n in log.names() if n.startswith("version=")]
            version = max(taken, default=0) + 1
            if log.rename_new(made.path, f"version={version:010d}"):
                return version

    def superseded(self, dates: DataFrame) -> list:
        """(feed, file_date, generation) of what is committed for ``dates`` so far: a row per date and commit of it."""
        log = commit_log(self.spark, self.root)
        return [] if log is None else log.join(dates, FILE_KEYS, "left_semi").select(*FILE_KEYS, "generation").collect()

    def clean(self, dates: list, superseded: list) -> None:
        """Removes what no reader takes any more from the date folders of this batch.

        Files of generations that never were committed may be on their way to
        their own commit, so they go only if they are older than a day.
        """
        old = {(r.feed, r.file_date, r.generation) for r in superseded}
        day_ago = f"g{dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1):%Y%m%dT%H%M%S%f}"
        for r in dates:
            for table in ("ticks", "provenance"):
                folder = Folder(self.spark, f"{self.root}/{table}/{date_folder(r.feed, r.file_date)}")
                for name in folder.names():
                    made = re.match(GENERATION, name)
                    if made is None or (r.feed, r.file_date, made[1]) in old or made[1] < day_ago:
                        folder.delete(name)


def date_folder(feed: str, day: dt.date) -> str:
    return f"feed={feed}/year={day.year}/file_date={day}"
