"""Tick archives as a data source of their own: ``spark.read.format("tick_archives")``.

One partition is one archive, opened in its store by the task that reads it.
Rows are those of :mod:`.archives` (lines and a summary row per archive), so a
batch read and a stream feed the same jobs.

As a stream its offset is the last archive taken, in order of modification
time and path; a restart goes on behind it and a replayed micro-batch has the
same partitions, as both ends of its range are in the checkpoint.  An archive
that turns up with a modification time before that point (copied with its old
time) is not seen by the stream; a batch read sees every one.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .. import contract as C
from .archives import ARCHIVE_SCHEMA, scan_path
from .inventory import arrow_file

NAME = "tick_archives"


@dataclass
class Archive(InputPartition):
    path: str
    feed: str
    file_date: object
    prefix: str


def parse_name(name: str):
    """(feed, date, TXT prefix) of an archive's file name, or None: as the column functions of ``keys`` do."""
    for feed, (pattern, slices) in C.FEED_NAME_PATTERNS.items():
        if re.search(pattern, name):
            y, m, d = (name[pos - 1:pos - 1 + length] for pos, length in slices)
            try:
                day = dt.date(int(y), int(m), int(d))
            except ValueError:
                continue
            return feed, day, day.strftime(PREFIXES[feed])
    return None


#: The TXT prefixes of the contract, spelt for ``strftime``.
PREFIXES = {f[0]: f[2].replace("'", "").replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d") for f in C.FEEDS}


def list_archives(location: str) -> list[tuple[int, str]]:
    """(modification time in ns, URI) of every ZIP below a folder, in that order; driver-side, as a listing is."""
    from pyarrow.fs import FileSelector
    fs, inner = arrow_file(location)
    scheme = location.split("://", 1)[0] + "://" if "://" in location else "file:"
    files = fs.get_file_info(FileSelector(inner, recursive=True, allow_not_found=True))
    return sorted((f.mtime_ns, scheme + f.path) for f in files if f.is_file and f.path.endswith(".zip"))


def partitions(paths: list[str]) -> list[Archive]:
    named = [(p, parse_name(p.rsplit("/", 1)[-1])) for p in paths]
    return [Archive(p, *n) for p, n in named if n]


def read(partition: Archive | None):
    if partition is not None:
        yield from scan_path(partition.path, partition.feed, partition.file_date, partition.prefix)


class _Reader(DataSourceReader):
    def __init__(self, location: str):
        self.location = location

    def partitions(self):
        return partitions([p for _, p in list_archives(self.location)]) or [None]

    def read(self, partition):
        yield from read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, location: str):
        self.location, self.last = location, None

    def initialOffset(self) -> dict:
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:
        start = self.last or (0, "")
        new = [f for f in list_archives(self.location) if f > start]
        self.last = new[-1] if new else start
        return {"time": self.last[0], "path": self.last[1]}

    def partitions(self, start: dict, end: dict):
        a, b = (start["time"], start["path"]), (end["time"], end["path"])
        self.last = max(self.last or b, b)
        return partitions([f[1] for f in list_archives(self.location) if a < f <= b]) or [None]

    def read(self, partition):
        yield from read(partition)

    def commit(self, end: dict) -> None:
        pass


class TickArchives(DataSource):
    """Option: ``path`` (folder, searched recursively).  A micro-batch takes all that is new."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ARCHIVE_SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def streamReader(self, schema):
        return _StreamReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TickArchives)
