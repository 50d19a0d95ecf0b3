"""ZIP archives of tick text: one archive per feed and calendar day.

``binaryFile`` lists the archives (not splittable; ~50 MB a day); a
``mapInArrow`` generator opens each in its store, reads the central directory
and the TXT member by ranges and streams its lines in bounded Arrow batches,
so thousands of dates are read in parallel, an archive's size costs no memory,
and none ever passes through the driver.  The SHA-256 of the archive bytes is
computed by blocks before.

Output of :func:`scan_archives` (one DataFrame, two kinds of rows):

* ``source_row = 0``: one summary row per archive - candidate TXT members,
  the archive hash, and the member's physical lines as counted on its bytes
  before they are cut into lines;
* ``source_row >= 1``: physical lines of the selected member (blank lines
  included, trailing ``\\r`` removed, latin-1 decoded).
"""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import archive_name_date, basename, txt_prefix
from .inventory import arrow_file, arrow_reads

ARCHIVE_SCHEMA = ("path string, feed string, file_date date, member string, n_candidates int, "
                  "candidates string, sha256 string, source_row int, line string, n_lines bigint")
_BATCH_LINES = 65536
_BLOCK = 1 << 20
_OUT = pa.schema([
    ("path", pa.string()), ("feed", pa.string()), ("file_date", pa.date32()),
    ("member", pa.string()), ("n_candidates", pa.int32()),
    ("candidates", pa.string()), ("sha256", pa.string()), ("source_row", pa.int32()),
    ("line", pa.string()), ("n_lines", pa.int64()),
])


class CountedLines(io.RawIOBase):
    """Passes a stream's bytes on and counts the lines in them, whoever reads them and how."""

    def __init__(self, stream):
        self.stream, self.newlines, self.last = stream, 0, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[:len(data)] = data
        if data:
            self.newlines += data.count(b"\n")
            self.last = data[-1:]
        return len(data)

    @property
    def lines(self) -> int:
        """Lines so far; one that no newline ends counts too."""
        return self.newlines + (self.last not in (b"", b"\n"))


def _lines_batches(path: str, feed: str, file_date, member: str, stream):
    """Lines of an open member in batches; only one batch is held at a time."""
    start = 0
    while part := list(islice(stream, _BATCH_LINES)):
        lines = [c.rstrip(b"\r\n").decode("latin-1") for c in part]
        k = len(lines)
        yield pa.RecordBatch.from_arrays([
            pa.array([path] * k, pa.string()), pa.array([feed] * k, pa.string()),
            pa.array([file_date] * k, pa.date32()), pa.array([member] * k, pa.string()),
            pa.nulls(k, pa.int32()), pa.nulls(k, pa.string()), pa.nulls(k, pa.string()),
            pa.array(range(start + 1, start + k + 1), pa.int32()), pa.array(lines, pa.string()),
            pa.nulls(k, pa.int64()),
        ], schema=_OUT)
        start += k


# What opening or unpacking a damaged, encrypted or oddly packed archive raises.
_DAMAGED = (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, EOFError, RuntimeError,
            NotImplementedError, ValueError, OSError)


def scan_file(path: str, feed: str, file_date, prefix: str | None, archive_file, digest: str):
    """Line batches of one open archive, then its summary row.

    ``archive_file`` is any seekable file: the central directory and the
    chosen member are read by ranges, nothing else of it.
    """
    readable, candidates, counted = True, [], None
    try:
        archive = zipfile.ZipFile(archive_file)
        candidates = [n for n in archive.namelist()
                      if prefix is not None and n.startswith(prefix) and n.endswith(".txt")]
        if len(candidates) == 1:
            with archive.open(candidates[0]) as stream:
                counted = CountedLines(stream)
                yield from _lines_batches(path, feed, file_date, candidates[0], io.BufferedReader(counted, _BLOCK))
    except _DAMAGED:
        readable = False  # lines before the damage carry this archive's rejection
    yield pa.RecordBatch.from_arrays([
        pa.array([path]), pa.array([feed], pa.string()), pa.array([file_date], pa.date32()),
        pa.array([candidates[0] if len(candidates) == 1 else None], pa.string()),
        pa.array([len(candidates) if readable else -1], pa.int32()),
        pa.array(["|".join(candidates)]), pa.array([digest]),
        pa.array([0], pa.int32()), pa.nulls(1, pa.string()),
        pa.array([counted.lines if counted is not None and readable else None], pa.int64()),
    ], schema=_OUT)


def scan_path(path: str, feed: str, file_date, prefix: str | None):
    """:func:`scan_file` of an archive in a store: read by blocks and ranges, never held whole.

    Memory is a block and a batch of lines, whatever the archive's size (and
    there is no limit of 2 GB, as there is for a file's content in a row).
    An archive that can't be opened at all is a damaged one.
    """
    digest = hashlib.sha256()
    try:
        fs, inner = arrow_file(path)
        with fs.open_input_stream(inner) as stream:
            while block := stream.read(_BLOCK):
                digest.update(block)
        with fs.open_input_file(inner) as f:
            yield from scan_file(path, feed, file_date, prefix, f, digest.hexdigest())
    except FileNotFoundError:
        yield from scan_file(path, feed, file_date, prefix, io.BytesIO(), digest.hexdigest())


def _read_paths(batches):
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield from scan_path(*row)


def _read_contents(batches):
    for batch in batches:
        for path, feed, file_date, prefix, content in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield from scan_file(path, feed, file_date, prefix, io.BytesIO(content), hashlib.sha256(content).hexdigest())


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def named_archives(files: DataFrame) -> DataFrame:
    """Adds ``feed, file_date, txt_prefix`` parsed from the archive names; names that match no feed are skipped."""
    named = files.withColumn("_name", basename(F.col("path")))
    named = named.select(*files.columns, *archive_name_date(F.col("_name"))).where(F.col("feed").isNotNull())
    return named.withColumn("txt_prefix", txt_prefix(F.col("feed"), F.col("file_date")))


def scan_archive_frame(raw: DataFrame) -> DataFrame:
    """Archive summary and line rows from a ``binaryFile`` DataFrame
    (batch or one streaming micro-batch).

    Archives of stores that Arrow reads as well are opened by their path in
    the tasks, by ranges; Spark then never loads their content.  Others come
    as content, which limits them to 2 GB each.
    """
    first = raw.select("path").first()
    by_path = first is None or arrow_reads(first[0])
    columns = ["path", "feed", "file_date", "txt_prefix"]
    named = named_archives(raw.select("path") if by_path else raw.select("path", "content"))
    if by_path:
        # listings are dealt out in few partitions; one archive is one task's work
        n = max(1, raw.sparkSession.sparkContext.defaultParallelism)
        return named.select(*columns).repartition(n, "path").mapInArrow(_read_paths, ARCHIVE_SCHEMA)
    return named.select(*columns, "content").mapInArrow(_read_contents, ARCHIVE_SCHEMA)


def scan_archives(spark: SparkSession, location: str, glob: str = "*.zip") -> DataFrame:
    """Archive summary and line rows for every ZIP under ``location``."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
           .option("recursiveFileLookup", "true").load(location))
    return scan_archive_frame(raw)


def archive_problems(scan: DataFrame) -> DataFrame:
    """One row per feed and date with its archive-level rule, null when there is none.

    ``archive_ambiguous``: more than one archive claims the date (their lines
    must not be read as one file); ``archive_unreadable``: not a ZIP, or
    damaged; ``txt_missing`` and ``txt_ambiguous``: no TXT member, or several.
    """
    s = scan.where(F.col("source_row") == 0).groupBy("feed", "file_date").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("path")), "|").alias("paths"),
        *[F.min(c).alias(c) for c in ("path", "sha256", "member", "n_candidates", "candidates", "n_lines")])
    many = F.col("n") > 1
    rule = (F.when(many, "archive_ambiguous")
             .when(F.col("n_candidates") < 0, "archive_unreadable")
             .when(F.col("n_candidates") == 0, "txt_missing")
             .when(F.col("n_candidates") > 1, "txt_ambiguous"))
    return s.select("feed", "file_date", basename(F.col("path")).alias("source_zip_name"),
                    F.col("sha256").alias("source_zip_sha256"),
                    F.col("member").alias("source_txt_name"),
                    F.when(many, F.col("paths")).otherwise(F.col("candidates")).alias("candidates"),
                    F.when(rule.isNull(), F.col("n_lines")).alias("n_lines"), rule.alias("rule"))


def archive_lines(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("source_row") >= 1).select("feed", "file_date", "source_row", "line")
