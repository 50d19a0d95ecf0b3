"""Delimited text with physical line numbers (plain, splittable files).

``spark.read.text`` with ``lineSep='\\n'`` keeps blank lines (the CSV reader
drops them, losing line numbers).  The reader decodes UTF-8, but the raw
bytes survive a cast to BINARY, so latin-1 is decoded from those.  Line
numbers come from :func:`physical_line_numbers` - no per-file window, so a
file split into many blocks is numbered by many tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..operators.sequence import physical_line_numbers


def decode_line(value: Column, encoding: str) -> Column:
    text = F.decode(value.cast("binary"), encoding)
    # the separator is '\n'; a CRLF file leaves trailing '\r' characters
    return F.when(F.endswith(text, F.lit("\r")), F.regexp_replace(text, r"\r+\z", "")).otherwise(text)


#: Bytes of small splits that one task reads, one split after the other.
TASK_BYTES = 64 << 20


def _fewer_tasks(raw: DataFrame) -> DataFrame:
    """Many small splits shared out over fewer tasks; the splits themselves stay as they are.

    A task that reads a few hundred KB costs more to start, and leaves a
    smaller file behind, than it is worth.  Nothing changes when the splits
    are large or there are no more of them than cores.
    """
    spark = raw.sparkSession
    n_splits = raw.rdd.getNumPartitions()
    size, unit = re.fullmatch(r"([0-9]+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    split = int(size) << 10 * " kmgt".index(unit or " ")
    n_tasks = max(-(-n_splits * split // TASK_BYTES), 4 * spark.sparkContext.defaultParallelism)
    return raw.coalesce(n_tasks) if n_tasks < n_splits else raw


def scan_lines(spark: SparkSession, paths, encoding: str = C.TEXT_ENCODING,
               strip_bom: bool = False) -> DataFrame:
    """``(path, line_no, line)`` for every physical line of every file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "\n").text(paths)
    scan = _fewer_tasks(raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_tw_block"),
        decode_line(F.col("value"), encoding).alias("line"),
    ))
    numbered = physical_line_numbers(scan, "path", "line_no")
    if strip_bom:
        numbered = numbered.withColumn(
            "line", F.when(F.col("line_no") == 1, F.regexp_replace("line", "\\A\uFEFF", ""))
            .otherwise(F.col("line")))
    return numbered.select("path", "line_no", "line")


def physical_line_counts(spark: SparkSession, paths, sep: str = C.FIELD_SEPARATOR) -> DataFrame:
    """``(path, n_lines)`` by another reading than :func:`scan_lines`: newlines between field separators.

    The files are cut at ``sep`` instead of at line ends, so this shares
    neither the record reader's line logic nor the numbering; it is split
    over tasks all the same.  A last line that no newline ends counts too.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", sep).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"), "value")
    newlines = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit("\n"), F.lit("")))
    per = raw.groupBy("path", "_block").agg(
        F.sum(newlines).alias("n"), F.max_by(F.endswith(F.col("value"), F.lit("\n")), F.col("_pos")).alias("ended"))
    ended = F.max_by("ended", "_block")
    return per.groupBy("path").agg((F.sum("n") + F.when(ended, 0).otherwise(1)).cast("bigint").alias("n_lines"))


# --- Fixed values: TXT names inside the archives (feed suffix after the date) ---
TXT_NAME_PATTERN = r"([0-9]{2})-([0-9]{2})-([0-9]{4})_NEGOCIOSAVISTA_(RV|DRV)[^/]*\.txt$"


def _tick_name(path: Column) -> tuple[Column, Column]:
    """(feed, file_date) of a TXT path; null when the name is not a tick file's."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    day, month, year, suffix = (F.regexp_extract(name, TXT_NAME_PATTERN, i) for i in (1, 2, 3, 4))
    file_date = F.when(name.rlike(TXT_NAME_PATTERN),
                       F.concat_ws("-", year, month, day).try_cast("date"))
    return F.when(suffix == "RV", "RV").when(suffix == "DRV", "DERIV"), file_date


def tick_files(spark: SparkSession, paths) -> DataFrame:
    """One row per (feed, file_date) that has a TXT file, empty files included.

    A day with more than one TXT has the rule ``txt_ambiguous``: two files
    must not be read as one.  The names come from the scan's own
    listing (its tasks never see empty files); no file body is read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    feed, file_date = _tick_name(F.col("path"))
    names = [(p,) for p in spark.read.text(paths).inputFiles()]
    listed = spark.createDataFrame(names, "path string").select("path", feed.alias("feed"), file_date.alias("file_date"))
    grouped = (listed.where(F.col("feed").isNotNull() & F.col("file_date").isNotNull())
               .groupBy("feed", "file_date").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(
                   F.collect_set(F.regexp_extract("path", r"([^/]+)$", 1))), "|").alias("candidates")))
    none = F.lit(None).cast("string")
    return grouped.select(
        "feed", "file_date", none.alias("source_zip_name"), none.alias("source_zip_sha256"),
        F.when(F.col("n") == 1, F.col("candidates")).alias("source_txt_name"), "candidates",
        F.when(F.col("n") > 1, "txt_ambiguous").alias("rule"))


def tick_line_counts(spark: SparkSession, paths) -> DataFrame:
    """``(feed, file_date, n_lines)`` of the tick files, counted apart from their lines."""
    feed, file_date = _tick_name(F.col("path"))
    counts = physical_line_counts(spark, paths).select(feed.alias("feed"), file_date.alias("file_date"), "n_lines")
    return counts.where(F.col("feed").isNotNull() & F.col("file_date").isNotNull()).groupBy("feed", "file_date").agg(
        F.sum("n_lines").alias("n_lines"))


def tick_lines_from_text(spark: SparkSession, paths) -> DataFrame:
    """Tick lines ``(feed, file_date, source_row, line, path)`` from unzipped TXT files.

    Feed and file date come from the TXT name; names that do not match are
    dropped (they are not tick files).
    """
    lines = scan_lines(spark, paths, C.TEXT_ENCODING)
    feed, file_date = _tick_name(F.col("path"))
    # lines of non-tick files vanish in the explode of a null array: one
    # projection computes the name parse once (a Filter would get the parse
    # inlined again, without common-subexpression reuse)
    keep = F.when(feed.isNotNull() & file_date.isNotNull(), F.array(F.struct(
        feed.alias("feed"), file_date.alias("file_date"),
        F.col("line_no").alias("source_row"), F.col("line"), F.col("path"))))
    return lines.select(F.inline(keep))
