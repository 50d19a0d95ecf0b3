"""Records whose quoted cells span physical lines, across file splits.

A line either starts outside of any cell or inside a quoted one, and what it
does to that state is one of four maps: it keeps it, swaps it, or ends outside
or inside whatever it was.  Maps compose, so the state before any line is a
prefix scan: first inside blocks of lines, then over the blocks (a small
table), then back.  No task has to read a file from its start, and only lines
that hold a quote and change something take part.

A cell is quoted only if it starts with a quote; a doubled quote inside is
one quote; a quote further on in an unquoted cell, or behind a closed one, is
text.  A record takes the number of its first line, and its lines are joined
by a newline whatever line ends the file has.  A quote that nothing closes
marks its line (``_unclosed``) and joins nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sequence import sequence_within

BLOCK_LINES = 1 << 16
#: A quoted cell up to its closing quote: possessive, so its length costs no stack.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+'


def opens(line: Column, sep: str) -> Column:
    """True if a line that starts outside of a cell ends inside a quoted one."""
    s = re.escape(sep)
    cell = rf'(?:{QUOTED}"[^{s}]*+|[^"{s}][^{s}]*+)?+'
    return F.contains(line, F.lit('"')) & line.rlike(rf"\A(?:{cell}{s})*+{QUOTED}\z")


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _scan(rows: DataFrame, group: list[str], order: str, fixed: Column, value: Column, prefix: str) -> DataFrame:
    """Composition of the maps before each row, as ``{prefix}f`` (the state is known) and ``{prefix}v``.

    A row's map: ``fixed`` - the state becomes ``value``; else ``value`` says
    whether it swaps.  Of a composition that is not fixed, ``v`` says the same.
    """
    w = Window.partitionBy(*group).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    swap = (~fixed & value).cast("long")
    rows = rows.withColumn("_s", F.sum(swap).over(upto))
    last = F.last(F.when(fixed, F.struct(value.alias("v"), F.col("_s").alias("s"))), ignorenulls=True).over(before)
    rows = rows.withColumn("_k", last)
    swaps = F.col("_s") - swap
    known = F.col("_k").isNotNull()
    return rows.withColumns({
        f"{prefix}f": known,
        f"{prefix}v": F.when(known, F.col("_k.v") != _odd(swaps - F.col("_k.s"))).otherwise(_odd(swaps)),
    }).drop("_s", "_k")


def spanning(lines: DataFrame, keys: list[str], sep: str, skip_lines: int = 0) -> DataFrame:
    """``(*keys, first, last)`` of every record of several lines; ``last`` is null if it never closes."""
    line = F.col("line")
    moves = lines.where((F.col("line_no") > skip_lines) & F.contains(line, F.lit('"'))).select(
        *keys, "line_no", F.expr(f"line_no div {BLOCK_LINES}").alias("_b"), opens(line, sep).alias("_o"),
        opens(F.concat(F.lit('"'), line), sep).alias("_i"))  # inside: as if the open quote stood before it
    moves = cut_lineage(moves.where(F.col("_o") | ~F.col("_i")))  # all others keep the state
    fixed = F.col("_o") == F.col("_i")
    local = _scan(moves, [*keys, "_b"], "line_no", fixed, F.col("_o"), "_l")
    after = F.when(fixed, F.struct(F.lit(True).alias("f"), F.col("_o").alias("v"))).otherwise(
        F.struct(F.col("_lf").alias("f"), (~F.col("_lv")).alias("v")))
    blocks = local.groupBy(*keys, "_b").agg(F.max_by(after, "line_no").alias("_m"))
    blocks = _scan(blocks, keys, "_b", F.col("_m.f"), F.col("_m.v"), "_g").select(*keys, "_b", F.col("_gv").alias("_in"))
    # before the first known state a file is outside, so a composition that only swaps is the state itself
    state = local.join(blocks, [*keys, "_b"]).withColumn(
        "_was", F.when(F.col("_lf"), F.col("_lv")).otherwise(F.col("_in") != F.col("_lv")))
    state = state.withColumn("_is", F.when(fixed, F.col("_o")).otherwise(~F.col("_was")))
    turns = state.where(F.col("_was") != F.col("_is")).select(*keys, "line_no")
    # turns alternate: a record opens, then closes
    paired = sequence_within(turns, keys, ["line_no"], out="_n").groupBy(*keys, F.expr("(_n + 1) div 2").alias("_p"))
    ends = paired.agg(F.min("line_no").alias("first"), F.when(F.count("line_no") == 2, F.max("line_no")).alias("last"))
    return ends.drop("_p")


def join_records(lines: DataFrame, keys: list[str], sep: str, skip_lines: int = 0) -> DataFrame:
    """``(*keys, line_no, line, _unclosed)``: a row per record; lines up to ``skip_lines`` stay as they are.

    All lines are marked and materialised once; only those of spanning records
    are shuffled to meet.  The marking moves no line when the list of
    spanning records is small.
    """
    found = cut_lineage(spanning(lines, keys, sep, skip_lines))
    closed = F.col("last").isNotNull()
    marks = cut_lineage(found.select(
        *keys, F.when(closed, F.col("first")).alias("_first"), (~closed).alias("_unclosed"),
        F.explode(F.sequence("first", F.coalesce("last", "first"))).alias("line_no")))
    marked = cut_lineage(lines.select(*keys, "line_no", "line").join(marks, [*keys, "line_no"], "left"))
    flag = F.coalesce(F.col("_unclosed"), F.lit(False)).alias("_unclosed")
    alone = marked.where("_first IS NULL").select(*keys, "line_no", "line", flag)
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    joined = cut_lineage(marked.where("_first IS NOT NULL").groupBy(*keys, F.col("_first").alias("line_no"))
                         .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"))
                         .select(*keys, "line_no", "line", F.lit(False).alias("_unclosed")))
    return alone.unionByName(joined)
