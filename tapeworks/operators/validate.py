"""Row-level contract checks with fail-the-file verdicts.

Every rule is a boolean Column evaluated on each line; one partial
aggregate per (feed, file_date) computes, for all rules at once, the number
of offending lines and the first offending (line, value).  The verdict of a
file is its first failing rule in contract precedence.  Verdicts are data:
one bad file never stops the others.

Input lines: ``(feed, file_date DATE, source_row INT, line STRING)`` where
``line`` has no line terminator and blank lines are present as ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import strict as S
from ..session import cut_lineage

FILE_KEYS = ["feed", "file_date"]
N_FIELDS = len(C.SOURCE_COLUMNS)
_IDX = {name: i for i, name in enumerate(C.SOURCE_COLUMNS)}


def field(name: str) -> Column:
    """Source field by its TXT column name (null when the line is short)."""
    return F.get(F.col("_parts"), _IDX[name])


def with_fields(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_parts", F.split(F.col("line"), C.FIELD_SEPARATOR, -1))


def with_dst_flag(x: DataFrame) -> DataFrame:
    """Adds ``_dst_day``: the file's calendar day may be a DST transition day.

    The transition-day table is bounded (a few hundred days over its years),
    so broadcasting it is safe whatever the data size.  Days outside its
    years are flagged too: their lines take the full check.
    """
    days = S.dst_transition_days(x.sparkSession).select(
        F.col("day").alias("file_date"), F.lit(True).alias("_dst_day"))
    outside = ~F.year("file_date").between(S.FIRST_DST_YEAR, S.LAST_DST_YEAR)
    return x.join(F.broadcast(days), "file_date", "left").withColumn(
        "_dst_day", F.coalesce(F.col("_dst_day"), outside))


def is_header() -> Column:
    return F.col("source_row") == 1


def is_data() -> Column:
    return (F.col("source_row") > 1) & (F.col("line") != F.lit(""))


def is_blank() -> Column:
    return (F.col("source_row") > 1) & (F.col("line") == F.lit(""))


def _uint_rules(rule: str, name: str, max_value: int):
    v = field(name)
    pattern_ok = S.uint_pattern_ok(v, max_value)
    return [
        (f"{rule}_pattern", ~pattern_ok, v),
        (f"{rule}_range", pattern_ok & ~S.uint_range_ok(v, max_value), v),
    ]


def rule_checks() -> list[tuple[str, Column, Column]]:
    """(rule, offending-line predicate among data lines, reported value)."""
    file_day = F.date_format(F.col("file_date"), "yyyy-MM-dd")
    ref, hora = field("DataReferencia"), field("HoraFechamento")
    return [
        ("field_count", F.size("_parts") != N_FIELDS, F.size("_parts").cast("string")),
        ("trade_date", ~S.iso_date_ok(field("DataNegocio")), field("DataNegocio")),
        ("reference_date", ~F.coalesce(ref == file_day, F.lit(False)), ref),
        ("price", ~S.price_ok(field("PrecoNegocio")), field("PrecoNegocio")),
        *_uint_rules("quantity", "QuantidadeNegociada", C.UINT32_MAX),
        *_uint_rules("update_action", "AcaoAtualizacao", C.UINT8_MAX),
        *_uint_rules("session_type", "TipoSessaoPregao", C.UINT8_MAX),
        *_uint_rules("channel_type", "TipoDoCanal", C.UINT8_MAX),
        *_uint_rules("trade_id", "CodigoIdentificadorNegocio", C.INT64_MAX),
        # the full wall-time check runs only on rows of DST transition days
        ("local_time_invalid", F.coalesce(F.col("_dst_day"), F.lit(False))
         & S.local_time_invalid(file_day, hora), hora),
    ]


def offences(x: DataFrame, keys: list[str], checks: list[tuple[str, Column]],
             base_aggs: list[Column], line_col: str = "source_row") -> DataFrame:
    """Per-file ``n_<rule>`` counts and ``l_<rule>`` first offending line.

    One hash aggregate with fixed-width buffers only (counts and minimum
    line numbers), partially aggregated map-side.  Each predicate is a column
    first, so that both of its aggregates share one evaluation.
    """
    aggs = list(base_aggs)
    for rule, _ in checks:
        aggs.append(F.count_if(F.col(f"_bad_{rule}")).alias(f"n_{rule}"))
        aggs.append(F.min(F.when(F.col(f"_bad_{rule}"), F.col(line_col))).alias(f"l_{rule}"))
    return x.withColumns({f"_bad_{rule}": bad for rule, bad in checks}).groupBy(*keys).agg(*aggs)


def decide(per_file: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``_v`` = (rule, column, n, line) of the first failing rule in order."""
    cands = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"),
                 F.coalesce(F.col(f"n_{rule}"), F.lit(0)).cast("bigint").alias("n"),
                 F.col(f"l_{rule}").cast("int").alias("line"))
        for rule, column in rules])
    return per_file.withColumn("_v", F.get(F.filter(cands, lambda r: r["n"] > 0), 0))


def offending_values(x: DataFrame, decided: DataFrame, keys: list[str],
                     values: dict, line_col: str = "source_row", cut=with_fields) -> DataFrame:
    """The text at the first offending line of each rejected file.

    ``cut`` adds what the values read; it runs behind the join, on those lines only.
    A join of the lines with one row per rejected file on (file, line), then
    the value expression of the deciding rule.  ``decided`` is a materialised
    table, so its size is known when the join is planned: a small one is
    broadcast and the lines stay where they are.  No aggregate ever carries
    strings.
    """
    firsts = decided.where(F.col("_v").isNotNull() & F.col("_v.line").isNotNull()).select(
        *keys, F.col("_v.line").alias(line_col), F.col("_v.rule").alias("_rule"))
    hit = cut(x.join(firsts, [*keys, line_col], "inner"))
    value = F.lit(None).cast("string")
    for rule, expr in values.items():
        value = F.when(F.col("_rule") == rule, expr).otherwise(value)
    return hit.select(*keys, value.alias("_value"))


def file_verdicts(lines: DataFrame, files: DataFrame | None = None,
                  line_counts: DataFrame | None = None) -> DataFrame:
    """One row per file: status OK/REJECTED and the deciding rule.

    ``files`` (``feed, file_date``) lists files that may have produced no
    line at all (an empty file has no header either, so it is rejected).
    ``line_counts`` (``feed, file_date, n_lines``) says how many physical
    lines a file has by a count that did not go through the line reader; a
    file of which more or fewer were read fails by ``line_count``, before all
    other rules, since its line numbers mean nothing (VAL-3).
    """
    x = with_dst_flag(with_fields(lines))
    data, header = is_data(), is_header()
    rule_list = rule_checks()
    checks = [("header", header & (F.col("line") != F.lit(C.EXPECTED_HEADER)))]
    checks += [(rule, data & bad) for rule, bad, _ in rule_list]
    values = {"header": F.col("line"), **{rule: value for rule, _, value in rule_list}}
    base = [
        F.count_if(header).alias("_header_rows"),
        F.count_if(data).alias("data_lines"),
        F.count_if(is_blank()).alias("blank_lines"),
    ]
    per_file = offences(x, FILE_KEYS, checks, base)
    if files is not None:
        per_file = files.select(*FILE_KEYS).distinct().join(per_file, FILE_KEYS, "left")
        per_file = per_file.fillna(0, subset=["_header_rows", "n_header", "data_lines",
                                              "blank_lines"])
    # An absent header line counts as a wrong (empty) header on line 1.
    missing = F.col("_header_rows") == 0
    per_file = (per_file
                .withColumn("n_header", F.col("n_header") + F.when(missing, 1).otherwise(0))
                .withColumn("l_header", F.when(missing, F.lit(1)).otherwise(F.col("l_header")))
                .withColumn("n_zero_rows", F.when(F.col("data_lines") == 0, 1).otherwise(0))
                .withColumn("l_zero_rows", F.lit(None).cast("int")))
    rules = list(C.RULES)
    if line_counts is not None:
        rules.insert(0, ("line_count", "line"))
        read = F.col("_header_rows") + F.col("data_lines") + F.col("blank_lines")
        per_file = per_file.join(line_counts.select(*FILE_KEYS, "n_lines"), FILE_KEYS, "left").withColumns({
            "n_line_count": F.abs(F.coalesce("n_lines", read) - read), "l_line_count": F.lit(None).cast("int")})
    decided = cut_lineage(decide(per_file, rules))
    vals = offending_values(lines, decided, FILE_KEYS, values)
    out = decided.join(vals, FILE_KEYS, "left")
    first_value = F.when(missing & (F.col("_v.rule") == "header"), F.lit("")).otherwise(F.col("_value"))
    out = out.withColumn("_v", F.struct(F.col("_v.rule").alias("rule"), F.col("_v.column").alias("column"),
                                        F.col("_v.n").alias("n"), F.col("_v.line").alias("line"),
                                        first_value.alias("value")))
    return out.select(
        *FILE_KEYS,
        F.when(F.col("_v.rule").isNull(), "OK").otherwise("REJECTED").alias("status"),
        F.col("_v.rule").alias("rule"),
        F.col("_v.column").alias("source_column"),
        F.col("_v.n").alias("invalid_count"),
        F.col("_v.line").alias("first_line"),
        F.col("_v.value").alias("first_value"),
        F.col("data_lines").cast("bigint").alias("data_lines"),
        F.col("blank_lines").cast("bigint").alias("blank_lines"),
        violation_message(F.col("_v")).alias("message"),
    )


def violation_message(v: Column) -> Column:
    return (F.when(v["rule"].isNull(), F.lit(None))
            .when(v["rule"] == "zero_rows", F.lit("zero rows"))
            .when(v["rule"] == "line_count", F.format_string("lines read and lines of the file differ by %d", v["n"]))
            .when(v["rule"] == "header", F.format_string("unexpected header: %s", v["value"]))
            .when(v["rule"] == "field_count", F.format_string(
                "%d line(s) do not have %d fields; first at line %d (%s fields)",
                v["n"], F.lit(N_FIELDS), v["line"], v["value"]))
            .otherwise(F.format_string("column %s: %d invalid value(s); first at line %d: %s",
                                       v["column"], v["n"], v["line"], v["value"])))


def accepted_lines(lines: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Data lines of files whose verdict is OK (VAL-12 routing)."""
    ok = verdicts.where(F.col("status") == "OK").select(*FILE_KEYS)
    return lines.where(is_data()).join(ok, FILE_KEYS, "left_semi")


def rejected_files(verdicts: DataFrame) -> DataFrame:
    """Quarantine view: files that are not published and why."""
    return verdicts.where(F.col("status") == "REJECTED")


def first_blank_lines(lines: DataFrame, k: int = C.MAX_REPORTED_BLANKS) -> DataFrame:
    """First ``k`` blank line numbers of every file (tolerated, reported).

    Blank lines are rare; the per-file top-k runs over blank lines only.
    """
    from pyspark.sql import Window
    blanks = lines.where(is_blank()).select(*FILE_KEYS, "source_row")
    w = Window.partitionBy(*FILE_KEYS).orderBy("source_row")
    return (blanks.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k))
