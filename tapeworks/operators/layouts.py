"""Declarative report layouts compiled to Column expressions.

A layout says how many preamble lines to skip, how many trailing lines
are a footer, the separator, which cells mean "no value", and the name and
kind of every positional column.  Parsing a layout is one projection plus
one per-file aggregate (for the footer position and the violations) - no
Python in the hot path.

Kinds: ``string``; ``date`` (``dd/MM/yyyy``, unparseable -> null, counted
in the verdict's ``unparsed_cells``); and the strict kinds that fail the whole
file when a present value does not convert: ``double`` (decimal comma),
``date_strict``, ``int``, ``bool``, ``percent``.  Cells may be quoted: a
separator inside quotes belongs to the cell and a doubled quote is one quote.
A quoted cell may span lines (see :mod:`.records`); a quote that nothing
closes fails the file (``quote_unclosed``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strict as S
from ..session import cut_lineage
from .records import QUOTED, join_records, opens
from .validate import decide, offences, offending_values

STRICT_KINDS = ("double", "date_strict", "int", "bool", "percent")
_SPARK_TYPE = {"string": "string", "double": "double", "date": "date", "date_strict": "date",
               "int": "bigint", "bool": "boolean", "percent": "double"}


@dataclass(frozen=True)
class ReportLayout:
    name: str
    skip_lines: int
    footer_lines: int
    columns: tuple  # ((name, kind), ...)
    sep: str = ";"
    na_values: tuple = S.DEFAULT_NA
    extra_fields: str = "reject"  # rows longer than the layout are violations

    @property
    def ddl(self) -> str:
        return ", ".join(f"{n} {_SPARK_TYPE[k]}" for n, k in self.columns)


@dataclass
class LayoutRegistry:
    layouts: dict = field(default_factory=dict)

    def register(self, layout: ReportLayout) -> ReportLayout:
        if layout.name in self.layouts:
            raise ValueError(f"layout already registered for report {layout.name!r}")
        self.layouts[layout.name] = layout
        return layout

    def get(self, name: str) -> ReportLayout:
        try:
            return self.layouts[name]
        except KeyError:
            raise NotImplementedError(
                f"no layout for report {name!r}; known: {sorted(self.layouts)}") from None

    def names(self) -> list[str]:
        return sorted(self.layouts)


def _convert(cell: Column, kind: str) -> tuple[Column, Column | None]:
    """(typed value, violation predicate or None)."""
    if kind == "string":
        return cell, None
    if kind == "double":
        return S.comma_double(cell), ~S.comma_double_ok(cell)
    if kind == "date":
        return S.dmy_date(cell), None
    if kind == "date_strict":
        return S.dmy_date(cell), ~S.dmy_date_ok(cell)
    if kind == "int":
        return S.report_int(cell), ~S.report_int_ok(cell)
    if kind == "bool":
        return S.report_bool(cell), ~S.report_bool_ok(cell)
    if kind == "percent":
        v = S.percent_fraction(cell)
        return v, cell.isNotNull() & v.isNull()
    raise ValueError(f"unknown column kind {kind!r}")


def split_cells(line: Column, sep: str) -> Column:
    """Cells of a report line; only lines that hold a quote take the quote-aware split."""
    plain = F.split(line, re.escape(sep), -1)
    # every match starts with a separator, so no match is empty and none is lost
    s = re.escape(sep)
    cell = rf'{s}(?:{QUOTED}"[^{s}]*|[^{s}]*)'
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(cell), F.lit(0))
    closed = rf'\A"({QUOTED[1:]})"'

    def value(c: Column) -> Column:  # doubled quotes are one inside the quotes only; what follows them is text
        inner = F.regexp_extract(c, closed, 1)
        rest = F.substring(c, F.length(inner) + 3, F.lit(1 << 30))
        return F.when(c.rlike(closed), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(c)

    quoted = F.transform(found, lambda c: value(F.substring(c, 2, 1 << 30)))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def plain_line(line: Column, layout: ReportLayout) -> Column:
    """True for a line that one look at its shape clears: as many cells as the layout, quotes closed, all values sound.

    False says nothing: such a line is cut into cells and checked cell by
    cell.  Every shape here is one that the checks of its kind accept.
    """
    s = re.escape(layout.sep)
    words = "|".join(map(re.escape, sorted(layout.na_values, key=len, reverse=True)))
    number = r"-?[0-9]{1,18}(?:,[0-9]{1,18})?"
    day = (r"(?:(?:0[1-9]|1[0-9]|2[0-8])/(?:0[1-9]|1[0-2])|(?:29|30)/(?:0[13-9]|1[0-2])|31/(?:0[13578]|1[02]))"
           r"/[1-9][0-9]{3}")
    shape = {"double": number, "percent": f"{number}%?", "int": "-?[0-9]{1,18}", "date": day, "date_strict": day,
             "bool": "|".join((*S.TRUE_WORDS, *S.FALSE_WORDS))}
    text = rf'(?:{QUOTED}"[^{s}]*+|[^"{s}][^{s}]*+)?+'
    cells = [text if kind == "string" else f"(?:{shape[kind]}|{words})" if layout.na_values else f"(?:{shape[kind]})"
             for _, kind in layout.columns]
    return line.rlike(rf"\A{s.join(cells)}\z")


def data_lines(lines: DataFrame, layout: ReportLayout, keys: list[str]) -> DataFrame:
    """Lines after the preamble and before the footer, blank lines dropped.

    The footer is positional: the last ``footer_lines`` non-blank lines of
    each file, whatever they say.  Their position comes from a per-file
    aggregate, materialised so that the join with the lines is planned with
    its size: one row per file, and the lines are not shuffled for it.
    """
    body = lines.where((F.col("line_no") > layout.skip_lines) & (F.col("line") != F.lit("")))
    if layout.footer_lines <= 0:
        return body
    last = cut_lineage(body.groupBy(*keys).agg(F.max("line_no").alias("_last"),
                                               F.count(F.lit(1)).alias("_n")))
    # the k-th last non-blank line: with k = 1 it is simply the maximum
    if layout.footer_lines == 1:
        cut = body.join(last, keys, "inner").where(F.col("line_no") < F.col("_last"))
        return cut.drop("_last", "_n")
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col("line_no").desc())
    tail = (body.select(*keys, "line_no").withColumn("_r", F.row_number().over(w))
                .where(F.col("_r") <= layout.footer_lines).select(*keys, "line_no"))
    return body.join(tail, [*keys, "line_no"], "left_anti")


def parse_report(lines: DataFrame, layout: ReportLayout, keys: list[str]):
    """Typed rows and per-file verdicts for one layout.

    ``lines``: ``(*keys, line_no, line)``.  Returns ``(rows, verdicts)``:
    rows of files whose verdict is OK, with ``keys + line_no + columns``;
    verdicts with ``status, rule, source_column, invalid_count, first_line,
    first_value, data_rows, unparsed_cells`` per file.

    The pass that counts violations also says which files hold a cell that
    goes on in the next line.  Only those are cut into records and parsed
    anew; a batch without them costs nothing more.
    """
    body = data_lines(lines.withColumn("_unclosed", F.lit(False)), layout, keys)
    marked = _marked(body, layout, keys)
    decided = _decide_files(marked, layout, keys)
    spans = decided.where("_spans").select(*keys)
    if spans.isEmpty():
        return _typed_rows(body, marked, decided, layout, keys)
    records = data_lines(join_records(lines.join(spans, keys, "left_semi"), keys, layout.sep, layout.skip_lines), layout, keys)
    rows, verdicts = _typed_rows(body, marked, decided.join(spans, keys, "left_anti"), layout, keys)
    marked = _marked(records, layout, keys)
    more, again = _typed_rows(records, marked, _decide_files(marked, layout, keys), layout, keys)
    return rows.unionByName(more), verdicts.unionByName(again)


def _compiled(layout: ReportLayout):
    """Typed columns, the count of unparsed cells and the checks ``(rule, column, predicate, value)`` over ``_parts``."""
    cells = {}
    for i, (name, _) in enumerate(layout.columns):
        cells[name] = S.na_to_null(F.get(F.col("_parts"), i), layout.na_values)
    typed, unparsed = [], F.lit(0)
    checks = [("quote_unclosed", "line", F.col("_unclosed"), F.col("line"))]
    n = len(layout.columns)
    if layout.extra_fields == "reject":
        checks.append(("too_many_fields", "line", F.size("_parts") > n,
                       F.size("_parts").cast("string")))
    for name, kind in layout.columns:
        value, bad = _convert(cells[name], kind)
        typed.append(value.cast(_SPARK_TYPE[kind]).alias(name))
        if kind == "date":
            unparsed = unparsed + F.when(cells[name].isNotNull() & value.isNull(), 1).otherwise(0)
        if bad is not None:
            checks.append((f"{name}_invalid", name, bad, cells[name]))
    return typed, unparsed, checks


def _with_cells(body: DataFrame, layout: ReportLayout) -> DataFrame:
    return body.withColumn("_parts", split_cells(F.col("line"), layout.sep))


def _marked(body: DataFrame, layout: ReportLayout, keys: list[str]) -> DataFrame:
    """Every data line, with its text (else null) only if it is not plain.

    Materialised: the lines are read once, and both the counts and the text
    of first offences come from here.
    """
    line = F.col("line")
    return cut_lineage(body.select(*keys, "line_no", "_unclosed",
                                   F.when(F.col("_unclosed") | ~plain_line(line, layout), line).alias("line")))


def _decide_files(marked: DataFrame, layout: ReportLayout, keys: list[str]) -> DataFrame:
    """Counts, first offending lines and the deciding rule of each file; ``_spans`` if a cell goes on in the next line.

    A line without text is plain: it has no cells here (null), so every check
    of its cells passes.
    """
    line = F.col("line")
    _, unparsed, checks = _compiled(layout)
    x = marked.withColumn("_parts", F.when(line.isNotNull(), split_cells(line, layout.sep)))
    per_file = offences(x, keys, [(rule, bad) for rule, _, bad, _ in checks],
                        [F.count(F.lit(1)).alias("data_rows"), F.sum(unparsed).alias("unparsed_cells"),
                         F.max(F.col("_parts").isNotNull() & opens(line, layout.sep)).alias("_spans")],
                        line_col="line_no")
    return cut_lineage(decide(per_file, [(rule, col) for rule, col, _, _ in checks]))


def _typed_rows(body: DataFrame, marked: DataFrame, decided: DataFrame, layout: ReportLayout, keys: list[str]):
    """Rows and verdicts of the decided files, whose lines are records."""
    typed, _, checks = _compiled(layout)
    # the offending text is fetched by joining the lines on (file, first line); an offence is never plain
    vals = offending_values(marked.where(F.col("line").isNotNull()), decided, keys, {rule: value for rule, _, _, value in checks},
                            line_col="line_no", cut=lambda hit: _with_cells(hit, layout))
    verdicts = cut_lineage(decided.join(vals, keys, "left").select(
        *keys,
        F.when(F.col("_v.rule").isNull(), "OK").otherwise("REJECTED").alias("status"),
        F.col("_v.rule").alias("rule"), F.col("_v.column").alias("source_column"),
        F.col("_v.n").alias("invalid_count"), F.col("_v.line").alias("first_line"),
        F.col("_value").alias("first_value"),
        F.col("data_rows").cast("bigint").alias("data_rows"),
        F.col("unparsed_cells").cast("bigint").alias("unparsed_cells")))
    ok = verdicts.where(F.col("status") == "OK").select(*keys)
    rows = _with_cells(body.join(ok, keys, "left_semi"), layout).select(*keys, "line_no", *typed)
    return rows, verdicts


# --- Fixed values: the three typed report layouts (names and column order) ---

BTB_LOAN_BALANCE = ReportLayout(
    name="BTBLoanBalance", skip_lines=5, footer_lines=0,
    columns=(
        ("trade_date", "date_strict"),
        ("if_code", "string"),
        ("isin_code", "string"),
        ("company_name", "string"),
        ("market", "string"),
        ("contracts_count", "int"),
        ("assets_quantity", "int"),
        ("value_brl", "double"),
        ("donor_rate_min", "percent"),
        ("donor_rate_avg", "percent"),
        ("donor_rate_max", "percent"),
        ("borrower_rate_min", "percent"),
        ("borrower_rate_avg", "percent"),
        ("borrower_rate_max", "percent"),
    ),
    na_values=("",),
)

INSTRUMENTS_EQUITIES = ReportLayout(
    name="InstrumentsEquities", skip_lines=4, footer_lines=1,
    columns=(
        ("ticker_symbol", "string"),
        ("asset_code", "string"),
        ("asset_description", "string"),
        ("segment", "string"),
        ("market", "string"),
        ("category", "string"),
        ("expiration_date", "date"),
        ("trading_start_date", "date"),
        ("trading_end_date", "date"),
        ("isin_code", "string"),
        ("cfi_code", "string"),
        ("option_type", "string"),
        ("allocation_lot_size", "int"),
        ("trading_currency", "string"),
        ("delivery_type", "string"),
        ("exercise_price", "double"),
        ("option_style", "string"),
        ("premium_upfront_indicator", "bool"),
        ("distribution_id", "int"),
        ("price_factor", "int"),
        ("days_to_settlement", "int"),
        ("series_type", "string"),
        ("protection_flag", "bool"),
        ("automatic_exercise_indicator", "bool"),
        ("specification_code", "string"),
        ("corporation_name", "string"),
        ("corporate_action_start_date", "date"),
        ("custody_treatment_type", "string"),
        ("market_capitalisation", "int"),
        ("corporate_governance_level", "string"),
    ),
)

INSTRUMENTS_DERIVATIVES = ReportLayout(
    name="InstrumentsDerivatives", skip_lines=4, footer_lines=1,
    columns=(
        ("ticker_symbol", "string"),
        ("asset_code", "string"),
        ("asset_description", "string"),
        ("segment", "string"),
        ("market", "string"),
        ("category", "string"),
        ("expiration_date", "date"),
        ("expiration_code", "string"),
        ("trading_start_date", "date"),
        ("trading_end_date", "date"),
        ("base_code", "string"),
        ("conversion_criteria", "string"),
        ("maturity_date_target", "date"),
        ("required_conversion_indicator", "bool"),
        ("isin_code", "string"),
        ("cfi_code", "string"),
        ("delivery_notice_start_date", "date"),
        ("delivery_notice_end_date", "date"),
        ("option_type", "string"),
        ("contract_multiplier", "double"),
        ("asset_quotation_quantity", "int"),
        ("allocation_lot_size", "int"),
        ("trading_currency", "string"),
        ("delivery_type", "string"),
        ("withdrawal_days", "int"),
        ("working_days", "int"),
        ("calendar_days", "int"),
        ("rollover_base_price", "string"),
        ("opening_future_position_day", "int"),
        ("side_type_code_1", "string"),
        ("underlying_ticker_symbol_1", "string"),
        ("side_type_code_2", "string"),
        ("underlying_ticker_symbol_2", "string"),
        ("exercise_price", "double"),
        ("option_style", "string"),
        ("value_type", "string"),
        ("premium_upfront_indicator", "bool"),
        ("opening_position_limit_date", "date"),
    ),
)

PERPETUAL_DATE = "9999-12-31"

LAYOUTS = LayoutRegistry()
for _layout in (BTB_LOAN_BALANCE, INSTRUMENTS_EQUITIES, INSTRUMENTS_DERIVATIVES):
    LAYOUTS.register(_layout)


def is_perpetual(c: Column | str) -> Column:
    """Instrument without a fixed end (the ``31/12/9999`` sentinel, a real date)."""
    c = F.col(c) if isinstance(c, str) else c
    return c == F.lit(PERPETUAL_DATE).cast("date")
