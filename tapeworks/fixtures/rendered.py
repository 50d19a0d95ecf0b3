"""Exchange-format text rendered from the driver's tables.

The driver offers only its own tables, so tick text and report text are
*rendered* from them deterministically, then parsed back by the real
operators; an independent SQL engine computes the expected values straight
from the original columns.  Rendering is a source like any other: it yields
the same ``(feed, file_date, source_row, line)`` lines DataFrame a text or
archive scan yields, with physical line numbers.

Fault injection is keyed on ids and calendar days so every validation rule
fires on some files and the precedence between rules is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..operators.sequence import POS, sequence_within

# --- Fixed rendering rules (mirrored by the oracle SQL) ---
DERIV_EVENT_TYPES = ("purchase", "error")
BLANK_BEFORE_MOD, BLANK_BEFORE_REM = 101, 50
BAD_TIME_MOD = 97
ANON_BUYER_MOD = 89
# (feed, day of month) -> which fault the file carries.
FAULT_DAYS = {
    ("RV", 5): "header",
    ("RV", 9): "field_count+price",
    ("DERIV", 11): "price",
    ("RV", 13): "quantity_range",
    ("DERIV", 15): "reference_date",
    ("RV", 17): "trade_date+quantity_pattern",
    ("DERIV", 19): "update_action_range",
    ("RV", 21): "session_type_pattern",
    ("DERIV", 23): "channel_type_pattern",
    ("RV", 25): "trade_id_pattern",
    ("DERIV", 27): "update_action_pattern",
}


def _fault(feed: str, day: int):
    return (F.col("feed") == F.lit(feed)) & (F.col("_day") == F.lit(day))


def _next_business_day(d):
    wd = F.weekday(d)  # 0 = Monday
    return F.date_add(d, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))


def _previous_business_day(d):
    wd = F.weekday(d)
    return F.date_sub(d, F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1))


def _comma2(c):
    """Two-decimal text with a decimal comma (a decimal cast, not a formatter)."""
    return F.replace(c.cast("decimal(20,2)").cast("string"), F.lit("."), F.lit(","))


def _feed_of(event_type):
    return F.when(event_type.isin(*DERIV_EVENT_TYPES), "DERIV").otherwise("RV")


def tick_fields(events: DataFrame, keep: tuple = ()) -> DataFrame:
    """The 12 source fields as text (before faults), one row per event.

    ``keep`` columns pass through; ``feed``/``file_date`` are taken from the
    input when present (header rows carry no event).
    """
    cols = set(events.columns)
    e = events
    if "feed" not in cols:
        e = e.withColumn("feed", _feed_of(F.col("event_type")))
    if "file_date" not in cols:
        e = e.withColumn("file_date", F.to_date("ts"))
    e = e.withColumn("_day", F.dayofmonth("file_date")).withColumn("_hour", F.hour("ts"))
    ref = F.date_format("file_date", "yyyy-MM-dd")
    session = (F.when((F.col("feed") == "DERIV") & (F.col("_hour") >= 16)
                      & (F.col("event_type") == "purchase"), _next_business_day(F.col("file_date")))
                .when((F.col("feed") == "DERIV") & (F.col("_hour") < 3),
                      _previous_business_day(F.col("file_date")))
                .otherwise(F.col("file_date")))
    t = F.date_format("ts", "HHmmssSSS")
    k = (F.col("event_id") / BAD_TIME_MOD).cast("bigint") % 6
    bad_time = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("25000000"))
                  .when(k == 2, F.lit("250000000")).when(k == 3, F.lit("106000000"))
                  .when(k == 4, F.lit("09O000000")).otherwise(F.concat(t, F.lit("0"))))
    time_raw = F.when(F.col("event_id") % BAD_TIME_MOD == 0, bad_time).otherwise(t)
    return e.select(
        *keep, "event_id", "ts", "feed", "file_date", "_day",
        ref.alias("f_ref"),
        F.concat(F.upper("event_type"), (F.col("user_id") % 5).cast("string")).alias("f_symbol"),
        F.when(F.col("event_id") % 13 == 0, "2").otherwise("0").alias("f_action"),
        _comma2(F.col("value")).alias("f_price"),
        ((F.col("event_id") * 7) % 1000 + 1).cast("string").alias("f_qty"),
        time_raw.alias("f_time"),
        F.col("event_id").cast("string").alias("f_trade_id"),
        F.when(F.col("_hour") >= 17, "6").otherwise("1").alias("f_session"),
        F.date_format(session, "yyyy-MM-dd").alias("f_trade_date"),
        F.when(F.col("event_id") % ANON_BUYER_MOD == 0, "")
         .otherwise(F.col("user_id").cast("string")).alias("f_buyer"),
        (F.col("user_id") % 13).cast("string").alias("f_seller"),
        F.when(F.col("feed") == "DERIV", "1").otherwise("2").alias("f_channel"),
    )


def _apply_faults(f: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    f = f.withColumn("f_price", F.when(_fault("RV", 9) & (eid % 7 == 0), "1,2,3")
                     .when(_fault("DERIV", 11) & (eid % 5 == 0), "1,2,3")
                     .otherwise(F.col("f_price")))
    f = f.withColumn("f_qty", F.when(_fault("RV", 13) & (eid % 3 == 1), "4294967296")
                     .when(_fault("RV", 17) & (eid % 11 == 0), "abc")
                     .otherwise(F.col("f_qty")))
    f = f.withColumn("f_ref", F.when(_fault("DERIV", 15) & (eid % 40 == 3),
                                     F.date_format(F.date_sub("file_date", 1), "yyyy-MM-dd"))
                     .otherwise(F.col("f_ref")))
    f = f.withColumn("f_trade_date", F.when(_fault("RV", 17) & (eid % 9 == 2), "2024-02-30")
                     .otherwise(F.col("f_trade_date")))
    f = f.withColumn("f_action", F.when(_fault("DERIV", 19) & (eid % 6 == 1), "256")
                     .when(_fault("DERIV", 27) & (eid % 4 == 2), "0001")
                     .otherwise(F.col("f_action")))
    f = f.withColumn("f_session", F.when(_fault("RV", 21) & (eid % 8 == 5), "")
                     .otherwise(F.col("f_session")))
    f = f.withColumn("f_channel", F.when(_fault("DERIV", 23) & (eid % 10 == 4), "1a")
                     .otherwise(F.col("f_channel")))
    f = f.withColumn("f_trade_id", F.when(_fault("RV", 25) & (eid % 12 == 0), "-1")
                     .otherwise(F.col("f_trade_id")))
    return f


def _header_for(feed_col, day_col):
    bad = F.replace(F.lit(C.EXPECTED_HEADER), F.lit(";TipoDoCanal"), F.lit(";Canal"))
    return F.when((feed_col == "RV") & (day_col == 5), bad).otherwise(F.lit(C.EXPECTED_HEADER))


def tick_lines_from_events(events: DataFrame) -> DataFrame:
    """Render ``events`` as one tick TXT per (feed, calendar day).

    Returns ``(feed, file_date, source_row, line)``: header on line 1, one
    line per event in (ts, event_id) order, a blank line before some events.
    Lines are numbered on the raw event columns first and rendered once,
    after numbering (the range sort samples its input, so it should be cheap).
    """
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("feed", _feed_of(F.col("event_type"))).withColumn("file_date", F.to_date("ts"))
    subs = F.when(F.col("event_id") % BLANK_BEFORE_MOD == BLANK_BEFORE_REM,
                  F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    body = e.select("*", F.lit(1).alias("kind"), F.explode(subs).alias("sub"))
    headers = e.select("feed", "file_date").distinct().select(
        F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"), "feed", "file_date",
        F.lit(0).alias("kind"), F.lit(0).alias("sub"))

    def render(tagged: DataFrame) -> DataFrame:
        f = _apply_faults(tick_fields(tagged, keep=("kind", "sub", POS)))
        line = F.concat_ws(C.FIELD_SEPARATOR, *[F.col(c) for c in (
            "f_ref", "f_symbol", "f_action", "f_price", "f_qty", "f_time", "f_trade_id",
            "f_session", "f_trade_date", "f_buyer", "f_seller", "f_channel")])
        line = F.when(_fault("RV", 9) & (F.col("event_id") % 50 == 7),
                      F.concat(line, F.lit(";X"))).otherwise(line)
        text = (F.when(F.col("kind") == 0, _header_for(F.col("feed"), F.col("_day")))
                 .when(F.col("sub") == 0, F.lit("")).otherwise(line))
        return f.select("feed", "file_date", POS, text.alias("line"))

    numbered = sequence_within(body.unionByName(headers), ["feed", "file_date"],
                               ["kind", "ts", "event_id", "sub"], out="source_row",
                               project=render)
    return numbered.select("feed", "file_date", "source_row", "line")


# --- Report text rendered from driver tables ---

LEAD_DAYS, LEAD_KEYS = 1 << 26, 1 << 34


def _lead(key: str):
    """One number that never falls along (report_date, kind, ``key``), for an integer key.

    A day or key outside of the bounds counts as the bound, and of such a day
    nothing else counts; a null key is sorted first and counts as the lowest.
    These rows tie, and the sort's other columns decide.
    """
    day = F.unix_date("report_date")
    bound = F.when(day < -LEAD_DAYS, -LEAD_DAYS).when(day > LEAD_DAYS, LEAD_DAYS).otherwise(day).cast("bigint")
    low = F.greatest(F.least(F.col(key).cast("bigint"), F.lit(LEAD_KEYS - 1)), F.lit(0))
    rest = F.col("kind") * F.lit(LEAD_KEYS) + F.when(F.col(key).isNull(), F.lit(0)).otherwise(low)
    return bound * F.lit(4 * LEAD_KEYS) + F.when(day.between(-LEAD_DAYS, LEAD_DAYS - 1), rest).otherwise(F.lit(0))


def _report_file(raw: DataFrame, render, preamble: list[str], footer: list[str],
                 order_cols: list[str]) -> DataFrame:
    """Number and render report files: preamble, data rows, footer.

    ``raw`` has ``report_date``, ``order_cols`` and whatever ``render``
    reads; rows are numbered on those raw columns (the first of which is an
    integer), then ``render()`` (a Column) builds each data line once.  Returns
    ``(report_date, line_no, line)``.
    """
    dates = raw.select("report_date").distinct()
    fixed = F.array(*[F.struct(F.lit(0).alias("kind"), F.lit(i).alias("sub")) for i in range(len(preamble))],
                    *[F.struct(F.lit(2).alias("kind"), F.lit(i).alias("sub")) for i in range(len(footer))])
    body = raw.select("*", F.lit(1).alias("kind"), F.lit(0).alias("sub"))
    # a handful of fixed lines per file, exploded from a literal (no join)
    frame = dates.select("report_date", F.inline(fixed)).select(
        "report_date", *[F.lit(None).cast(f.dataType).alias(f.name)
                         for f in raw.schema.fields if f.name != "report_date"], "kind", "sub")
    pre = F.array(*[F.lit(t) for t in preamble]) if preamble else None
    foot = F.array(*[F.lit(t) for t in footer]) if footer else None

    def project(tagged: DataFrame) -> DataFrame:
        text = F.when(F.col("kind") == 1, render())
        if pre is not None:
            text = text.when(F.col("kind") == 0, F.get(pre, F.col("sub")))
        if foot is not None:
            text = text.when(F.col("kind") == 2, F.get(foot, F.col("sub")))
        return tagged.select("report_date", POS, text.alias("line"))

    numbered = sequence_within(body.unionByName(frame), ["report_date"],
                               ["kind", *order_cols, "sub"], out="line_no", project=project,
                               lead=_lead(order_cols[0]))
    return numbered.select("report_date", "line_no", "line")


# Fixed rendering rules for the lending report (mirrored by the oracle SQL).
BTB_PREAMBLE = ["Empréstimos registrados - posição em aberto por ativo", "Glossário: consulte o site",
                "", ";;;;;;;;Taxa doador;;;Taxa tomador;;",
                "Data;IF;ISIN;Empresa;Mercado;Contratos;Quantidade;Valor;Mín;Méd;Máx;Mín;Méd;Máx"]


# row order inside a file; (orderkey, linenumber) alone repeats in the tables
BTB_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def btb_raw(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.to_date("l_shipdate").alias("report_date"), "l_orderkey", "l_partkey",
                           "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_discount", "l_tax", "l_returnflag")


def btb_line():
    d = F.col("report_date")
    trade_date = F.when(F.col("l_orderkey") % 997 == 5,
                        F.concat(F.lit("31/02/"), F.date_format(d, "yyyy"))) \
                  .otherwise(F.date_format(d, "dd/MM/yyyy"))
    contracts = (F.when((F.col("l_orderkey") % 1009 == 7) & (F.col("l_linenumber") == 1), "2,5")
                  .when(F.col("l_linenumber") == 3, "")
                  .otherwise(F.col("l_linenumber").cast("string")))
    cells = [
        trade_date,
        F.col("l_suppkey").cast("string"),
        F.concat(F.lit("BRL"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")),
        F.when(F.col("l_partkey") % 17 == 0, F.concat(F.lit('"COMPANY '), F.col("l_partkey").cast("string"),
                                                      F.lit('; ""SA"""')))
         .otherwise(F.concat(F.lit("COMPANY "), F.col("l_partkey").cast("string"))),
        F.when(F.col("l_returnflag") == "R", "Balcão").otherwise("Bolsa"),
        contracts,
        F.col("l_quantity").cast("bigint").cast("string"),
        F.when(F.col("l_orderkey") % 1499 == 11, F.concat(F.lit("1."), _comma2(F.col("l_extendedprice"))))
         .otherwise(_comma2(F.col("l_extendedprice"))),
        F.concat(_comma2(F.col("l_discount") * 100), F.lit("%")),
        F.concat(_comma2(F.col("l_tax") * 100), F.lit("%")),
        F.concat(_comma2((F.col("l_discount") + F.col("l_tax")) * 100), F.lit("%")),
        _comma2(F.col("l_discount") * 50),
        _comma2(F.col("l_tax") * 50),
        _comma2((F.col("l_discount") + F.col("l_tax")) * 50),
    ]
    return F.concat_ws(";", *cells)


def btb_lines_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One lending report per ship date: 5 preamble lines, one row per line item."""
    return _report_file(btb_raw(lineitem), btb_line, BTB_PREAMBLE, [], list(BTB_ORDER))


EQUITIES_PREAMBLE = ["Cadastro de instrumentos (listado)", "Glossário: consulte o site", "",
                     "Instrumento;Ativo;Descrição;Segmento;Mercado;Categoria;..."]
EQUITIES_FOOTER = ["Informações sujeitas a alteração; consulte o site"]
EQUITIES_DAYS = 20


def equities_raw(part: DataFrame) -> DataFrame:
    rd = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % EQUITIES_DAYS).cast("int"))
    return part.select(rd.alias("report_date"), "p_partkey", "p_name", "p_brand", "p_type",
                       "p_size", "p_retailprice")


def equities_line():
    rd = F.col("report_date")
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    dmy = lambda c: F.date_format(c, "dd/MM/yyyy")
    cells = [
        F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit(""))), key),
        F.col("p_brand"), F.col("p_name"), F.col("p_type"),
        F.when(size % 5 == 0, "-").otherwise("CASH"),
        F.lit("SHARES"),
        F.when(size % 3 == 0, "31/12/9999").when(size % 3 == 1, dmy(F.date_add(rd, size))).otherwise("-"),
        dmy(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 1000).cast("int"))),
        F.lit("31/12/9999"),
        F.concat(F.lit("BR"), F.lpad(key, 10, "0")),
        F.lit("ESVUFR"), F.lit("-"),
        F.when(size % 4 == 0, "-").otherwise((size * 100).cast("string")),
        F.lit("BRL"), F.lit("PHYSICAL"),
        _comma2(F.col("p_retailprice")),
        F.lit("-"),
        F.when(F.col("p_partkey") % 211 == 13, "YES").when(size % 3 == 0, "TRUE")
         .when(size % 3 == 1, "FALSE").otherwise("-"),
        (F.col("p_partkey") % 300).cast("string"),
        F.lit("1"), F.lit("2"), F.lit("-"),
        F.when(size % 2 == 0, "False").otherwise("True"),
        F.lit("FALSE"), F.lit("ON NM"),
        F.concat(F.lit("CORP "), F.col("p_brand")),
        F.when(F.col("p_partkey") % 97 == 5, "30/02/2024").otherwise("-"), F.lit("FUNGIBLE"),
        (F.col("p_partkey") * 1000).cast("string"),
        F.lit("NM"),
    ]
    return F.concat_ws(";", *cells)


def equities_lines_from_part(part: DataFrame) -> DataFrame:
    """Instruments report files (one per day): 4 preamble lines, rows, 1 footer line."""
    return _report_file(equities_raw(part), equities_line, EQUITIES_PREAMBLE, EQUITIES_FOOTER,
                        ["p_partkey"])


DERIVATIVES_PREAMBLE = ["Cadastro de instrumentos (derivativos)", "Glossário: consulte o site", "",
                        "Instrumento;Ativo;Descrição;Segmento;Mercado;Categoria;..."]
DERIVATIVES_FOOTER = ["Informações sujeitas a alteração; consulte o site"]
DERIVATIVES_DAYS = 10


def derivatives_raw(orders: DataFrame) -> DataFrame:
    rd = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % DERIVATIVES_DAYS).cast("int"))
    return orders.select(rd.alias("report_date"), "o_orderkey", "o_custkey", "o_orderstatus",
                         F.to_date("o_orderdate").alias("o_day"), "o_orderpriority")


def derivatives_line():
    k, cust, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    dmy = lambda c: F.date_format(c, "dd/MM/yyyy")
    roll = k % 6 == 0
    is_opt = st == "O"
    cells = [
        F.concat(F.lit("FUT"), k.cast("string")),
        F.col("o_orderpriority"),
        F.concat(F.lit("CONTRACT "), cust.cast("string")),
        F.lit("DERIVATIVES"),
        F.when(st == "F", "FUTURE").when(is_opt, "OPTIONS").otherwise("-"),
        F.lit("FUT"),
        dmy(F.col("o_day")),
        F.concat(F.lit("F"), (k % 10).cast("string")),
        dmy(F.date_sub(F.col("o_day"), 30)),
        F.when(k % 4 == 0, "31/12/9999").otherwise(dmy(F.col("o_day"))),
        F.lit("DOL"), F.lit("-"), F.lit("-"),
        F.when(k % 3 == 0, "TRUE").otherwise("false"),
        F.concat(F.lit("BRBMEF"), F.lpad(k.cast("string"), 6, "0")),
        F.lit("FFDCSX"), F.lit("-"), F.lit("-"),
        F.when(is_opt, "CALL").otherwise("-"),
        _comma2((cust % 50) / F.lit(10.0)),
        F.lit("1"),
        F.when(k % 5 == 0, "-").otherwise((cust % 100 + 1).cast("string")),
        F.lit("BRL"), F.lit("FINANCIAL"), F.lit("0"),
        F.when(k % 7919 == 3, "abc").otherwise((k % 250).cast("string")),
        (k % 365).cast("string"),
        F.lit("-"),
        F.when(k % 7 == 0, "1,0").otherwise("0"),
        F.when(roll, "C").otherwise("-"),
        F.when(roll, F.concat(F.lit("DOLF"), (k % 10).cast("string"))).otherwise("-"),
        F.when(roll, "V").otherwise("-"),
        F.when(roll, F.concat(F.lit("DOLG"), (k % 10).cast("string"))).otherwise("-"),
        F.when(is_opt, _comma2((cust % 1000) / F.lit(4.0))).otherwise("-"),
        F.when(is_opt, "EURO").otherwise("-"),
        F.lit("PRICE"),
        F.when(k % 4999 == 17, "N").when(is_opt, "FALSE").otherwise("-"),
        F.lit("-"),
    ]
    return F.concat_ws(";", *cells)


def derivatives_lines_from_orders(orders: DataFrame) -> DataFrame:
    """Derivatives instruments report files: 4 preamble lines, rows, 1 footer line."""
    return _report_file(derivatives_raw(orders), derivatives_line, DERIVATIVES_PREAMBLE,
                        DERIVATIVES_FOOTER, ["o_orderkey"])
