"""Report layouts on inline samples: skip/footer, NA markers, conversions, registry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.layouts import LAYOUTS, ReportLayout, LayoutRegistry, parse_report
from tapeworks.plans.reports import read_report_by_dates, report_lines_from_files


def _lines(spark, texts, day="2026-06-30"):
    rows = [(dt.date.fromisoformat(day), i + 1, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "report_date date, line_no int, line string")


BTB = [
    "Empréstimos registrados", "Glossário", "", ";;;;;;;;Taxa doador;;;Taxa tomador;;",
    "Data;IF;ISIN;Empresa;Mercado;Contratos;Qtd;Valor;a;b;c;d;e;f",
    "30/06/2026;1001;BRABCDACNOR1;ABCD SA;Bolsa;12;1500;7,96;2,92%;3,10%;4,00%;1,5;2,0;2,5",
    "30/06/2026;1002;BRWXYZACNOR2;WXYZ SA;Balcão;;200;10;0,10%;0,10%;0,10%;0;0;0",
]


def test_btb_loan_balance(spark):
    rows, verdicts = parse_report(_lines(spark, BTB), LAYOUTS.get("BTBLoanBalance"), ["report_date"])
    assert verdicts.first().status == "OK"
    r = rows.orderBy("line_no").collect()
    assert len(r) == 2 and len(rows.columns) == 16
    assert r[0].trade_date == dt.date(2026, 6, 30) and r[0].value_brl == pytest.approx(7.96)
    assert r[0].donor_rate_min == pytest.approx(0.0292) and r[0].borrower_rate_min == pytest.approx(0.015)
    assert r[1].contracts_count is None and r[1].market == "Balcão" and r[1].if_code == "1002"


def test_btb_bad_date_rejects_file(spark):
    bad = BTB[:5] + [BTB[5], BTB[6].replace("30/06/2026", "31/02/2026")]
    _, verdicts = parse_report(_lines(spark, bad), LAYOUTS.get("BTBLoanBalance"), ["report_date"])
    v = verdicts.first()
    assert (v.status, v.rule, v.first_line, v.first_value) == ("REJECTED", "trade_date_invalid", 7, "31/02/2026")


def _equities_row(ticker, expiration="31/12/9999", premium="TRUE", lot="100", price="7,96", market="CASH"):
    cells = [ticker, "ABCD", "ABCD ON", "CASH", market, "SHARES", expiration, "01/01/2020", "31/12/9999",
             "BRABCDACNOR1", "ESVUFR", "-", lot, "BRL", "PHYSICAL", price, "-", premium, "101", "1",
             "2", "-", "False", "FALSE", "ON NM", "ABCD SA", "-", "FUNGIBLE", "1000", "NM"]
    return ";".join(cells)


def test_instruments_equities_footer_na_and_sentinel(spark):
    texts = ["Cadastro", "Glossário", "", "header",
             _equities_row("ABCD3"), _equities_row("WXYZ3", expiration="-", premium="-", lot="-",
                                                   market="-"),
             "", "Rodapé: informação sujeita a alteração"]
    rows, verdicts = parse_report(_lines(spark, texts), LAYOUTS.get("InstrumentsEquities"), ["report_date"])
    assert verdicts.first().data_rows == 2
    r = {x.ticker_symbol: x for x in rows.collect()}
    assert set(r) == {"ABCD3", "WXYZ3"}                       # footer dropped positionally
    assert r["ABCD3"].expiration_date == dt.date(9999, 12, 31)  # sentinel is a real date
    assert r["WXYZ3"].expiration_date is None and r["WXYZ3"].market is None
    assert r["ABCD3"].premium_upfront_indicator is True and r["WXYZ3"].premium_upfront_indicator is None
    assert r["ABCD3"].protection_flag is False and r["ABCD3"].allocation_lot_size == 100
    assert r["ABCD3"].option_type is None and r["ABCD3"].exercise_price == pytest.approx(7.96)


def test_instruments_equities_bad_boolean(spark):
    texts = ["a", "b", "", "h", _equities_row("ABCD3", premium="YES"), "footer"]
    _, verdicts = parse_report(_lines(spark, texts), LAYOUTS.get("InstrumentsEquities"), ["report_date"])
    v = verdicts.first()
    assert (v.status, v.source_column, v.first_value) == ("REJECTED", "premium_upfront_indicator", "YES")


def test_instruments_derivatives_rollover_and_fraction(spark):
    n = len(LAYOUTS.get("InstrumentsDerivatives").columns)
    cells = ["-"] * n
    names = [c for c, _ in LAYOUTS.get("InstrumentsDerivatives").columns]
    cells[names.index("ticker_symbol")] = "DOLF27G27"
    cells[names.index("expiration_date")] = "01/07/2027"
    cells[names.index("contract_multiplier")] = "0,2"
    cells[names.index("side_type_code_1")] = "C"
    cells[names.index("underlying_ticker_symbol_1")] = "DOLF27"
    cells[names.index("side_type_code_2")] = "V"
    cells[names.index("underlying_ticker_symbol_2")] = "DOLG27"
    cells[names.index("required_conversion_indicator")] = "false"
    cells[names.index("working_days")] = "21"
    texts = ["a", "b", "", "h", ";".join(cells), "footer"]
    rows, verdicts = parse_report(_lines(spark, texts), LAYOUTS.get("InstrumentsDerivatives"), ["report_date"])
    assert verdicts.first().status == "OK"
    r = rows.first()
    assert r.contract_multiplier == pytest.approx(0.2) and r.expiration_date == dt.date(2027, 7, 1)
    assert (r.underlying_ticker_symbol_1, r.underlying_ticker_symbol_2) == ("DOLF27", "DOLG27")
    assert r.required_conversion_indicator is False and r.working_days == 21
    assert r.exercise_price is None and len(rows.columns) == n + 2


def test_too_many_fields_rejected_short_rows_padded(spark):
    texts = BTB[:5] + [BTB[5] + ";extra"]
    _, verdicts = parse_report(_lines(spark, texts), LAYOUTS.get("BTBLoanBalance"), ["report_date"])
    assert verdicts.first().rule == "too_many_fields"
    short = BTB[:5] + ["30/06/2026;1001;BR;ABCD;Bolsa;1;2"]
    rows, verdicts = parse_report(_lines(spark, short), LAYOUTS.get("BTBLoanBalance"), ["report_date"])
    assert verdicts.first().status == "OK" and rows.first().value_brl is None


def test_registry_dispatch_duplicate_unknown():
    reg = LayoutRegistry()
    layout = ReportLayout("X", 0, 0, (("a", "string"),))
    reg.register(layout)
    assert reg.get("X") is layout
    with pytest.raises(ValueError):
        reg.register(layout)
    with pytest.raises(NotImplementedError, match="known"):
        reg.get("Nope")
    assert LAYOUTS.names() == ["BTBLoanBalance", "InstrumentsDerivatives", "InstrumentsEquities"]


def test_read_by_dates_from_archive_files(spark, tmp_path):
    root = tmp_path / "reports"
    for day in ("2026-06-29", "2026-06-30"):
        folder = root / "outros_dados" / "BTBLoanBalance" / "year=2026"
        folder.mkdir(parents=True, exist_ok=True)
        text = "﻿" + "\r\n".join(BTB).replace("30/06/2026", f"{day[8:]}/06/2026") + "\r\n"
        (folder / f"{day}.csv").write_bytes(text.encode("utf-8"))
    lines = report_lines_from_files(spark, str(root))
    rows, missing, _ = read_report_by_dates(spark, lines, "BTBLoanBalance",
                                            ["2026-06-30", "2026-06-29", "2026-07-01", "2026-06-30"])
    assert rows.count() == 4
    assert [str(r.report_date) for r in missing.collect()] == ["2026-07-01"]
    assert rows.where(F.col("report_date") == "2026-06-29").first().trade_date == dt.date(2026, 6, 29)
    empty, missing, _ = read_report_by_dates(spark, lines, "BTBLoanBalance", ["2026-01-05"])
    assert empty.count() == 0 and "value_brl" in empty.columns
    with pytest.raises(KeyError):
        read_report_by_dates(spark, lines, "NoSuchReport", ["2026-06-30"])
    with pytest.raises(NotImplementedError):
        read_report_by_dates(spark, lines, "Trade", ["2026-06-30"])


def test_spreadsheet_na_words_are_opt_in(spark):
    from tapeworks.functions.strict import SPREADSHEET_NA
    cols = (("ticker", "string"), ("qty", "int"))
    plain = ReportLayout("T1", 0, 0, cols)
    words = ReportLayout("T2", 0, 0, cols, na_values=SPREADSHEET_NA + ("-",))
    lines = _lines(spark, ["NA;1", "-;NULL"])
    rows, verdicts = parse_report(lines, plain, ["report_date"])
    assert verdicts.first().rule == "qty_invalid"          # 'NULL' is not an integer by default
    rows, verdicts = parse_report(lines, words, ["report_date"])
    got = {(r.ticker, r.qty) for r in rows.collect()}
    assert verdicts.first().status == "OK" and got == {(None, None), (None, 1)}
    rows, _ = parse_report(_lines(spark, ["NA;1"]), plain, ["report_date"])
    assert rows.first().ticker == "NA"                     # a ticker called NA survives


def test_landing_two_days_keeps_both_and_skips_present_ones(spark, tmp_path):
    import datetime as dt

    from tapeworks.plans.reports import archive_raw_lines, read_raw_lines
    root = str(tmp_path / "raw")

    def lines(day, text):
        return spark.createDataFrame([("lending", "BTBLoanBalance", dt.date(2026, 6, day), 1, text)],
                                     "section string, api_name string, report_date date, line_no int, line string")

    archive_raw_lines(lines(29, "a"), root)
    archive_raw_lines(lines(30, "b"), root)
    archive_raw_lines(lines(30, "c"), root, skip_existing=True)
    assert sorted((r.report_date.day, r.line) for r in read_raw_lines(spark, root).collect()) == [(29, "a"), (30, "b")]
    archive_raw_lines(lines(30, "c"), root)
    assert sorted((r.report_date.day, r.line) for r in read_raw_lines(spark, root).collect()) == [(29, "a"), (30, "c")]


def test_quoted_cells_and_bad_numbers(spark):
    from pyspark.sql import functions as F

    from tapeworks.operators.layouts import ReportLayout, parse_report, split_cells
    rows = [('"EMPRESA; SA";1', ["EMPRESA; SA", "1"]), ('"ABCD";2', ["ABCD", "2"]), ('a"b;3', ['a"b', "3"]),
            ('"say ""hi""";', ['say "hi"', ""]), (';"x;y;z"', ["", "x;y;z"]), ('"";""', ["", ""]), ("p;q", ["p", "q"])]
    df = spark.createDataFrame([(r[0],) for r in rows], "line string")
    assert [r.c for r in df.select(split_cells(F.col("line"), ";").alias("c")).collect()] == [r[1] for r in rows]
    layout = ReportLayout("t", 0, 0, (("name", "string"), ("value", "double"), ("day", "date")))
    lines = spark.createDataFrame([(1, 1, '"A; B";1,5;31/12/2024'), (1, 2, "C;;31/02/2024"), (2, 1, "D;1.234,56;-")],
                                  "k int, line_no int, line string")
    got, verdicts = parse_report(lines, layout, ["k"])
    v = {r.k: r for r in verdicts.collect()}
    assert (v[1].status, v[1].unparsed_cells) == ("OK", 1)
    assert (v[2].rule, v[2].first_value) == ("value_invalid", "1.234,56")
    assert sorted((r.name, r.value) for r in got.collect()) == [("A; B", 1.5), ("C", None)]


def test_plain_lines_pass_every_check(spark):
    from tapeworks.operators import layouts
    layout = LAYOUTS.get("BTBLoanBalance")
    good = BTB[5].split(";")
    odd = ["", "-", "0", "-0", "+1", "1,", ",5", "1,5", "1.5", "1,2,3", "99999999999999999999", "abc", "2,92%", "%", "1%%", " 1",
           "30/02/2026", "29/02/2024", "29/02/2026", "31/04/2026", "31/12/9999", "1/1/2026", "01/01/0000", "00/01/2026",
           '"a;b"', '"a""b"c', 'a"b', '"open', '""', "x" * 50, "TRUE", "\n"]
    texts = [";".join([*good[:i], cell, *good[i + 1:]]) for i in range(len(good)) for cell in odd] + BTB[5:] + ["a", ";" * 20]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line_no int, line string").withColumn("_unclosed", F.lit(False))
    _, unparsed, checks = layouts._compiled(layout)
    cut = layouts._with_cells(df, layout)
    bad = F.lit(False)
    for _, _, check, _ in checks:
        bad = bad | F.coalesce(check, F.lit(False))
    got = cut.select("line", layouts.plain_line(F.col("line"), layout).alias("plain"), bad.alias("bad"),
                     layouts.opens(F.col("line"), ";").alias("opens"), (unparsed > 0).alias("unparsed")).collect()
    assert not [r.line for r in got if r.plain and (r.bad or r.opens or r.unparsed)]
    # the lines of an ordinary file need no cells to be cut
    assert all(r.plain for r in got if r.line in BTB[5:]) and any(r.bad for r in got) and any(r.opens for r in got)


def test_text_of_offences_is_cut_behind_the_join(spark):
    from tapeworks.operators import layouts
    layout = LAYOUTS.get("BTBLoanBalance")
    body = layouts.data_lines(_lines(spark, [*BTB, BTB[5].replace("1500", "x")]).withColumn("_unclosed", F.lit(False)), layout, ["report_date"])
    decided = layouts._decide_files(body, layout, ["report_date"])
    checks = layouts._compiled(layout)[2]
    text = layouts.offending_values(body, decided, ["report_date"], {rule: value for rule, _, _, value in checks},
                                    line_col="line_no", cut=lambda hit: layouts._with_cells(hit, layout))
    assert [r._value for r in text.collect()] == ["x"]
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("split(") < plan.index("Join Inner")  # above the join, so on the joined lines only


def test_verdicts_read_each_line_once(spark):
    from tapeworks.operators import layouts
    layout = LAYOUTS.get("BTBLoanBalance")
    texts = [*BTB, BTB[5].replace("1500", "x"), BTB[6].replace("200", "+2"), BTB[5] + ";extra", '30/06/2026;"open']
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(text):
        seen.add(1)
        return text

    lines = _lines(spark, texts[:-1]).withColumn("line", look.asNondeterministic()("line"))
    v = parse_report(lines, layout, ["report_date"])[1].first()
    assert (v.rule, v.first_line, v.first_value, v.data_rows) == ("too_many_fields", 10, "15", 5)
    assert seen.value == len(texts) - 1
    body = layouts.data_lines(_lines(spark, texts).withColumn("_unclosed", F.col("line_no") == 7), layout, ["report_date"])
    text = {r.line_no: r.line for r in layouts._marked(body, layout, ["report_date"]).collect()}
    # a sound line is marked without its text; one that is unclosed or needs a look keeps it
    assert text == {6: None, 7: texts[6], 8: texts[7], 9: texts[8], 10: texts[9], 11: texts[10]}
