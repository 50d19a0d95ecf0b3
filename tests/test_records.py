"""Quoted cells that span lines: records against the csv module, on files cut into many splits."""

import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import records
from tapeworks.operators.layouts import ReportLayout, parse_report
from tapeworks.sources.text import scan_lines

LAYOUT = ReportLayout("T", 2, 0, (("a", "string"), ("b", "string"), ("c", "string")), na_values=())
FOOTED = ReportLayout("F", 2, 1, (("a", "string"), ("b", "int")), na_values=())
DAY = dt.date(2026, 6, 30)


def _cell(rng):
    text = "".join(rng.choice(['x', 'é', ';', '\n', '"', ' ', '\n\n', 'word']) for _ in range(rng.randrange(6)))
    kind = rng.randrange(4)
    if kind == 0:
        return '"' + text.replace('"', '""') + '"' + rng.choice(["", "", "tail", 'q"q'])
    plain = text.replace(";", "").replace("\n", "")
    return plain.lstrip('"') if kind == 1 else f"p{plain}"


def _file(rng, n):
    lines = ['preamble "with a quote', "columns"]
    return "\n".join(lines + [";".join(_cell(rng) for _ in range(3)) or "x;;" for _ in range(n)]) + "\n"


def _expected(text):
    """(first line, cells) of every record behind the preamble that is not blank."""
    body = text.split("\n", 2)[2]
    out, reader = [], csv.reader(io.StringIO(body, newline=""), delimiter=";")
    start = 0
    for row in reader:
        if row:
            out.append((start + 3, [c.replace("\r", "") for c in row]))
        start = reader.line_num
    return out


@pytest.mark.parametrize("seed,split,block", [(1, None, None), (2, "4096", 7), (3, "16384", 50)])
def test_records_equal_the_csv_module(spark, tmp_path, monkeypatch, seed, split, block):
    rng = random.Random(seed)
    texts = {i: _file(rng, 1200) for i in range(3)}
    for i, t in texts.items():
        (tmp_path / f"{i}.csv").write_text(t, newline="")
    if block:
        monkeypatch.setattr(records, "BLOCK_LINES", block)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = scan_lines(spark, str(tmp_path), "UTF-8").select(
            F.regexp_extract("path", r"(\d)\.csv$", 1).cast("int").alias("k"), "line_no", "line")
        if split:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        rows, verdicts = parse_report(lines, LAYOUT, ["k"])
        got = {(r.k, r.line_no): [r.a, r.b, r.c] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.status for r in verdicts.collect()} == {"OK"}
    want = {(i, n): (c + [None] * 3)[:3] for i, t in texts.items() for n, c in _expected(t)}
    assert got == want and sum("\n" in (v or "") for r in got.values() for v in r) > 300


def _lines(spark, text, key=1):
    rows = [(key, i + 1, x) for i, x in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "k int, line_no int, line string")


def test_unclosed_quote_fails_the_file_and_no_other(spark):
    lines = _lines(spark, 'p\nc\n"a\nb";1;x\n"open;2;y\nz;3;w').unionByName(_lines(spark, 'p\nc\n"a\n\nb";1;x', 2)) \
        .unionByName(_lines(spark, "p\nc\na;b;c", 3))
    rows, verdicts = parse_report(lines, LAYOUT, ["k"])
    v = {r.k: r for r in verdicts.collect()}
    assert (v[1].status, v[1].rule, v[1].first_line, v[1].first_value) == ("REJECTED", "quote_unclosed", 5, '"open;2;y')
    assert v[2].status == v[3].status == "OK" and v[2].data_rows == 1
    assert sorted((r.k, r.line_no, r.a) for r in rows.collect()) == [(2, 3, "a\n\nb"), (3, 3, "a")]


def test_footer_behind_spanning_records(spark):
    lines = _lines(spark, 'p\nc\n"a\nb";1\nc;2\nfooter; with text')
    rows, verdicts = parse_report(lines, FOOTED, ["k"])
    assert [(r.line_no, r.a, r.b) for r in rows.orderBy("line_no").collect()] == [(3, "a\nb", 1), (5, "c", 2)]
    assert verdicts.first().status == "OK"


def test_long_cells_and_many_quotes(spark):
    long_ = "x" * 200_000 + '""' * 500 + "y"
    rows, verdicts = parse_report(_lines(spark, f'p\nc\n"{long_}\nend";1;2\na;"{long_}";3'), LAYOUT, ["k"])
    got = {r.line_no: r for r in rows.collect()}
    plain = long_.replace('""', '"')
    assert got[3].a == f"{plain}\nend" and got[5].b == plain and verdicts.first().status == "OK"


def test_without_spanning_cells_nothing_is_cut_anew(spark, monkeypatch):
    from tapeworks.operators import layouts
    monkeypatch.setattr(layouts, "join_records", lambda *a: (_ for _ in ()).throw(AssertionError("not needed")))
    rows, _ = parse_report(_lines(spark, 'p\nc\n"a;b";1;x\nq"q;2;y'), LAYOUT, ["k"])
    assert sorted(r.a for r in rows.collect()) == ["a;b", 'q"q']


def test_small_splits_share_tasks(spark, tmp_path):
    text = "".join(f'{i};"a\n{i}"\n' if i % 7 == 0 else f"{i};b\n" for i in range(4000))
    (tmp_path / "one.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        df = scan_lines(spark, str(tmp_path), "UTF-8")
        tables = {f.rsplit("/", 1)[0]: 0 for f in df.inputFiles()}
        for f in df.inputFiles():
            tables[f.rsplit("/", 1)[0]] += 1
        got = [(r.line_no, r.line) for r in df.orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(text) // 256 > 100 and max(tables.values()) <= 4 * spark.sparkContext.defaultParallelism
    assert got == [(i + 1, line) for i, line in enumerate(text.splitlines())]
