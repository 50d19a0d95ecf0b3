"""Footer reads, payload checks, raw report landing, availability, catalog keys."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tapeworks import contract as C
from tapeworks.operators import provenance, reconcile
from tapeworks.plans.reports import archive_raw_lines, availability, lines_from_bytes, parse_layout
from tapeworks.sources.catalog import catalog, enabled_reports, unknown_reports
from tapeworks.sources.inventory import _contract_arrow_schema, list_files, read_footers


FOOTER_KEY = "collector_provenance"


def test_footer_scan(spark, tmp_path):
    schema = _contract_arrow_schema()
    table = pa.Table.from_pylist([], schema=schema)
    prov = {"feed": "RV", "trade_date": "2026-06-30", "source_zip_name": "z", "source_zip_sha256": "h",
            "source_txt_name": "t", "source_txt_row_count": 3, "schema_version": 1, "row_count": 3,
            "timestamp_null_count": 0, "timezone": C.TIMEZONE, "collector_version": "1",
            "collector_commit": None, "created_at_utc": "2026-07-01T00:00:00+00:00"}
    pq.write_table(table.replace_schema_metadata({FOOTER_KEY: json.dumps(prov)}),
                   tmp_path / "2026-06-30.parquet")
    pq.write_table(pa.table({"x": [1]}), tmp_path / "2026-06-29.parquet")
    (tmp_path / "2026-06-28.parquet").write_bytes(b"not parquet")
    f = {r.path.rsplit("/", 1)[-1]: r for r in
         read_footers(list_files(spark, str(tmp_path)), FOOTER_KEY).collect()}
    ok = f["2026-06-30.parquet"]
    assert ok.readable and ok.schema_matches and ok.prov.row_count == 3 and ok.prov.feed == "RV"
    assert f["2026-06-29.parquet"].provenance is None and f["2026-06-29.parquet"].schema_matches is False
    assert f["2026-06-28.parquet"].readable is False and f["2026-06-28.parquet"].error


def test_payload_problems(spark):
    df = spark.createDataFrame([(None,), ("nope",), ('{"feed": "RV"}',)], "payload string")
    got = [r.payload_problem for r in provenance.parse_payload(df).collect()]
    assert got == ["missing", "not JSON", "incomplete"]


def test_raw_landing_and_reparse(spark, tmp_path):
    payload = ("﻿a\r\nb\r\n\r\n;;;;\r\nh\r\n"
               "30/06/2026;1;BR;X;Bolsa;1;2;3,5;1%;1%;1%;1;1;1\r\n").encode("utf-8")
    lines = lines_from_bytes(spark, payload, "BTBLoanBalance", "2026-06-30").withColumn(
        "section", F.lit("outros_dados"))
    archive_raw_lines(lines, str(tmp_path / "landing"))
    back = spark.read.parquet(str(tmp_path / "landing"))
    assert back.count() == 6 and set(back.columns) >= {"section", "api_name", "year", "line"}
    rows, verdicts = parse_layout(back, "BTBLoanBalance")
    assert verdicts.first().status == "OK" and rows.first().value_brl == 3.5


def test_availability_and_catalog(spark):
    inv = spark.createDataFrame([("a", 5), ("b", 10)], "path string, length bigint")
    assert [r.status for r in availability(inv).orderBy("path").collect()] == ["UNAVAILABLE", None]
    cat = catalog(spark)
    assert cat.count() == 63 and enabled_reports(spark).count() == 63
    assert reconcile.duplicate_keys(cat, "api_name").isEmpty()
    assert cat.where(F.col("sla_time").isNull()).first().api_name == "SharesInvesVolumMonthly"
    req = spark.createDataFrame([("BTBLoanBalance",), ("Nope",)], "api_name string")
    assert [r.api_name for r in unknown_reports(spark, req).collect()] == ["Nope"]


def test_fully_archived_and_verify_ok(spark):
    fd = spark.createDataFrame([("RV", dt.date(2026, 6, d)) for d in (1, 2)], "feed string, file_date date")
    both = reconcile.fully_archived(fd, fd, fd.where(F.col("file_date") == dt.date(2026, 6, 1)))
    assert both.count() == 1
    assert reconcile.verify_ok(fd.where(F.lit(False)))
