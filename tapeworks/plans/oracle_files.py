"""DuckDB SQL with the expected results of the queries over real files, straight from the tables."""

from __future__ import annotations

from .oracle_ops import REPORT_BASE
from .oracle_reports import BTB_BASE
from .oracle_ticks import TICK_REBUILD_REPORT, TICK_SESSIONS, TICK_VERDICTS, with_ticks

ARCHIVE_VERDICTS = TICK_VERDICTS

ARCHIVE_SOURCE_LINES = with_ticks("""
SELECT w.way, feed, file_date, CAST(1 + data_lines + blank_lines AS BIGINT) AS lines_read,
       CAST(1 + data_lines + blank_lines AS BIGINT) AS lines_counted
FROM verdicts, (VALUES ('batch'), ('stream')) AS w(way)""")

ARCHIVE_STREAM = with_ticks("""
SELECT v.feed, v.file_date, v.data_lines AS source_txt_row_count, CAST(count(t.source_row) AS BIGINT) AS row_count,
       CAST(count(t.source_row) FILTER (WHERE t.timestamp_ms IS NULL) AS BIGINT) AS timestamp_null_count
FROM verdicts v JOIN ticks t ON v.feed = t.feed AND v.file_date = t.file_date
WHERE v.status = 'OK' GROUP BY v.feed, v.file_date, v.data_lines""")

RUN_OUTCOMES = with_ticks("""
SELECT feed, file_date AS trade_date, 'SUCCESS' AS download,
       CASE WHEN status = 'OK' THEN 'SUCCESS' ELSE 'FAILED' END AS extract,
       CASE WHEN status = 'OK' THEN 'SUCCESS' ELSE 'SKIPPED' END AS partition, 'SUCCESS' AS s3_upload,
       CASE WHEN status = 'OK' THEN 'SUCCESS' ELSE 'SKIPPED' END AS ticks_s3_upload,
       CASE WHEN status = 'OK' THEN data_lines END AS tick_count, status <> 'OK' AS failed
FROM verdicts
UNION ALL
SELECT DISTINCT feed, DATE '1999-01-04', 'UNAVAILABLE', 'SKIPPED', 'SKIPPED', 'SKIPPED', 'SKIPPED', CAST(NULL AS BIGINT), true
FROM verdicts""")

TICK_LINE_COUNTS = with_ticks("""
SELECT feed, file_date, CAST(1 + data_lines + blank_lines AS BIGINT) AS n_lines,
       dayofmonth(file_date) % 7 = 0 AND data_lines + blank_lines >= 2 AS lost
FROM verdicts""")

LAKE_SCHEMA = with_ticks("""
SELECT feed, file_date, true AS has_provenance, row_number() OVER (ORDER BY feed, file_date) > 1 AS schema_matches
FROM verdicts WHERE status = 'OK'""")

LAKE_FOOTER_INDEX = with_ticks("""
SELECT CAST(turn AS INTEGER) AS turn, CAST(count(*) AS BIGINT) AS n_files,
       CAST(count(*) FILTER (WHERE turn = 1 OR dayofmonth(file_date) = 8) AS BIGINT) AS n_opened,
       CAST(count(*) AS BIGINT) AS n_conform
FROM verdicts, (VALUES (1), (2)) AS t(turn) WHERE status = 'OK' GROUP BY turn""")

LAKE_ORDER = with_ticks("""
SELECT feed, file_date, CAST(count(*) AS BIGINT) AS n_rows, min(source_row) AS first_row, max(source_row) AS last_row,
       CAST(0 AS BIGINT) AS n_descents
FROM ticks GROUP BY feed, file_date""")

SESSION_STREAM = f"""
WITH s AS ({TICK_SESSIONS}),
last AS ({with_ticks("SELECT feed, max(file_date) AS m FROM verdicts WHERE status = 'OK' GROUP BY feed")})
SELECT s.* FROM s JOIN last USING (feed) WHERE session_date < m"""

REBUILD_REPORT_CSV = f"""
SELECT feed, trade_date, status, row_count, timestamp_null_count, other_session_row_count,
       CAST(0 AS DOUBLE) AS seconds, error FROM ({TICK_REBUILD_REPORT})"""

# One lending report per ship year; a record's number is that of its first physical line.
REPORT_SPANNING_ROWS = """
WITH li AS (
  SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS report_date, *,
    CASE WHEN l_partkey % 29 = 0 THEN 2 WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END AS more FROM lineitem),
num AS (
  SELECT *, 5 + row_number() OVER w + sum(more) OVER w - more AS line_no FROM li
  WINDOW w AS (PARTITION BY report_date ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT report_date, CAST(line_no AS INTEGER) AS line_no, CAST(l_suppkey AS VARCHAR) AS if_code,
  'COMPANY ' || CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 29 = 0 THEN chr(10) || chr(10) || '"B"'
    WHEN l_partkey % 23 = 0 THEN chr(10) || 'HOLDING; SA' WHEN l_partkey % 19 = 0 THEN ' 5" PIPE' ELSE '' END AS company_name,
  CAST(l_linenumber AS BIGINT) AS contracts_count, CAST(l_quantity AS BIGINT) AS assets_quantity,
  CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS value_brl
FROM num"""

REPORT_LAKE_GAPS = BTB_BASE + """
SELECT CAST(d.d AS DATE) AS report_date
FROM range(DATE '1995-03-01', DATE '1996-08-31', INTERVAL 1 DAY) AS d(d)
WHERE isodow(d.d) < 6 AND (dayofmonth(d.d) % 3 = 0 OR CAST(d.d AS DATE) NOT IN (SELECT report_date FROM li))"""

REPORT_SUPPORT = REPORT_BASE + """
SELECT CASE WHEN dayofmonth(trade_date) = 11 THEN report_name || 'X' ELSE report_name END AS report_name,
  CASE WHEN dayofmonth(trade_date) = 11 THEN 'unknown'
       WHEN report_name IN ('BTBLoanBalance', 'InstrumentsEquities', 'InstrumentsDerivatives') THEN 'parsed'
       ELSE 'unparsed' END AS support, CAST(count(*) AS BIGINT) AS n_asked
FROM rr GROUP BY 1, 2"""
