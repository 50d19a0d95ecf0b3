"""DuckDB SQL for the archive, retention and run-log queries."""

from __future__ import annotations

from ..sources.catalog import CATALOG

CATALOG_VALUES = "(VALUES " + ", ".join(
    f"({i}, '{n}', '{s}', '{sla}')" for i, (n, s, _, _, sla) in enumerate(CATALOG)
) + ") AS cat(idx, api_name, section, sla)"


def _archive_key(feed: str, d: str) -> str:
    return (f"CASE WHEN {feed} = 'RV' THEN 'b3/bdi/tick_by_tick_rv/' || strftime({d}, '%Y%m%d') "
            f"|| '_NEGOCIOSAVISTA.zip' ELSE 'b3/bdi/tick_by_tick_deriv/' || strftime({d}, '%d-%m-%Y') "
            f"|| '_NEGOCIOSAVISTA_DRV.zip' END")


def _ticks_key(feed: str, d: str) -> str:
    return (f"'b3/tick_by_tick/' || lower({feed}) || '/ticks/year=' || strftime({d}, '%Y') || '/' "
            f"|| strftime({d}, '%Y-%m-%d') || '.parquet'")


ARCHIVE_BASE = """
WITH archived AS (
  SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'RV' ELSE 'DERIV' END AS feed,
         CAST(o_orderdate AS DATE) AS file_date
  FROM orders WHERE o_orderkey % 500 <> 0
),
tk AS (
  SELECT feed, file_date, count(*) AS row_count, sum(l_orderkey) AS ks FROM (
    SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'RV' ELSE 'DERIV' END AS feed,
           CAST(l_shipdate AS DATE) AS file_date, l_orderkey FROM lineitem)
  GROUP BY feed, file_date
),
tf AS (
  SELECT feed, file_date, dayofmonth(file_date) <> 29 AS has_prov,
    CASE WHEN dayofmonth(file_date) = 13 THEN 0 ELSE 1 END AS sv,
    dayofmonth(file_date) <> 31 AS sm, row_count,
    row_count + CASE WHEN ks % 7 = 0 THEN 1 ELSE 0 END AS src,
    CASE WHEN dayofmonth(file_date) % 5 = 0 THEN 'build-B' WHEN dayofmonth(file_date) % 7 = 0 THEN NULL
         WHEN dayofmonth(file_date) % 11 = 0 THEN 'build-A+dirty' ELSE 'build-A' END AS commit_id
  FROM tk
)
"""

ARCHIVE_DATES = ARCHIVE_BASE + "SELECT feed, file_date FROM archived"

VERIFY = ARCHIVE_BASE + """,
j AS (
  SELECT coalesce(a.feed, t.feed) AS feed, coalesce(a.file_date, t.file_date) AS file_date,
         a.feed IS NOT NULL AS in_a, t.feed IS NOT NULL AS in_t, t.has_prov, t.sv, t.sm, t.row_count, t.src
  FROM archived a FULL OUTER JOIN tf t ON a.feed = t.feed AND a.file_date = t.file_date
),
p AS (
  SELECT feed, file_date, CASE WHEN in_a THEN 'archived' ELSE 'orphan' END AS kind,
    CASE WHEN NOT in_a THEN 'ticks Parquet without archived ZIP'
         WHEN NOT in_t THEN 'no ticks Parquet'
         WHEN NOT has_prov THEN 'pre-contract file (no provenance)'
         WHEN sv <> 1 THEN 'schema_version ' || CAST(sv AS VARCHAR)
         WHEN NOT sm THEN 'schema differs from the contract'
         WHEN row_count <> src THEN 'row_count ' || CAST(row_count AS VARCHAR)
              || ' != source_txt_row_count ' || CAST(src AS VARCHAR) END AS problem
  FROM j
)
"""

ARCHIVE_VERIFY = VERIFY + """
SELECT feed, file_date, kind, problem,
       CAST(row_number() OVER (PARTITION BY feed ORDER BY kind DESC, file_date) AS INTEGER) AS ord
FROM p WHERE problem IS NOT NULL"""

ARCHIVE_VERIFY_COUNTS = VERIFY + """
SELECT f.feed, CAST(coalesce(a.n, 0) AS BIGINT) AS archived, CAST(coalesce(t.n, 0) AS BIGINT) AS ticks_files,
       CAST(coalesce(q.n, 0) AS BIGINT) AS problems
FROM (SELECT feed FROM archived UNION SELECT feed FROM tf) f
LEFT JOIN (SELECT feed, count(*) AS n FROM archived GROUP BY feed) a ON f.feed = a.feed
LEFT JOIN (SELECT feed, count(*) AS n FROM tf GROUP BY feed) t ON f.feed = t.feed
LEFT JOIN (SELECT feed, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY feed) q ON f.feed = q.feed"""

PLAN = ARCHIVE_BASE + """,
req AS (SELECT feed, file_date FROM tf),
plan AS (
  SELECT r.feed, r.file_date,
    CASE WHEN a.feed IS NULL THEN 'FAILED'
         WHEN t.commit_id = 'build-A' AND t.sv = 1 THEN 'SKIPPED'
         ELSE 'WOULD_RUN' END AS status,
    CASE WHEN a.feed IS NULL THEN 'no archived ZIP in S3' ELSE '' END AS error,
    CAST(row_number() OVER (PARTITION BY r.feed ORDER BY r.file_date) AS INTEGER) AS position,
    CAST(count(*) OVER (PARTITION BY r.feed) AS BIGINT) AS total
  FROM req r
  LEFT JOIN archived a ON r.feed = a.feed AND r.file_date = a.file_date
  LEFT JOIN (SELECT * FROM tf WHERE has_prov) t ON r.feed = t.feed AND r.file_date = t.file_date
)
"""

REBUILD_PLAN = PLAN + "SELECT * FROM plan"
REBUILD_PLAN_BUSINESS = REBUILD_PLAN.replace(
    "req AS (SELECT feed, file_date FROM tf)", "req AS (SELECT feed, file_date FROM tf WHERE isodow(file_date) < 6)")
REBUILD_HISTOGRAM = PLAN + "SELECT status, CAST(count(*) AS BIGINT) AS n FROM plan GROUP BY status"

RETENTION_BASE = f"""
WITH f AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'RV' ELSE 'DERIV' END AS feed,
    DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS d,
    CASE doc_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'zip' ELSE 'ticks' END AS kind,
    CAST(n_chars AS BIGINT) AS length, doc_id % 23 = 0 AS check_failed,
    doc_id % 7 <> 0 AS archived, doc_id % 50 = 0 AS stranger
  FROM documents
),
k AS (
  SELECT *, CASE WHEN stranger THEN NULL ELSE d END AS file_date,
    CASE WHEN stranger OR kind = 'raw' THEN NULL
         WHEN kind = 'zip' THEN {_archive_key('feed', 'd')}
         ELSE {_ticks_key('feed', 'd')} END AS archive_key
  FROM f
),
present AS (SELECT DISTINCT archive_key FROM k WHERE archived AND archive_key IS NOT NULL),
dec AS (
  SELECT k.doc_id, k.feed, k.kind, k.file_date, k.length,
    CASE WHEN k.file_date IS NULL THEN 'ignored'
         WHEN k.file_date >= DATE '2024-02-20' - 28 THEN 'recent'
         WHEN k.kind = 'raw' THEN 'delete'
         WHEN k.check_failed THEN 'error'
         WHEN p.archive_key IS NULL THEN 'kept_missing_in_archive'
         ELSE 'delete' END AS decision
  FROM k LEFT JOIN present p ON k.archive_key = p.archive_key
)
"""

RETENTION_DECISIONS = RETENTION_BASE + "SELECT doc_id, feed, kind, file_date, decision FROM dec"
RETENTION_SUMMARY = RETENTION_BASE + """
SELECT feed,
  CAST(count(*) FILTER (WHERE decision = 'delete') AS BIGINT) AS deleted,
  CAST(count(*) FILTER (WHERE decision = 'kept_missing_in_archive') AS BIGINT) AS kept_missing_in_archive,
  CAST(count(*) FILTER (WHERE decision = 'ignored') AS BIGINT) AS ignored,
  CAST(count(*) FILTER (WHERE decision = 'error') AS BIGINT) AS errors,
  CAST(coalesce(sum(length) FILTER (WHERE decision = 'delete'), 0) AS BIGINT) AS freed_bytes,
  round(CAST(coalesce(sum(length) FILTER (WHERE decision = 'delete'), 0) AS BIGINT) / 1048576.0, 1) AS freed_mb
FROM dec GROUP BY feed"""

RUN_BASE = """
WITH r AS (
  SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderstatus AS st, o_orderkey AS k,
    o_orderdate + to_seconds(CAST(o_orderkey % 3600 AS BIGINT)) AS started,
    CAST(floor(o_totalprice) AS BIGINT) % 600 AS dur
  FROM orders
),
r2 AS (
  SELECT *, CASE WHEN st = 'F' THEN 'SUCCESS' WHEN st = 'O' THEN 'SKIPPED' ELSE 'UNAVAILABLE' END AS download,
    CASE WHEN st = 'P' THEN 'SKIPPED' WHEN k % 17 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS extract,
    k % 13 = 0 AS up_failed
  FROM r
),
r3 AS (
  SELECT *, NULLIF(concat_ws('; ', CASE WHEN st = 'P' THEN 'download: unavailable' END,
                                   CASE WHEN extract = 'FAILED' THEN 'extract: contract violation' END,
                                   CASE WHEN up_failed THEN 'upload: archive publish failed' END), '') AS error,
    started + to_seconds(dur) AS finished
  FROM r2
)
"""

RUN_DATE_SUMMARY = RUN_BASE + """
SELECT CAST(year(trade_date) AS INTEGER) AS run_year,
  CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE error IS NULL) AS BIGINT) AS succeeded,
  CAST(count(*) FILTER (WHERE error IS NOT NULL) AS BIGINT) AS failed,
  CAST(count(*) FILTER (WHERE download = 'UNAVAILABLE') AS BIGINT) AS unavailable,
  CAST(date_diff('second', min(started), max(finished)) AS BIGINT) AS duration_s
FROM r3 GROUP BY year(trade_date)"""

RUN_FAILURES = RUN_BASE + """
SELECT trade_date, CAST(count(*) AS BIGINT) AS n_failed, min(error) AS first_error
FROM r3 WHERE error IS NOT NULL GROUP BY trade_date"""

REPORT_BASE = f"""
WITH rr AS (
  SELECT cat.api_name AS report_name, cat.section, cat.sla, CAST(o.o_orderdate AS DATE) AS trade_date,
    CASE WHEN o.o_orderstatus = 'P' THEN 'UNAVAILABLE' WHEN o.o_orderkey % 19 = 0 THEN 'FAILED'
         WHEN o.o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'SKIPPED' END AS status,
    strftime(o.o_orderdate + to_seconds(CAST((o.o_orderkey * 37) % 86400 AS BIGINT)), '%H:%M:%S') AS tod
  FROM orders o JOIN {CATALOG_VALUES} ON cat.idx = o.o_orderkey % {len(CATALOG)}
)
"""

RUN_REPORT_SUMMARY = REPORT_BASE + """
SELECT section,
  CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS BIGINT) AS succeeded,
  CAST(count(*) FILTER (WHERE status = 'SKIPPED') AS BIGINT) AS skipped,
  CAST(count(*) FILTER (WHERE status = 'UNAVAILABLE') AS BIGINT) AS unavailable,
  CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS failed
FROM rr GROUP BY section"""

REPORT_LATENESS = REPORT_BASE + """
SELECT report_name AS api_name, CAST(count(*) AS BIGINT) AS n_arrivals,
  CAST(count(*) FILTER (WHERE sla <> '' AND tod > sla) AS BIGINT) AS n_late
FROM rr GROUP BY report_name"""

REPORT_FANOUT = f"""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) < 6)
SELECT CAST(year(d.d) AS INTEGER) AS run_year, cat.section, CAST(count(*) AS BIGINT) AS n_tasks
FROM d JOIN {CATALOG_VALUES} ON true
GROUP BY year(d.d), cat.section"""


OUTPUT_CHECK = ARCHIVE_BASE + """
SELECT feed, file_date, CAST(row_count AS BIGINT) AS row_count, CAST(src AS BIGINT) AS source_txt_row_count,
       CASE WHEN row_count = 0 THEN 'zero rows'
            ELSE printf('row_count %d != source_txt_row_count %d', row_count, src) END AS problem
FROM tf WHERE row_count <> src OR row_count = 0"""

FULLY_ARCHIVED = ARCHIVE_BASE + "SELECT feed, file_date FROM archived SEMI JOIN tf USING (feed, file_date)"

DUPLICATE_KEYS = """
SELECT CAST(l_shipdate AS DATE) AS ship_date, l_partkey, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

REPORT_AVAILABILITY = """
SELECT source, CAST(count(*) AS BIGINT) AS n_files,
       CAST(count(*) FILTER (WHERE strlen(text) >= 10) AS BIGINT) AS n_available,
       CAST(count(*) FILTER (WHERE strlen(text) < 10) AS BIGINT) AS n_unavailable
FROM documents GROUP BY source"""
