"""DuckDB SQL computing the expected tick results straight from ``events``.

Independent of the Spark code path: the oracle builds the rendered fields
from the original columns and checks them with its own regexes and casts;
it never parses the rendered text.  Local time in 2024 is UTC-3 (no DST),
so an instant is the wall time plus three hours.
"""

from __future__ import annotations

from .. import contract as C

HEADER = C.EXPECTED_HEADER
BAD_HEADER = HEADER.replace(";TipoDoCanal", ";Canal")


def _fault(feed: str, day: int) -> str:
    return f"(feed = '{feed}' AND dd = {day})"


BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CASE WHEN event_type IN ('purchase', 'error') THEN 'DERIV' ELSE 'RV' END AS feed,
         CAST(ts AS DATE) AS file_date,
         dayofmonth(ts) AS dd, hour(ts) AS hh,
         strftime(ts, '%H%M%S%g') AS t
  FROM events
),
fx AS (
  SELECT *,
    CASE WHEN feed = 'DERIV' AND hh >= 16 AND event_type = 'purchase'
           THEN file_date + (CASE isodow(file_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END)
         WHEN feed = 'DERIV' AND hh < 3
           THEN file_date - (CASE isodow(file_date) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END)
         ELSE file_date END AS session_d
  FROM ev
),
fl AS (
  SELECT feed, file_date, dd, ts, event_id,
    CASE WHEN {_fault('DERIV', 15)} AND event_id % 40 = 3 THEN strftime(file_date - 1, '%Y-%m-%d')
         ELSE strftime(file_date, '%Y-%m-%d') END AS f_ref,
    upper(event_type) || CAST(user_id % 5 AS VARCHAR) AS f_symbol,
    CASE WHEN {_fault('DERIV', 19)} AND event_id % 6 = 1 THEN '256'
         WHEN {_fault('DERIV', 27)} AND event_id % 4 = 2 THEN '0001'
         WHEN event_id % 13 = 0 THEN '2' ELSE '0' END AS f_action,
    CASE WHEN ({_fault('RV', 9)} AND event_id % 7 = 0) OR ({_fault('DERIV', 11)} AND event_id % 5 = 0)
         THEN '1,2,3' ELSE replace(printf('%.2f', value), '.', ',') END AS f_price,
    CASE WHEN {_fault('RV', 13)} AND event_id % 3 = 1 THEN '4294967296'
         WHEN {_fault('RV', 17)} AND event_id % 11 = 0 THEN 'abc'
         ELSE CAST((event_id * 7) % 1000 + 1 AS VARCHAR) END AS f_qty,
    CASE WHEN event_id % 97 = 0 THEN
           CASE (event_id // 97) % 6 WHEN 0 THEN '' WHEN 1 THEN '25000000' WHEN 2 THEN '250000000'
                WHEN 3 THEN '106000000' WHEN 4 THEN '09O000000' ELSE t || '0' END
         ELSE t END AS f_time,
    CASE WHEN {_fault('RV', 25)} AND event_id % 12 = 0 THEN '-1' ELSE CAST(event_id AS VARCHAR) END AS f_trade_id,
    CASE WHEN {_fault('RV', 21)} AND event_id % 8 = 5 THEN '' WHEN hh >= 17 THEN '6' ELSE '1' END AS f_session,
    CASE WHEN {_fault('RV', 17)} AND event_id % 9 = 2 THEN '2024-02-30'
         ELSE strftime(session_d, '%Y-%m-%d') END AS f_trade_date,
    CASE WHEN event_id % 89 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS f_buyer,
    CAST(user_id % 13 AS VARCHAR) AS f_seller,
    CASE WHEN {_fault('DERIV', 23)} AND event_id % 10 = 4 THEN '1a'
         WHEN feed = 'DERIV' THEN '1' ELSE '2' END AS f_channel,
    CASE WHEN {_fault('RV', 9)} AND event_id % 50 = 7 THEN 13 ELSE 12 END AS n_fields,
    CASE WHEN event_id % 101 = 50 THEN 1 ELSE 0 END AS blank_before
  FROM fx
),
num AS (
  SELECT *,
    1 + row_number() OVER (PARTITION BY feed, file_date ORDER BY ts, event_id)
      + sum(blank_before) OVER (PARTITION BY feed, file_date ORDER BY ts, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS source_row
  FROM fl
),
hdr AS (
  SELECT feed, file_date,
         CASE WHEN min(dd) = 5 AND feed = 'RV' THEN '{BAD_HEADER}' ELSE '{HEADER}' END AS header
  FROM fl GROUP BY feed, file_date
),
chk AS (
  SELECT *,
    n_fields <> 12 AS b_field_count,
    NOT (regexp_full_match(f_trade_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
         AND try_cast(f_trade_date AS DATE) IS NOT NULL
         AND substr(f_trade_date, 1, 4) <> '0000') AS b_trade_date,
    f_ref <> strftime(file_date, '%Y-%m-%d') AS b_reference_date,
    NOT regexp_full_match(replace(f_price, ',', '.'), '-?[0-9]+(\\.[0-9]+)?') AS b_price,
    {{uint_checks}}
    false AS b_local_time_invalid
  FROM num
)"""

_UINTS = (
    ("quantity", "f_qty", C.UINT32_MAX),
    ("update_action", "f_action", C.UINT8_MAX),
    ("session_type", "f_session", C.UINT8_MAX),
    ("channel_type", "f_channel", C.UINT8_MAX),
    ("trade_id", "f_trade_id", C.INT64_MAX),
)


def _uint_checks() -> str:
    out = []
    for rule, col, mx in _UINTS:
        k = len(str(mx))
        out.append(f"NOT regexp_full_match({col}, '[0-9]{{1,{k}}}') AS b_{rule}_pattern,")
        out.append(f"(regexp_full_match({col}, '[0-9]{{1,{k}}}') AND "
                   f"try_cast({col} AS HUGEINT) > {mx}) AS b_{rule}_range,")
    return "\n    ".join(out)


# rule -> value reported for it
_VALUE = {
    "field_count": "CAST(n_fields AS VARCHAR)",
    "trade_date": "f_trade_date",
    "reference_date": "f_ref",
    "price": "f_price",
    "quantity_pattern": "f_qty", "quantity_range": "f_qty",
    "update_action_pattern": "f_action", "update_action_range": "f_action",
    "session_type_pattern": "f_session", "session_type_range": "f_session",
    "channel_type_pattern": "f_channel", "channel_type_range": "f_channel",
    "trade_id_pattern": "f_trade_id", "trade_id_range": "f_trade_id",
    "local_time_invalid": "f_time",
}


def _verdict_cte() -> str:
    aggs = []
    for rule, value in _VALUE.items():
        aggs.append(f"count(*) FILTER (WHERE b_{rule}) AS n_{rule}")
        aggs.append(f"min(source_row) FILTER (WHERE b_{rule}) AS l_{rule}")
        aggs.append(f"arg_min({value}, source_row) FILTER (WHERE b_{rule}) AS v_{rule}")
    agg = ",\n    ".join(aggs)
    # precedence: header, then the line rules in contract order, then zero rows
    cases_rule, cases_col, cases_n, cases_l, cases_v = [], [], [], [], []
    cases_rule.append(f"WHEN h.header <> '{HEADER}' THEN 'header'")
    cases_col.append(f"WHEN h.header <> '{HEADER}' THEN 'header'")
    cases_n.append(f"WHEN h.header <> '{HEADER}' THEN 1")
    cases_l.append(f"WHEN h.header <> '{HEADER}' THEN 1")
    cases_v.append(f"WHEN h.header <> '{HEADER}' THEN h.header")
    for rule, column in C.RULES:
        if rule in ("header", "zero_rows"):
            continue
        cond = f"WHEN a.n_{rule} > 0"
        cases_rule.append(f"{cond} THEN '{rule}'")
        cases_col.append(f"{cond} THEN '{column}'")
        cases_n.append(f"{cond} THEN a.n_{rule}")
        cases_l.append(f"{cond} THEN a.l_{rule}")
        cases_v.append(f"{cond} THEN a.v_{rule}")
    zr = "WHEN a.data_lines = 0"
    cases_rule.append(f"{zr} THEN 'zero_rows'")
    cases_col.append(f"{zr} THEN 'rows'")
    cases_n.append(f"{zr} THEN 1")

    def case(items):
        return "CASE " + " ".join(items) + " END"

    return f""",
agg AS (
  SELECT feed, file_date, count(*) AS data_lines, sum(blank_before) AS blank_lines,
    {agg}
  FROM chk GROUP BY feed, file_date
),
verdict AS (
  SELECT a.feed, a.file_date,
    {case(cases_rule)} AS rule,
    {case(cases_col)} AS source_column,
    CAST({case(cases_n)} AS BIGINT) AS invalid_count,
    CAST({case(cases_l)} AS INTEGER) AS first_line,
    {case(cases_v)} AS first_value,
    CAST(a.data_lines AS BIGINT) AS data_lines,
    CAST(a.blank_lines AS BIGINT) AS blank_lines
  FROM agg a JOIN hdr h USING (feed, file_date)
),
verdicts AS (
  SELECT *, CASE WHEN rule IS NULL THEN 'OK' ELSE 'REJECTED' END AS status,
    CASE WHEN rule IS NULL THEN NULL
         WHEN rule = 'zero_rows' THEN 'zero rows'
         WHEN rule = 'header' THEN 'unexpected header: ' || first_value
         WHEN rule = 'field_count' THEN printf('%d line(s) do not have 12 fields; first at line %d (%s fields)',
                                              invalid_count, first_line, first_value)
         ELSE printf('column %s: %d invalid value(s); first at line %d: %s',
                     source_column, invalid_count, first_line, first_value) END AS message
  FROM verdict
),
ticks AS (
  SELECT c.feed, c.file_date, CAST(c.source_row AS INTEGER) AS source_row,
    f_symbol AS symbol, f_trade_date AS trade_date, f_ref AS reference_date,
    CASE WHEN regexp_full_match(f_time, '([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9]{{3}}')
      THEN epoch_ms(CAST(f_ref AS TIMESTAMP)) + 10800000
           + CAST(substr(f_time, 1, 2) AS BIGINT) * 3600000
           + CAST(substr(f_time, 3, 2) AS BIGINT) * 60000
           + CAST(substr(f_time, 5, 2) AS BIGINT) * 1000
           + CAST(substr(f_time, 7, 3) AS BIGINT) END AS timestamp_ms,
    f_time AS time_raw,
    CAST(replace(f_price, ',', '.') AS DOUBLE) AS price,
    CAST(f_qty AS BIGINT) AS quantity,
    CAST(f_action AS SMALLINT) AS update_action,
    CAST(f_session AS SMALLINT) AS session_type,
    CAST(f_channel AS SMALLINT) AS channel_type,
    CAST(f_trade_id AS BIGINT) AS trade_id,
    NULLIF(f_buyer, '') AS buyer_broker,
    NULLIF(f_seller, '') AS seller_broker
  FROM chk c JOIN verdicts v ON c.feed = v.feed AND c.file_date = v.file_date AND v.status = 'OK'
)"""


def with_ticks(select_sql: str) -> str:
    """Full oracle statement: the shared CTE chain plus a final SELECT."""
    return ("WITH " + BASE.replace("{uint_checks}", _uint_checks()) + _verdict_cte()
            + "\n" + select_sql)


TICK_VERDICTS = with_ticks("""
SELECT feed, file_date, status, rule, source_column, invalid_count, first_line, first_value,
       data_lines, blank_lines FROM verdicts""")

TICKS_TYPED = with_ticks("SELECT * FROM ticks")

TICK_PROVENANCE = with_ticks("""
SELECT v.feed, v.file_date, strftime(v.file_date, '%Y-%m-%d') AS trade_date,
       v.data_lines AS source_txt_row_count, CAST(1 AS INTEGER) AS schema_version,
       CAST(count(t.source_row) AS BIGINT) AS row_count,
       CAST(count(t.source_row) FILTER (WHERE t.timestamp_ms IS NULL) AS BIGINT) AS timestamp_null_count,
       'America/Sao_Paulo' AS timezone
FROM verdicts v LEFT JOIN ticks t ON v.feed = t.feed AND v.file_date = t.file_date
WHERE v.status = 'OK'
GROUP BY v.feed, v.file_date, v.data_lines""")

TICK_REBUILD_REPORT = with_ticks("""
SELECT v.feed, v.file_date, strftime(v.file_date, '%Y-%m-%d') AS trade_date,
       CASE WHEN v.status = 'OK' THEN 'OK' ELSE 'FAILED' END AS status,
       CASE WHEN v.status = 'OK' THEN CAST(count(t.source_row) AS BIGINT) END AS row_count,
       CASE WHEN v.status = 'OK' THEN CAST(count(t.source_row) FILTER (WHERE t.timestamp_ms IS NULL) AS BIGINT) END
         AS timestamp_null_count,
       CASE WHEN v.status = 'OK' THEN CAST(count(t.source_row) FILTER (WHERE t.trade_date <> t.reference_date) AS BIGINT) END
         AS other_session_row_count,
       CASE WHEN v.status = 'OK' THEN '' ELSE v.message END AS error
FROM verdicts v LEFT JOIN ticks t ON v.feed = t.feed AND v.file_date = t.file_date
GROUP BY v.feed, v.file_date, v.status, v.message""")

TICK_BLANK_LINES = with_ticks("""
SELECT feed, file_date, CAST(rank AS INTEGER) AS rank, CAST(source_row AS INTEGER) AS source_row FROM (
  SELECT feed, file_date, source_row - 1 AS source_row,
         row_number() OVER (PARTITION BY feed, file_date ORDER BY source_row) AS rank
  FROM num WHERE blank_before = 1) WHERE rank <= 10""")

TICK_UNREADABLE_TIMES = with_ticks("""
SELECT feed, file_date, time_raw, first_line, occurrences, CAST(rank AS INTEGER) AS rank FROM (
  SELECT feed, file_date, time_raw, first_line, occurrences,
         row_number() OVER (PARTITION BY feed, file_date ORDER BY first_line) AS rank
  FROM (SELECT feed, file_date, time_raw, min(source_row) AS first_line,
               CAST(count(*) AS BIGINT) AS occurrences
        FROM ticks WHERE timestamp_ms IS NULL GROUP BY feed, file_date, time_raw))
WHERE rank <= 5""")

TICK_CODE_COUNTS = with_ticks("""
SELECT feed, file_date,
  CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE update_action = 0) AS BIGINT) AS n_new,
  CAST(count(*) FILTER (WHERE update_action = 2) AS BIGINT) AS n_cancelled,
  CAST(count(*) FILTER (WHERE update_action NOT IN (0, 2)) AS BIGINT) AS n_other_action,
  CAST(count(*) FILTER (WHERE session_type = 1) AS BIGINT) AS n_regular,
  CAST(count(*) FILTER (WHERE session_type = 6) AS BIGINT) AS n_after_hours,
  CAST(count(*) FILTER (WHERE trade_date = reference_date) AS BIGINT) AS n_own_session,
  CAST(count(*) FILTER (WHERE trade_date <> reference_date) AS BIGINT) AS n_other_session,
  CAST(count(*) FILTER (WHERE buyer_broker IS NULL) AS BIGINT) AS n_anonymous_buyer
FROM ticks GROUP BY feed, file_date""")

TICK_SESSIONS = with_ticks("""
, cal AS (
  SELECT feed, file_date,
         lag(file_date) OVER (PARTITION BY feed ORDER BY file_date) AS prev_file_date,
         lead(file_date) OVER (PARTITION BY feed ORDER BY file_date) AS next_file_date
  FROM verdicts WHERE status = 'OK'
), st AS (
  SELECT t.feed, CAST(t.trade_date AS DATE) AS session_date, t.quantity,
    CASE WHEN t.file_date = c.file_date THEN 'own'
         WHEN t.file_date = c.prev_file_date THEN 'previous'
         WHEN t.file_date = c.next_file_date THEN 'next' ELSE 'outside' END AS from_file
  FROM ticks t LEFT JOIN cal c ON t.feed = c.feed AND CAST(t.trade_date AS DATE) = c.file_date
)
SELECT feed, session_date,
  CAST(count(*) AS BIGINT) AS n_trades,
  CAST(count(*) FILTER (WHERE from_file = 'previous') AS BIGINT) AS from_previous_file,
  CAST(count(*) FILTER (WHERE from_file = 'own') AS BIGINT) AS from_own_file,
  CAST(count(*) FILTER (WHERE from_file = 'next') AS BIGINT) AS from_next_file,
  CAST(count(*) FILTER (WHERE from_file = 'outside') AS BIGINT) AS outside_window,
  CAST(sum(quantity) AS BIGINT) AS volume
FROM st GROUP BY feed, session_date""")


def _bars(millis: int) -> str:
    """Bars of ``millis`` on the local clock, three hours behind UTC all through the data."""
    start = f"(timestamp_ms - 10800000) // {millis} * {millis} + 10800000"
    return with_ticks(f"""
SELECT feed, symbol, {start} AS bar_start_ms,
  arg_min(price, {{'t': timestamp_ms, 'r': source_row}}) AS open,
  max(price) AS high, min(price) AS low,
  arg_max(price, {{'t': timestamp_ms, 'r': source_row}}) AS close,
  CAST(sum(quantity) AS BIGINT) AS volume, CAST(count(*) AS BIGINT) AS n_trades
FROM ticks WHERE timestamp_ms IS NOT NULL AND update_action <> 2
GROUP BY feed, symbol, {start}""")


TICK_BARS = _bars(60000)
TICK_BARS_HOUR = _bars(3600000)
TICK_BARS_DAY = _bars(86400000)

# Ticks written in two batches and read back over a range of business days.
TICK_LAKE_RANGE = with_ticks("""
SELECT feed, file_date, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(quantity) AS BIGINT) AS volume,
       CAST(max(source_row) AS INTEGER) AS last_row
FROM ticks WHERE file_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-26' AND isodow(file_date) < 6
GROUP BY feed, file_date""")

TICK_LAKE_MISSING = with_ticks("""
SELECT f.feed, CAST(d.d AS DATE) AS file_date
FROM (VALUES ('RV'), ('DERIV')) AS f(feed), range(DATE '2024-01-08', DATE '2024-01-27', INTERVAL 1 DAY) AS d(d)
WHERE isodow(d.d) < 6 AND NOT EXISTS (
  SELECT 1 FROM verdicts v WHERE v.status = 'OK' AND v.feed = f.feed AND v.file_date = CAST(d.d AS DATE))""")


TICK_PAYLOAD_ROUNDTRIP = with_ticks("""
SELECT v.feed, v.file_date, strftime(v.file_date, '%Y-%m-%d') AS trade_date,
       v.data_lines AS source_txt_row_count, CAST(count(t.source_row) AS BIGINT) AS row_count,
       'America/Sao_Paulo' AS timezone, '' AS payload_problem
FROM verdicts v LEFT JOIN ticks t ON v.feed = t.feed AND v.file_date = t.file_date
WHERE v.status = 'OK' GROUP BY v.feed, v.file_date, v.data_lines""")


def _stage(name: str, value: str) -> str:
    return f"rpad('{name}=' || {value}, {len(name) + 12}, ' ')"


TICK_RUN_LINES = with_ticks(f"""
, n AS (SELECT feed, file_date, count(*) AS n FROM ticks GROUP BY feed, file_date),
r AS (SELECT v.feed, v.file_date, v.status = 'OK' AS ok, v.message, coalesce(n.n, 0) AS n
      FROM verdicts v LEFT JOIN n ON n.feed = v.feed AND n.file_date = v.file_date),
s AS (SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS good, count(*) FILTER (WHERE NOT ok) AS bad FROM r)
SELECT 1 AS part, CAST(NULL AS VARCHAR) AS feed, CAST(NULL AS DATE) AS trade_date, unnest([
  printf('  Dates processed : %d', total), printf('  Succeeded       : %d', good),
  printf('  Failed          : %d', bad), '  Unavailable     : 0']) AS line FROM s
UNION ALL
SELECT 2, feed, file_date, strftime(file_date, '%Y-%m-%d') || '  ' || {_stage('download', "'SUCCESS'")} || ' '
  || {_stage('extract', "CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END")} || ' '
  || {_stage('partition', "CASE WHEN ok THEN 'SUCCESS' ELSE 'SKIPPED' END")} || ' '
  || {_stage('s3_upload', "CASE WHEN ok THEN 'SUCCESS' ELSE 'SKIPPED' END")} || ' '
  || {_stage('ticks_s3_upload', "CASE WHEN ok THEN 'SUCCESS' ELSE 'SKIPPED' END")}
  || ' ticks=' || CASE WHEN ok THEN format('{{:,}}', n) ELSE '-' END FROM r
UNION ALL
SELECT 3, feed, file_date, '    ' || strftime(file_date, '%Y-%m-%d') || ': extract: ' || message FROM r WHERE NOT ok""")
