"""DuckDB SQL with the expected report results, straight from the tables.

Lending report from ``lineitem`` (one file per ship date, 5 preamble
lines), instruments report from ``part`` (one file per ``p_partkey % 20``
day, 4 preamble lines and a footer line).  Line numbers follow the render
order; typed values are computed from the original columns.
"""

from __future__ import annotations

_BOOL_WORDS = "('True', 'TRUE', 'true', 'False', 'FALSE', 'false')"

BTB_BASE = """
WITH li AS (
  SELECT CAST(l_shipdate AS DATE) AS report_date, *,
    CAST(5 + row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
                                ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS line_no,
    CASE WHEN l_orderkey % 997 = 5 THEN '31/02/' || strftime(CAST(l_shipdate AS DATE), '%Y')
         ELSE strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y') END AS c_trade_date,
    CASE WHEN l_orderkey % 1009 = 7 AND l_linenumber = 1 THEN '2,5'
         WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS c_contracts,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS c_assets,
    CASE WHEN l_orderkey % 1499 = 11 THEN '1.' ELSE '' END
      || replace(printf('%.2f', l_extendedprice), '.', ',') AS c_value
  FROM lineitem
),
chk AS (
  SELECT *,
    NOT (regexp_full_match(c_trade_date, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
         AND try_strptime(c_trade_date, '%d/%m/%Y') IS NOT NULL) AS b_trade_date,
    c_contracts IS NOT NULL AND NOT regexp_full_match(c_contracts, '[+-]?[0-9]+(,0*)?') AS b_contracts,
    NOT regexp_full_match(c_assets, '[+-]?[0-9]+(,0*)?') AS b_assets,
    NOT regexp_full_match(c_value, '[0-9]+,[0-9]+') AS b_value
  FROM li
),
agg AS (
  SELECT report_date, CAST(count(*) AS BIGINT) AS data_rows,
    count(*) FILTER (WHERE b_trade_date) AS n1, min(line_no) FILTER (WHERE b_trade_date) AS l1,
    arg_min(c_trade_date, line_no) FILTER (WHERE b_trade_date) AS v1,
    count(*) FILTER (WHERE b_contracts) AS n2, min(line_no) FILTER (WHERE b_contracts) AS l2,
    arg_min(c_contracts, line_no) FILTER (WHERE b_contracts) AS v2,
    count(*) FILTER (WHERE b_assets) AS n3, min(line_no) FILTER (WHERE b_assets) AS l3,
    arg_min(c_assets, line_no) FILTER (WHERE b_assets) AS v3,
    count(*) FILTER (WHERE b_value) AS n4, min(line_no) FILTER (WHERE b_value) AS l4,
    arg_min(c_value, line_no) FILTER (WHERE b_value) AS v4
  FROM chk GROUP BY report_date
),
verdicts AS (
  SELECT report_date,
    CASE WHEN n1 > 0 OR n2 > 0 OR n3 > 0 OR n4 > 0 THEN 'REJECTED' ELSE 'OK' END AS status,
    CASE WHEN n1 > 0 THEN 'trade_date_invalid' WHEN n2 > 0 THEN 'contracts_count_invalid'
         WHEN n3 > 0 THEN 'assets_quantity_invalid' WHEN n4 > 0 THEN 'value_brl_invalid' END AS rule,
    CASE WHEN n1 > 0 THEN 'trade_date' WHEN n2 > 0 THEN 'contracts_count'
         WHEN n3 > 0 THEN 'assets_quantity' WHEN n4 > 0 THEN 'value_brl' END AS source_column,
    CAST(CASE WHEN n1 > 0 THEN n1 WHEN n2 > 0 THEN n2 WHEN n3 > 0 THEN n3 WHEN n4 > 0 THEN n4 END AS BIGINT)
      AS invalid_count,
    CAST(CASE WHEN n1 > 0 THEN l1 WHEN n2 > 0 THEN l2 WHEN n3 > 0 THEN l3 WHEN n4 > 0 THEN l4 END AS INTEGER)
      AS first_line,
    CASE WHEN n1 > 0 THEN v1 WHEN n2 > 0 THEN v2 WHEN n3 > 0 THEN v3 WHEN n4 > 0 THEN v4 END AS first_value,
    data_rows, CAST(0 AS BIGINT) AS unparsed_cells
  FROM agg
)
"""

BTB_VERDICTS = BTB_BASE + "SELECT * FROM verdicts"


def _rate(expr: str) -> str:
    return f"CAST(printf('%.2f', {expr}) AS DOUBLE) / 100.0"


BTB_ROWS = BTB_BASE + f"""
SELECT c.report_date, c.line_no,
  CAST(c.l_shipdate AS DATE) AS trade_date,
  CAST(l_suppkey AS VARCHAR) AS if_code,
  'BRL' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS isin_code,
  'COMPANY ' || CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 17 = 0 THEN '; "SA"' ELSE '' END AS company_name,
  CASE WHEN l_returnflag = 'R' THEN 'Balcão' ELSE 'Bolsa' END AS market,
  CAST(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS BIGINT) AS contracts_count,
  CAST(l_quantity AS BIGINT) AS assets_quantity,
  CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS value_brl,
  {_rate('l_discount * 100')} AS donor_rate_min,
  {_rate('l_tax * 100')} AS donor_rate_avg,
  {_rate('(l_discount + l_tax) * 100')} AS donor_rate_max,
  {_rate('l_discount * 50')} AS borrower_rate_min,
  {_rate('l_tax * 50')} AS borrower_rate_avg,
  {_rate('(l_discount + l_tax) * 50')} AS borrower_rate_max
FROM chk c JOIN verdicts v ON c.report_date = v.report_date AND v.status = 'OK'
"""

EQ_BASE = f"""
WITH p AS (
  SELECT *, DATE '2024-01-01' + CAST(p_partkey % 20 AS INTEGER) AS report_date,
    CAST(4 + row_number() OVER (PARTITION BY p_partkey % 20 ORDER BY p_partkey) AS INTEGER) AS line_no,
    CASE WHEN p_partkey % 211 = 13 THEN 'YES' WHEN p_size % 3 = 0 THEN 'TRUE'
         WHEN p_size % 3 = 1 THEN 'FALSE' END AS c_premium
  FROM part
),
chk AS (
  SELECT *, c_premium IS NOT NULL AND c_premium NOT IN {_BOOL_WORDS} AS b_premium FROM p
),
verdicts AS (
  SELECT report_date,
    CASE WHEN count(*) FILTER (WHERE b_premium) > 0 THEN 'REJECTED' ELSE 'OK' END AS status,
    CASE WHEN count(*) FILTER (WHERE b_premium) > 0 THEN 'premium_upfront_indicator_invalid' END AS rule,
    CASE WHEN count(*) FILTER (WHERE b_premium) > 0 THEN 'premium_upfront_indicator' END AS source_column,
    CAST(CASE WHEN count(*) FILTER (WHERE b_premium) > 0 THEN count(*) FILTER (WHERE b_premium) END AS BIGINT)
      AS invalid_count,
    CAST(min(line_no) FILTER (WHERE b_premium) AS INTEGER) AS first_line,
    arg_min(c_premium, line_no) FILTER (WHERE b_premium) AS first_value,
    CAST(count(*) AS BIGINT) AS data_rows,
    CAST(count(*) FILTER (WHERE p_partkey % 97 = 5) AS BIGINT) AS unparsed_cells
  FROM chk GROUP BY report_date
)
"""

EQ_VERDICTS = EQ_BASE + "SELECT * FROM verdicts"

EQ_ROWS = EQ_BASE + """
SELECT c.report_date, c.line_no,
  upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR) AS ticker_symbol,
  p_brand AS asset_code, p_name AS asset_description, p_type AS segment,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'CASH' END AS market,
  'SHARES' AS category,
  CASE WHEN p_size % 3 = 0 THEN DATE '9999-12-31'
       WHEN p_size % 3 = 1 THEN c.report_date + p_size END AS expiration_date,
  DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS trading_start_date,
  DATE '9999-12-31' AS trading_end_date,
  'BR' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isin_code,
  'ESVUFR' AS cfi_code, CAST(NULL AS VARCHAR) AS option_type,
  CAST(CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size * 100 END AS BIGINT) AS allocation_lot_size,
  'BRL' AS trading_currency, 'PHYSICAL' AS delivery_type,
  CAST(printf('%.2f', p_retailprice) AS DOUBLE) AS exercise_price,
  CAST(NULL AS VARCHAR) AS option_style,
  CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false END AS premium_upfront_indicator,
  CAST(p_partkey % 300 AS BIGINT) AS distribution_id,
  CAST(1 AS BIGINT) AS price_factor, CAST(2 AS BIGINT) AS days_to_settlement,
  CAST(NULL AS VARCHAR) AS series_type,
  p_size % 2 <> 0 AS protection_flag,
  false AS automatic_exercise_indicator,
  'ON NM' AS specification_code,
  'CORP ' || p_brand AS corporation_name,
  CAST(NULL AS DATE) AS corporate_action_start_date,
  'FUNGIBLE' AS custody_treatment_type,
  CAST(p_partkey * 1000 AS BIGINT) AS market_capitalisation,
  'NM' AS corporate_governance_level
FROM chk c JOIN verdicts v ON c.report_date = v.report_date AND v.status = 'OK'
"""

EQ_PERPETUAL = EQ_BASE + """
SELECT c.report_date,
  CAST(count(*) AS BIGINT) AS n_instruments,
  CAST(count(*) FILTER (WHERE p_size % 3 = 0) AS BIGINT) AS n_perpetual,
  CAST(count(*) FILTER (WHERE p_size % 3 = 2) AS BIGINT) AS n_no_expiration
FROM chk c JOIN verdicts v ON c.report_date = v.report_date AND v.status = 'OK'
GROUP BY c.report_date
"""

DV_BASE = """
WITH o AS (
  SELECT *, DATE '2024-01-01' + CAST(o_orderkey % 10 AS INTEGER) AS report_date,
    CAST(4 + row_number() OVER (PARTITION BY o_orderkey % 10 ORDER BY o_orderkey) AS INTEGER) AS line_no,
    CAST(o_orderdate AS DATE) AS o_day,
    CASE WHEN o_orderkey % 7919 = 3 THEN 'abc' ELSE CAST(o_orderkey % 250 AS VARCHAR) END AS c_working,
    CASE WHEN o_orderkey % 4999 = 17 THEN 'N' WHEN o_orderstatus = 'O' THEN 'FALSE' END AS c_premium
  FROM orders
),
chk AS (
  SELECT *, NOT regexp_full_match(c_working, '[+-]?[0-9]+(,0*)?') AS b_working,
    c_premium IS NOT NULL AND c_premium NOT IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false') AS b_premium
  FROM o
),
agg AS (
  SELECT report_date, CAST(count(*) AS BIGINT) AS data_rows,
    count(*) FILTER (WHERE b_working) AS n1, min(line_no) FILTER (WHERE b_working) AS l1,
    arg_min(c_working, line_no) FILTER (WHERE b_working) AS v1,
    count(*) FILTER (WHERE b_premium) AS n2, min(line_no) FILTER (WHERE b_premium) AS l2,
    arg_min(c_premium, line_no) FILTER (WHERE b_premium) AS v2
  FROM chk GROUP BY report_date
),
verdicts AS (
  SELECT report_date,
    CASE WHEN n1 > 0 OR n2 > 0 THEN 'REJECTED' ELSE 'OK' END AS status,
    CASE WHEN n1 > 0 THEN 'working_days_invalid' WHEN n2 > 0 THEN 'premium_upfront_indicator_invalid' END AS rule,
    CASE WHEN n1 > 0 THEN 'working_days' WHEN n2 > 0 THEN 'premium_upfront_indicator' END AS source_column,
    CAST(CASE WHEN n1 > 0 THEN n1 WHEN n2 > 0 THEN n2 END AS BIGINT) AS invalid_count,
    CAST(CASE WHEN n1 > 0 THEN l1 WHEN n2 > 0 THEN l2 END AS INTEGER) AS first_line,
    CASE WHEN n1 > 0 THEN v1 WHEN n2 > 0 THEN v2 END AS first_value,
    data_rows, CAST(0 AS BIGINT) AS unparsed_cells
  FROM agg
)
"""

DV_VERDICTS = DV_BASE + "SELECT * FROM verdicts"

DV_ROWS = DV_BASE + """
SELECT c.report_date, c.line_no,
  'FUT' || CAST(o_orderkey AS VARCHAR) AS ticker_symbol,
  o_orderpriority AS asset_code,
  'CONTRACT ' || CAST(o_custkey AS VARCHAR) AS asset_description,
  'DERIVATIVES' AS segment,
  CASE o_orderstatus WHEN 'F' THEN 'FUTURE' WHEN 'O' THEN 'OPTIONS' END AS market,
  'FUT' AS category,
  o_day AS expiration_date,
  'F' || CAST(o_orderkey % 10 AS VARCHAR) AS expiration_code,
  o_day - 30 AS trading_start_date,
  CASE WHEN o_orderkey % 4 = 0 THEN DATE '9999-12-31' ELSE o_day END AS trading_end_date,
  'DOL' AS base_code, CAST(NULL AS VARCHAR) AS conversion_criteria,
  CAST(NULL AS DATE) AS maturity_date_target,
  o_orderkey % 3 = 0 AS required_conversion_indicator,
  'BRBMEF' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS isin_code,
  'FFDCSX' AS cfi_code,
  CAST(NULL AS DATE) AS delivery_notice_start_date, CAST(NULL AS DATE) AS delivery_notice_end_date,
  CASE WHEN o_orderstatus = 'O' THEN 'CALL' END AS option_type,
  CAST(printf('%.2f', (o_custkey % 50) / 10.0) AS DOUBLE) AS contract_multiplier,
  CAST(1 AS BIGINT) AS asset_quotation_quantity,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 100 + 1 END AS BIGINT) AS allocation_lot_size,
  'BRL' AS trading_currency, 'FINANCIAL' AS delivery_type,
  CAST(0 AS BIGINT) AS withdrawal_days,
  CAST(o_orderkey % 250 AS BIGINT) AS working_days,
  CAST(o_orderkey % 365 AS BIGINT) AS calendar_days,
  CAST(NULL AS VARCHAR) AS rollover_base_price,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS opening_future_position_day,
  CASE WHEN o_orderkey % 6 = 0 THEN 'C' END AS side_type_code_1,
  CASE WHEN o_orderkey % 6 = 0 THEN 'DOLF' || CAST(o_orderkey % 10 AS VARCHAR) END AS underlying_ticker_symbol_1,
  CASE WHEN o_orderkey % 6 = 0 THEN 'V' END AS side_type_code_2,
  CASE WHEN o_orderkey % 6 = 0 THEN 'DOLG' || CAST(o_orderkey % 10 AS VARCHAR) END AS underlying_ticker_symbol_2,
  CASE WHEN o_orderstatus = 'O' THEN CAST(printf('%.2f', (o_custkey % 1000) / 4.0) AS DOUBLE) END AS exercise_price,
  CASE WHEN o_orderstatus = 'O' THEN 'EURO' END AS option_style,
  'PRICE' AS value_type,
  CASE WHEN o_orderstatus = 'O' THEN false END AS premium_upfront_indicator,
  CAST(NULL AS DATE) AS opening_position_limit_date
FROM chk c JOIN verdicts v ON c.report_date = v.report_date AND v.status = 'OK'
"""


# Lending lines landed in two batches and read back over a range of business days.
BTB_LAKE_ROWS = BTB_BASE + """
SELECT CAST(c.report_date AS DATE) AS report_date, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(l_quantity) AS BIGINT) AS assets, CAST(max(line_no) AS INTEGER) AS last_line
FROM chk c JOIN verdicts v ON c.report_date = v.report_date AND v.status = 'OK'
WHERE c.report_date BETWEEN DATE '1995-03-01' AND DATE '1996-08-30' AND isodow(c.report_date) < 6
GROUP BY c.report_date"""

BTB_LAKE_MISSING = BTB_BASE + """
SELECT CAST(d.d AS DATE) AS report_date
FROM range(DATE '1995-03-01', DATE '1996-08-31', INTERVAL 1 DAY) AS d(d)
WHERE isodow(d.d) < 6 AND CAST(d.d AS DATE) NOT IN (SELECT report_date FROM li)"""

# Physical line numbers of text files, one per order year.
TEXT_LINE_NUMBERS = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year,
       CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS INTEGER) AS line_no,
       CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus END AS line
FROM orders"""
