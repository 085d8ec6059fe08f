"""The derivation rules of `sources/domain.py` as SQL, for checking results in another engine."""

from __future__ import annotations

import re

_CODE = """lpad(CAST({k} AS VARCHAR), CAST(greatest(6, length(CAST({k} AS VARCHAR))) AS INTEGER), '0')
  || CASE {k} % 3 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' ELSE '.BJ' END"""


def code(key: str) -> str:
    return "(" + _CODE.format(k=key) + ")"


def newest(table: str, keys: str) -> str:
    """Rows of a log at their newest version; versions are unique per key in all derived tables."""
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY _version DESC) = 1"


def _flow_columns() -> str:
    out = []
    for label, rule in (("sm", "qty <= 12"), ("md", "qty > 12 AND qty <= 25"), ("lg", "qty > 25 AND qty <= 38"), ("elg", "qty > 38")):
        for side, status in (("buy", "O"), ("sell", "F")):
            hit = f"{rule} AND side = '{status}'"
            out.append(f"CAST(sum(CASE WHEN {hit} THEN qty ELSE 0 END) AS BIGINT) AS {side}_{label}_vol")
            out.append(f"sum(CASE WHEN {hit} THEN cents ELSE 0 END) / 100.0 AS {side}_{label}_amount")
    return ",\n  ".join(out)


def _calendar(bounds: str) -> str:
    return f"""
SELECT *, last_value(CASE WHEN is_open = 1 THEN cal_date END IGNORE NULLS) OVER (
    PARTITION BY exchange ORDER BY cal_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pretrade_date
FROM (
  SELECT exchange, cal_date,
    CAST(dayofweek(cal_date) BETWEEN 1 AND 5 AND day(cal_date) <> 1 AS INTEGER) AS is_open
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS cal_date FROM ({bounds}))
  CROSS JOIN (VALUES ('SSE'), ('SZSE')) e(exchange))"""


TABLES = {
    "trades": f"""
SELECT {code('l_suppkey')} AS ts_code, CAST(l_shipdate AS DATE) AS trade_date, l_orderkey AS trade_id,
  CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_linestatus AS side,
  CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 86400000
    + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS _version
FROM lineitem""",
    "bars": """
SELECT ts_code, trade_date, o AS open, h AS high, l AS low, c AS close, CAST(v AS DOUBLE) AS vol, a / 100.0 AS amount,
  (c - o) / o * 100 AS pct_chg, _version
FROM (
  SELECT ts_code, trade_date, _version,
    CAST(min(CAST(trade_id AS HUGEINT) * 10000000000 + cents // qty) % 10000000000 AS BIGINT) / CAST(100 AS DOUBLE) AS o,
    CAST(max(CAST(trade_id AS HUGEINT) * 10000000000 + cents // qty) % 10000000000 AS BIGINT) / CAST(100 AS DOUBLE) AS c,
    max(cents // qty) / CAST(100 AS DOUBLE) AS h, min(cents // qty) / CAST(100 AS DOUBLE) AS l,
    CAST(sum(qty) AS BIGINT) AS v, CAST(sum(cents) AS BIGINT) AS a
  FROM trades GROUP BY ALL)""",
    "adj_factor": """
SELECT ts_code, trade_date,
  sqrt(CAST(trade_date - DATE '1995-01-01' + 10000 AS DOUBLE)) / 100 + CASE WHEN v = 1 THEN 1.0 ELSE 0.0 END AS adj_factor,
  CAST(trade_date - DATE '1970-01-01' AS BIGINT) * 86400000 + v AS _version
FROM (SELECT DISTINCT ts_code, trade_date FROM trades) CROSS JOIN (VALUES (1), (2)) x(v)
WHERE dayofweek(trade_date) <> 0 AND (v = 2 OR dayofweek(trade_date) = 1)""",
    "moneyflow": f"SELECT ts_code, trade_date, _version,\n  {_flow_columns()}\nFROM trades GROUP BY ts_code, trade_date, _version",
    "trade_cal": _calendar("SELECT min(trade_date) AS lo, max(trade_date) AS hi FROM trades"),
    "load_cal": _calendar("SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events"),
    "symbols": f"SELECT 'basic_' || s_nationkey AS symbol_source, {code('s_suppkey')} AS ts_code FROM supplier",
    "interfaces": """
SELECT 'if_' || n_nationkey || '_' || strategy AS interface, 't_' || n_nationkey || '_' || strategy AS table_name, strategy,
  'P' || (n_regionkey % 4) AS priority, CASE WHEN n_regionkey < 3 THEN 'SSE' ELSE 'SZSE' END AS exchange,
  CASE n_regionkey WHEN 1 THEN 'ann_date' WHEN 4 THEN 'trade_date' END AS date_field,
  'basic_' || n_nationkey AS symbol_source,
  CASE n_regionkey WHEN 4 THEN DATE '2024-01-31' WHEN 3 THEN DATE '2023-01-01' ELSE DATE '2024-01-10' END AS start_date,
  NOT (n_regionkey = 2 AND strategy = 'full_once') AS enabled
FROM nation CROSS JOIN (VALUES ('full_once'), ('date_loop'), ('period_loop'), ('monthly_window'), ('per_symbol'),
  ('per_symbol_period'), ('offset_paging')) s(strategy)""",
    "events_k": """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE event_type WHEN 'view' THEN 'date_loop' WHEN 'click' THEN 'offset_paging' WHEN 'signup' THEN 'per_symbol'
    WHEN 'purchase' THEN 'period_loop' WHEN 'error' THEN 'monthly_window' END AS strategy
FROM events""",
    "state_log": f"""
SELECT interface, interface || ':' || CASE strategy
    WHEN 'date_loop' THEN strftime(ts, '%Y%m%d') WHEN 'offset_paging' THEN strftime(ts, '%Y%m%d') || ':00000000'
    WHEN 'per_symbol' THEN {code('user_id')}
    WHEN 'period_loop' THEN strftime(CAST(date_trunc('quarter', ts) AS DATE) - 1, '%Y%m%d')
    ELSE strftime(ts, '%Y%m') END AS scope_key,
  status, CAST(floor(value) AS BIGINT) AS rows,
  CASE WHEN status = 'done' THEN ts ELSE TIMESTAMP '1970-01-01 00:00:00' END AS last_success_at, ts AS heartbeat_at,
  k % 4 AS attempts,
  CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN 'Unrecognized column ''x'' in insert' WHEN 2 THEN 'Unknown strategy: weekly'
    WHEN 3 THEN 'SSL handshake failed' WHEN 4 THEN 'The read operation timed out'
    WHEN 5 THEN 'unsupported operand type(s)' ELSE 'permission denied' END AS last_error,
  event_id AS _version
FROM (SELECT *, 'if_' || (user_id % 25) || '_' || strategy AS interface,
  CASE k % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'done' WHEN 3 THEN 'partial' WHEN 4 THEN 'failed'
    ELSE 'biz_err' END AS status FROM events_k)""",
    "units": newest("state_log", "interface, scope_key"),
    "bars_now": newest("bars", "ts_code, trade_date"),
    "adj_now": newest("adj_factor", "ts_code, trade_date"),
    "flow_now": newest("moneyflow", "ts_code, trade_date"),
    "fin_now": newest("financials", "statement, ts_code, end_date"),
    "index_now": newest("index_weight", "index_code, con_code, trade_date"),
    "api_calls": """
SELECT strftime(ts, '%Y%m%d') || '-' || event_type AS run_id, event_type AS interface, ts AS started_at,
  CAST(round(value * 10) AS BIGINT) AS duration_ms,
  CASE k % 20 WHEN 0 THEN 429 WHEN 1 THEN 401 WHEN 2 THEN 403 ELSE 200 END AS status,
  CASE WHEN user_id % 3 = 0 THEN 'special' ELSE 'normal' END AS bucket
FROM events_k""",
    "financials": f"""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'income' WHEN '2-HIGH' THEN 'balancesheet' WHEN '3-MEDIUM' THEN 'cashflow'
    ELSE 'fina_indicator' END AS statement, {code('o_custkey')} AS ts_code,
  CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_date,
  CAST(o_orderdate AS DATE) AS ann_date, o_totalprice AS total_revenue, o_orderkey AS _version
FROM orders""",
    "index_weight": f"""
SELECT r_name AS index_code, {code('c_custkey')} AS con_code, last_day(CAST(o_orderdate AS DATE)) AS trade_date,
  o_totalprice AS weight, o_orderkey AS _version
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "raw_bars": """
SELECT ts_code, strftime(trade_date, '%Y%m%d') AS day,
  CASE dayofweek(trade_date) WHEN 1 THEN strftime(trade_date, '%Y%m%d') WHEN 2 THEN strftime(trade_date, '%Y-%m-%d')
    WHEN 3 THEN strftime(trade_date, '%Y/%m/%d') WHEN 4 THEN strftime(trade_date, '%Y%m')
    WHEN 5 THEN strftime(trade_date, '%Y') WHEN 6 THEN '-' ELSE ' NaN ' END AS trade_date,
  close, CAST(vol AS BIGINT) AS vol, amount, _version
FROM bars""",
    "raw_statements": f"""
SELECT o_orderkey, {code('o_custkey')} AS ts_code, d AS ann_date, d AS f_ann_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S')
    WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' ELSE 'soon' END AS update_time,
  CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE p END AS total_revenue, CASE WHEN o_orderstatus = 'F' THEN ' ' ELSE p END AS n_income,
  p AS total_share, p AS float_share, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS holder_name,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS holder_num
FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p,
  CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d') WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d') WHEN '5-LOW' THEN '00000000'
    ELSE '19600' || substr(strftime(o_orderdate, '%m%d'), 2, 3) END AS d FROM orders)""",
    "source_rows": f"""
SELECT {code('o_custkey')} AS ts_code, CAST(o_orderdate AS DATE) AS trade_date, o_orderkey AS record_id, o_totalprice AS amount,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN round(o_totalprice / 7, 2) END AS vol, o_orderpriority AS grade,
  o_orderdate AS created_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 36 HOUR END AS updated_at
FROM orders""",
    "source_union": """
SELECT ts_code, trade_date, record_id, amount, CASE WHEN year(trade_date) <> 1998 THEN vol END AS vol, grade, created_at,
  updated_at, 'source_' || year(trade_date) AS part FROM source_rows WHERE year(trade_date) BETWEEN 1995 AND 2000
UNION ALL
SELECT *, 'source_default' FROM source_rows
WHERE year(trade_date) NOT BETWEEN 1995 AND 2000 OR (grade = '1-URGENT' AND updated_at IS NULL)""",
    "target_rows": """
SELECT ts_code, trade_date, record_id, amount * 10000 AS amount, CASE WHEN grade = '5-LOW' THEN vol + 100 ELSE vol END AS vol,
  CASE WHEN grade = '3-MEDIUM' THEN '3' ELSE grade END AS grade, record_id AS _version
FROM source_rows WHERE NOT (grade = '1-URGENT' AND month(trade_date) = 1)""",
}


def with_tables(body: str) -> str:
    """Prefix a query with the tables it uses, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    body = body.strip().rstrip(";")
    visit(body)
    ctes = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in order)
    if not order:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
