"""Load-state and expected-scope queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_number, months_between, quarter_ends
from ..operators import scopes, state
from ..sources.domain import AS_OF
from .registry import query

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
ROWS = "CAST(sum(rows) AS BIGINT) AS total_rows"
STATES = ("pending", "running", "done", "partial", "failed", "biz_err")


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def as_day():
    return F.lit(AS_OF).cast("date")


@query("a1_units_by_status", f"SELECT status, count(*) AS units, {ROWS} FROM units GROUP BY status")
def _(t):
    return state.by_status(t.state_log)


@query("a2_units_by_interface_status", "SELECT interface, status, count(*) AS units FROM units GROUP BY ALL")
def _(t):
    return state.by_interface_status(t.state_log)


@query("a3_status_pivot", "SELECT *, CASE WHEN failed > 0 OR biz_err > 0 THEN '***' WHEN partial > 0 THEN '~~~' WHEN pending > 0 THEN '---' ELSE '' END AS flag"
       " FROM (SELECT interface, count(*) AS total, "
       + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in STATES) + " FROM units GROUP BY interface)")
def _(t):
    return state.status_pivot(t.state_log)


@query("a4_conditional_counts", """SELECT interface, count(*) AS units, count(*) FILTER (WHERE status = 'done') AS done,
  count(*) FILTER (WHERE status = 'failed') AS failed FROM units GROUP BY interface""")
def _(t):
    return state.failure_share(t.state_log)


@query("a5_distinct_counts", "SELECT status, count(*) AS records, count(DISTINCT interface) AS interfaces FROM units GROUP BY status")
def _(t):
    return state.distinct_interfaces(t.state_log)


@query("a6_with_totals", """SELECT interface, status, count(*) AS units, grouping(interface) = 1 AS is_total FROM units
  GROUP BY GROUPING SETS ((interface, status), ())""")
def _(t):
    return state.with_totals(t.state_log)


@query("a7_stale_interfaces", f"""SELECT interface, max(last_success_at) AS last_success FROM units WHERE status = 'done' GROUP BY interface
  HAVING max(last_success_at) < {NOW} - INTERVAL 7 DAY""")
def _(t):
    return state.stale_interfaces(t.state_log, as_of())


@query("a8_last_success", f"SELECT interface, max(last_success_at) AS last_success, {ROWS} FROM units WHERE status = 'done' GROUP BY interface")
def _(t):
    return state.last_success(t.state_log)


RUNS = """(SELECT run_id, min(started_at) AS started_at, count(*) AS units_total, count(*) FILTER (WHERE status = 'done') AS units_done,
  count(*) FILTER (WHERE status = 'failed') AS units_failed FROM (SELECT strftime(heartbeat_at, '%Y%m%d%H') || '-' || interface AS run_id,
    heartbeat_at AS started_at, status FROM state_log) GROUP BY run_id)"""
OUTCOMES = f"(SELECT *, CASE WHEN units_failed = 0 THEN 'done' WHEN units_done > 0 THEN 'partial' ELSE 'failed' END AS status FROM {RUNS})"


def _runs(t):
    hour = F.date_format("heartbeat_at", "yyyyMMddHH")
    return state.run_outcomes(t.state_log.select(
        F.concat_ws("-", hour, "interface").alias("run_id"), F.col("heartbeat_at").alias("started_at"), "status"))


@query("a9_run_outcomes", f"SELECT * FROM {OUTCOMES}")
def _(t):
    return _runs(t)


@query("w7_recent_runs", f"SELECT * FROM {OUTCOMES} ORDER BY started_at DESC, run_id LIMIT 10")
def _(t):
    return state.recent_runs(_runs(t))


@query("a14_errors_with_sample", """SELECT interface, count(*) AS units, max(substr(last_error, 1, 200)) AS sample_error FROM units
  WHERE status = 'failed' GROUP BY interface""")
def _(t):
    return state.errors_by_interface(t.state_log)


BUCKET = """CASE WHEN contains(last_error, 'Unrecognized column') THEN 'schema_drift' WHEN contains(last_error, 'Unknown strategy') THEN 'planner_strategy'
  WHEN contains(last_error, 'handshake') THEN 'ssl_timeout' WHEN contains(last_error, 'read operation timed out') THEN 'read_timeout'
  WHEN contains(last_error, 'Unable to create Python array') THEN 'nullable_violation'
  WHEN contains(last_error, 'unsupported operand type') THEN 'date_serialization' WHEN last_error = '' THEN 'empty_error' ELSE 'other' END"""


@query("a15_error_classes", f"""SELECT bucket, CAST(sum(n) AS BIGINT) AS units,
  array_to_string(list_slice(list(interface ORDER BY interface), 1, 5), ',') AS sample_interfaces
FROM (SELECT {BUCKET} AS bucket, interface, count(*) AS n FROM units WHERE status = 'failed' GROUP BY ALL) GROUP BY bucket""")
def _(t):
    return state.error_classes(t.state_log)


@query("a17_distinct_errors", "SELECT DISTINCT interface, status, last_error FROM units WHERE last_error <> ''")
def _(t):
    return state.distinct_errors(t.state_log)


@query("f6_retryable_units", "SELECT interface, scope_key, status, attempts FROM units WHERE status IN ('pending', 'partial', 'failed')")
def _(t):
    return state.retryable(t.state_log)


@query("f7_scopes_of_day", f"SELECT interface, status, count(*) AS units, {ROWS} FROM units WHERE scope_key LIKE '%20240115%' GROUP BY ALL")
def _(t):
    return state.scopes_of_day(t.state_log, "20240115")


LAST_OPEN = "(SELECT strftime(max(cal_date), '%Y%m%d') FROM load_cal WHERE is_open = 1 AND cal_date <= DATE '2024-01-31')"


@query("v12_freshness", f"""SELECT {LAST_OPEN} AS day, interface, status, count(*) AS units, {ROWS} FROM units
  WHERE contains(scope_key, {LAST_OPEN}) GROUP BY ALL""")
def _(t):
    return state.freshness(t.state_log, t.load_cal, as_day())


@query("w6_top_interfaces", "SELECT interface, status, count(*) AS units FROM units GROUP BY ALL ORDER BY units DESC, interface, status LIMIT 20")
def _(t):
    return state.top_interfaces(t.state_log)


@query("w6_top_rows", f"SELECT interface, {ROWS} FROM units WHERE status = 'done' GROUP BY interface ORDER BY total_rows DESC, interface LIMIT 15")
def _(t):
    return state.top_rows(t.state_log)


@query("w6_top_errors", f"""SELECT interface, count(*) AS errors FROM units WHERE status IN ('failed', 'partial')
  AND last_success_at > {NOW} - INTERVAL 1 DAY AND last_success_at <= {NOW} GROUP BY interface ORDER BY errors DESC, interface LIMIT 10""")
def _(t):
    return state.top_errors(t.state_log, as_of())


@query("j6_declared_without_state", "SELECT * FROM interfaces i WHERE NOT EXISTS (SELECT 1 FROM state_log s WHERE s.interface = i.interface)")
def _(t):
    return state.declared_without_state(t.interfaces, t.state_log)


COUNTS = """(SELECT interface, count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'partial') AS partial,
  count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(rows) AS BIGINT) AS total_rows,
  max(CASE WHEN status = 'done' THEN heartbeat_at END) AS last_sync FROM units GROUP BY interface)"""
WITH_COUNTS = f"""(SELECT i.*, coalesce(done, 0) AS done, coalesce(partial, 0) AS partial, coalesce(failed, 0) AS failed,
  coalesce(total_rows, 0) AS total_rows, last_sync FROM interfaces i LEFT JOIN {COUNTS} c ON c.interface = i.interface)"""


@query("j9_interfaces_with_state", f"SELECT interface, done, partial, failed, total_rows, last_sync FROM {WITH_COUNTS}")
def _(t):
    return state.with_state_counts(t.interfaces, t.state_log).select("interface", "done", "partial", "failed", "total_rows", "last_sync")


@query("q11_coverage_report", f"""SELECT interface, priority, CASE WHEN done > 0 AND partial = 0 AND failed = 0 THEN 'healthy' WHEN failed > 0 THEN 'failed'
  WHEN partial > 0 THEN 'partial' WHEN done = 0 THEN 'not_started' ELSE 'in_progress' END AS status, last_sync, total_rows, done, partial, failed
FROM {WITH_COUNTS} WHERE enabled""")
def _(t):
    return state.coverage_report(t.interfaces, t.state_log)


# Expected scopes ---------------------------------------------------------------------------------

DAY = "DATE '2024-01-31'"
OPEN_DAYS = f"""(SELECT i.*, c.cal_date, strftime(c.cal_date, '%Y%m%d') AS d FROM interfaces i JOIN load_cal c ON c.exchange = i.exchange
  AND c.is_open = 1 AND c.cal_date BETWEEN i.start_date AND {DAY})"""
QUARTERS = f"""(SELECT i.*, strftime(q, '%Y%m%d') AS p FROM (SELECT *, unnest(generate_series(date_trunc('quarter', start_date), {DAY}, INTERVAL 3 MONTH))
  AS q0 FROM interfaces) i, LATERAL (SELECT CAST(q0 + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q) x WHERE q BETWEEN start_date AND {DAY})"""
MONTHS = f"""(SELECT *, strftime(unnest(generate_series(date_trunc('month', start_date), {DAY}, INTERVAL 1 MONTH)), '%Y%m') AS m FROM interfaces)"""
PAGES = f"""(SELECT o.interface, o.strategy, o.d, unnest(generate_series(0, greatest(CAST(ceil(coalesce(r.n, 0) / 5) AS BIGINT), 1) - 1)) * 5 AS off
  FROM {OPEN_DAYS} o LEFT JOIN (SELECT interface, CAST(heartbeat_at AS DATE) AS day, count(*) AS n FROM state_log GROUP BY ALL) r
  ON r.interface = o.interface AND r.day = o.cal_date WHERE o.strategy = 'offset_paging')"""
UNITS = {
    "full_once": "SELECT interface, strategy, interface || ':full' AS scope_key, '' AS params FROM interfaces WHERE strategy = 'full_once'",
    "date_loop": f"""SELECT interface, strategy, interface || ':' || d AS scope_key, coalesce(date_field, 'trade_date') || '=' || d AS params
      FROM {OPEN_DAYS} WHERE strategy = 'date_loop'""",
    "period_loop": f"SELECT interface, strategy, interface || ':' || p AS scope_key, 'period=' || p AS params FROM {QUARTERS} WHERE strategy = 'period_loop'",
    "monthly_window": f"SELECT interface, strategy, interface || ':' || m AS scope_key, 'month=' || m AS params FROM {MONTHS} WHERE strategy = 'monthly_window'",
    "per_symbol": f"""SELECT interface, strategy, interface || ':' || ts_code AS scope_key,
      CASE WHEN start_date = {DAY} AND date_field IS NOT NULL THEN list_aggregate(list_sort(['ts_code=' || ts_code, date_field || '=20240131']), 'string_agg', '&')
        ELSE 'ts_code=' || ts_code END AS params
      FROM interfaces JOIN symbols USING (symbol_source) WHERE strategy = 'per_symbol'""",
    "per_symbol_period": f"""SELECT interface, strategy, interface || ':' || ts_code || ':' || p AS scope_key, 'period=' || p || '&ts_code=' || ts_code AS params
      FROM {QUARTERS} q JOIN symbols USING (symbol_source) WHERE strategy = 'per_symbol_period'""",
    "offset_paging": f"""SELECT interface, strategy, interface || ':' || d || ':' || lpad(CAST(off AS VARCHAR), 8, '0') AS scope_key,
      'limit=5&offset=' || off || '&trade_date=' || d AS params FROM {PAGES}""",
}
ALL_UNITS = "(" + " UNION ALL ".join(UNITS.values()) + ")"


def _text(df):
    """Parameter maps as sorted text, so that results compare across engines."""
    pairs = F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return df.withColumn("params", F.array_join(F.array_sort(pairs), "&"))


def _day_rows(t):
    return t.state_log.groupBy("interface", F.col("heartbeat_at").cast("date").alias("trade_date")).agg(F.count(F.lit(1)).alias("row_count"))


def _expected(t):
    return scopes.expected_units(t.interfaces, t.load_cal, t.symbols, _day_rows(t), as_day(), page_size=5)


@query("p2_date_loop", UNITS["date_loop"])
def _(t):
    return _text(scopes.date_loop(t.interfaces, t.load_cal, as_day()))


@query("p3_period_loop", UNITS["period_loop"])
def _(t):
    return _text(scopes.period_loop(t.interfaces, as_day()))


@query("p4_monthly_window", UNITS["monthly_window"])
def _(t):
    return _text(scopes.monthly_window(t.interfaces, as_day()))


@query("p5_per_symbol", UNITS["per_symbol"])
def _(t):
    return _text(scopes.per_symbol(t.interfaces, t.symbols, as_day()))


@query("p6_per_symbol_period", UNITS["per_symbol_period"])
def _(t):
    return _text(scopes.per_symbol_period(t.interfaces, t.symbols, as_day()))


@query("j7_symbols_by_quarters", f"""SELECT ts_code, CAST(q + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter
  FROM (SELECT DISTINCT ts_code FROM symbols), generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-10-01', INTERVAL 3 MONTH) g(q)""")
def _(t):
    day = lambda d: F.lit(d).cast("date")
    return t.symbols.select("ts_code").distinct().select(
        "ts_code", F.explode(quarter_ends(day("1995-01-01"), day("2001-12-31"))).alias("quarter"))


@query("p7_offset_paging", UNITS["offset_paging"])
def _(t):
    return _text(scopes.offset_paging(t.interfaces, t.load_cal, _day_rows(t), as_day(), page_size=5))


@query("p8_expected_units", f"SELECT * FROM {ALL_UNITS}")
def _(t):
    return _text(_expected(t))


OPEN_UNITS = "(SELECT interface, scope_key, status, attempts FROM units WHERE status IN ('pending', 'partial', 'failed'))"


@query("j4_retryable_planned", f"SELECT * FROM {ALL_UNITS} p WHERE EXISTS (SELECT 1 FROM {OPEN_UNITS} o WHERE o.interface = p.interface AND o.scope_key = p.scope_key)")
def _(t):
    return _text(state.resume_set(_expected(t), t.state_log)[0])


@query("j5_orphan_units", f"SELECT * FROM {OPEN_UNITS} o WHERE NOT EXISTS (SELECT 1 FROM {ALL_UNITS} p WHERE o.interface = p.interface AND o.scope_key = p.scope_key)")
def _(t):
    return state.resume_set(_expected(t), t.state_log)[1]


@query("p10_resume_summary", f"""SELECT CASE WHEN p.scope_key IS NULL THEN 'orphan' ELSE 'resume' END AS action, o.status, count(*) AS units
  FROM {OPEN_UNITS} o LEFT JOIN {ALL_UNITS} p ON o.interface = p.interface AND o.scope_key = p.scope_key GROUP BY ALL""")
def _(t):
    return state.resume_actions(_expected(t), t.state_log).groupBy("action", "status").agg(F.count(F.lit(1)).alias("units"))


@query("p11_reset_failed", """SELECT interface, scope_key, 'pending' AS status, CAST(0 AS BIGINT) AS rows, TIMESTAMP '1970-01-01' AS last_success_at,
  TIMESTAMP '1970-01-01' AS heartbeat_at, attempts + 1 AS attempts, '' AS last_error, _version + 1000000000000 AS _version
  FROM units WHERE status = 'failed'""")
def _(t):
    return state.reset_failed(t.state_log, F.col("_version") + 1_000_000_000_000)


@query("t1_month_and_hour", """SELECT CAST(year(started_at) * 100 + month(started_at) AS INTEGER) AS month_no, date_trunc('minute', started_at) AS minute,
  date_trunc('hour', started_at) AS hour, CAST(started_at AS DATE) AS day, started_at - INTERVAL 8 HOUR AS shifted, count(*) AS calls
  FROM api_calls GROUP BY ALL""")
def _(t):
    at = F.col("started_at")
    return t.api_calls.groupBy(
        month_number(at).alias("month_no"), F.date_trunc("minute", at).cast("timestamp_ntz").alias("minute"),
        F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour"), at.cast("date").alias("day"),
        (at - F.expr("interval 8 hours")).alias("shifted")).agg(F.count(F.lit(1)).alias("calls"))


SPANS = "(SELECT ts_code, min(ann_date) AS lo, max(ann_date) AS hi FROM financials GROUP BY ts_code)"


def _spans(t):
    return t.financials.groupBy("ts_code").agg(F.min("ann_date").alias("lo"), F.max("ann_date").alias("hi"))


@query("t2_quarter_list", f"""SELECT ts_code, q AS quarter FROM (SELECT ts_code, lo, hi,
  CAST(unnest(generate_series(date_trunc('quarter', lo), hi, INTERVAL 3 MONTH)) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q FROM {SPANS})
  WHERE q BETWEEN lo AND hi""")
def _(t):
    return _spans(t).select("ts_code", F.explode(quarter_ends(F.col("lo"), F.col("hi"))).alias("quarter"))


@query("t3_month_list", f"SELECT ts_code, CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS month FROM {SPANS}")
def _(t):
    return _spans(t).select("ts_code", F.explode(months_between(F.col("lo"), F.col("hi"))).alias("month"))


@query("t4_text_functions", """SELECT interface, scope_key, substr(last_error, 1, 20) AS head, replace(CAST(CAST(heartbeat_at AS DATE) AS VARCHAR), '-', '') AS day,
  lpad(CAST(rows AS VARCHAR), 8, '0') AS padded, lower(trim(last_error)) AS folded, _version FROM state_log""")
def _(t):
    return t.state_log.select(
        "interface", "scope_key", F.substring("last_error", 1, 20).alias("head"),
        F.replace(F.col("heartbeat_at").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("day"),
        F.lpad(F.col("rows").cast("string"), 8, "0").alias("padded"), F.lower(F.trim("last_error")).alias("folded"), "_version")
