"""Scans, joins, version resolution and market queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import checks
from ..functions.dates import is_day_text
from ..model import ADJ_FACTOR, BARS, FINANCIALS, INDEX_WEIGHT, MONEYFLOW, STATE
from ..operators import calendar, market, state, versions
from ..sources import tables
from ..session import scratch_path
from ..sources.sql_gate import query_sql
from .oracle_tables import code
from .registry import query

BAR_LIST = "ts_code, trade_date, open, high, low, close, vol, amount, pct_chg"
ADJUSTED = """SELECT b.ts_code, b.trade_date, round(b.open * f.adj_factor{base}, 4) AS open, round(b.high * f.adj_factor{base}, 4) AS high,
  round(b.low * f.adj_factor{base}, 4) AS low, round(b.close * f.adj_factor{base}, 4) AS close, b.vol, b.amount, b.pct_chg
FROM bars_now b JOIN adj_now f ON b.ts_code = f.ts_code AND b.trade_date = f.trade_date {latest}"""
LATEST = "JOIN (SELECT ts_code, arg_max(adj_factor, trade_date) AS latest FROM adj_now GROUP BY ts_code) l ON l.ts_code = b.ts_code"


@query("q1_ohlcv_raw", f"SELECT {BAR_LIST} FROM bars_now")
def _(t):
    return market.ohlcv(t.bars, adjust="none")


@query("q2_ohlcv_qfq", ADJUSTED.format(base=" / l.latest", latest=LATEST))
def _(t):
    return market.ohlcv(t.bars, t.adj_factor, adjust="qfq")


@query("q3_ohlcv_hfq", ADJUSTED.format(base="", latest=""))
def _(t):
    return market.ohlcv(t.bars, t.adj_factor, adjust="hfq")


@query("q4_financials", "SELECT * FROM fin_now")
def _(t):
    return market.financials(t.financials)


@query("q5_index_components", "SELECT * FROM index_now")
def _(t):
    return market.index_components(t.index_weight)


@query("q6_moneyflow", "SELECT * FROM flow_now")
def _(t):
    return market.moneyflow(t.moneyflow)


# A range inside the calendar, so that a bound that is not applied shows.
RANGE = ("19950301", "1996-11-30")
IN_RANGE = "cal_date BETWEEN DATE '1995-03-01' AND DATE '1996-11-30'"


@query("q7_trade_calendar", f"SELECT cal_date, is_open, pretrade_date FROM trade_cal WHERE exchange = 'SZSE' AND {IN_RANGE}")
def _(t):
    return calendar.trade_calendar(t.trade_cal, *RANGE, exchange="SZSE")


@query("q9_latest_trade_date", "SELECT max(cal_date) AS trade_date FROM trade_cal WHERE is_open = 1 AND cal_date <= DATE '2001-11-05'")
def _(t):
    return calendar.latest_trade_date(t.trade_cal, "20011105")


@query("q10_trade_dates", f"SELECT DISTINCT cal_date FROM trade_cal WHERE is_open = 1 AND {IN_RANGE}")
def _(t):
    return calendar.trade_dates(t.trade_cal, *RANGE)


@query("q12_symbols", "SELECT DISTINCT ts_code FROM bars")
def _(t):
    return market.symbols(t.trades)


REQUESTS = f"""(SELECT {code('s_suppkey')} AS ts_code, DATE '1995-06-01' + CAST(s_nationkey * 30 AS INTEGER) AS start_date,
  DATE '2000-06-01' - CAST(s_nationkey * 20 AS INTEGER) AS end_date FROM supplier)"""


@query("s1_scan", f"SELECT b.* FROM bars b JOIN {REQUESTS} r ON b.ts_code = r.ts_code AND b.trade_date BETWEEN r.start_date AND r.end_date")
def _(t):
    from ..sources.domain import security_code

    requests = t.raw("supplier").select(
        security_code(F.col("s_suppkey")).alias("ts_code"),
        F.date_add(F.lit("1995-06-01").cast("date"), (F.col("s_nationkey") * 30).cast("int")).alias("start_date"),
        F.date_sub(F.lit("2000-06-01").cast("date"), (F.col("s_nationkey") * 20).cast("int")).alias("end_date"),
    )
    return tables.scan_requests(t.bars, requests)


@query("f5_range_and_period_filter", """SELECT * FROM fin_now WHERE statement = 'fina_indicator' AND ann_date BETWEEN DATE '1996-01-01'
  AND DATE '2000-12-31' AND end_date IN (DATE '1996-12-31', DATE '1997-12-31', DATE '1998-12-31', DATE '1999-12-31')""")
def _(t):
    rows = market.financials(t.financials, statement="fina_indicator", periods=["19961231", "19971231", "19981231", "19991231"])
    return rows.filter(F.col("ann_date").between("1996-01-01", "2000-12-31"))


@query("j1_bars_with_factor", "SELECT b.ts_code, b.trade_date, b.close, f.adj_factor FROM bars_now b JOIN adj_now f USING (ts_code, trade_date)")
def _(t):
    bars = versions.current(t.bars.select(*BARS.keys, "close", BARS.version), BARS.keys).drop(BARS.version)
    factors = versions.current(t.adj_factor, ADJ_FACTOR.keys).drop(ADJ_FACTOR.version)
    return bars.join(factors, list(BARS.keys))


def _bucketed(t, df, spec):
    """The log as a table of its own, in as many buckets as shuffles have partitions."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return tables.append_bucketed(df, f"quotemill_{uuid.uuid4().hex}", spec, buckets)


@query("d1_bucketed_current", "SELECT * FROM bars_now")
def _(t):
    return versions.current(_bucketed(t, t.bars, BARS), BARS.keys)


@query("j1_bucketed_factor_join", "SELECT b.ts_code, b.trade_date, b.close, f.adj_factor FROM bars_now b JOIN adj_now f USING (ts_code, trade_date)")
def _(t):
    bars = versions.current(_bucketed(t, t.bars, BARS).select(*BARS.keys, "close", BARS.version), BARS.keys).drop(BARS.version)
    factors = versions.current(_bucketed(t, t.adj_factor, ADJ_FACTOR), ADJ_FACTOR.keys).drop(ADJ_FACTOR.version)
    return bars.join(factors, list(BARS.keys))


@query("j2_latest_factor_join", f"SELECT b.ts_code, b.trade_date, b.close, l.latest AS latest_factor FROM bars_now b {LATEST}")
def _(t):
    bars = versions.current(t.bars.select(*BARS.keys, "close", BARS.version), BARS.keys).drop(BARS.version)
    factors = versions.current(t.adj_factor, ADJ_FACTOR.keys)
    latest = market.latest_per_key(factors, "ts_code", "trade_date", "adj_factor")
    return bars.join(latest.select("ts_code", F.col("adj_factor").alias("latest_factor")), "ts_code")


@query("m1_adjusted_close", "SELECT ts_code, trade_date, round(close * adj_factor, 4) AS adj_close FROM bars_now JOIN adj_now USING (ts_code, trade_date)")
def _(t):
    return market.ohlcv(t.bars, t.adj_factor, adjust="hfq").select("ts_code", "trade_date", F.col("close").alias("adj_close"))


@query("w1_latest_row_per_key", "SELECT ts_code, max(trade_date) AS trade_date, arg_max(adj_factor, trade_date) AS adj_factor FROM adj_now GROUP BY ts_code")
def _(t):
    return market.latest_per_key(versions.current(t.adj_factor, ADJ_FACTOR.keys), "ts_code", "trade_date", "adj_factor")


@query("w3_previous_open_day", "SELECT * FROM trade_cal")
def _(t):
    return t.trade_cal


@query("w5_bars_by_day", f"SELECT {BAR_LIST} FROM bars_now ORDER BY trade_date DESC, ts_code")
def _(t):
    return market.by_day(market.ohlcv(t.bars, adjust="none"), descending=True)


@query("d1_current", "SELECT * FROM bars_now")
def _(t):
    return versions.current(t.bars, BARS.keys)


#: What is added to versions that arrive late, and taken off again.
LATE = 10**15


@query("d2_compact", "SELECT *, CAST(year(trade_date) * 100 + month(trade_date) AS INTEGER) AS _month FROM bars_now")
def _(t):
    placed, month = tables.with_month(t.bars, "trade_date")
    return versions.compact(t.spark, placed, BARS.keys, month)


@query("d2_touched_months", "SELECT *, CAST(year(trade_date) * 100 + month(trade_date) AS INTEGER) AS _month FROM bars_now")
def _(t):
    # The last version of each day arrives after the others are compacted: only its months are compacted again.
    path, last = scratch_path(t.spark, "bars"), F.col("_version") % 86_400_000 == 3
    tables.append(t.bars.filter(~last), path, BARS)
    versions.compact_months(t.spark, path, BARS.keys, tables.MONTH, -1)
    table = tables.open_table(t.spark, path)
    tables.append(t.bars.filter(last).withColumn("_version", F.col("_version") + LATE), path, BARS)
    versions.compact_months(t.spark, path, BARS.keys, tables.MONTH, LATE)
    version = F.when(F.col("_version") > LATE, F.col("_version") - LATE).otherwise(F.col("_version"))
    return tables.open_table(t.spark, path, table.schema).withColumn("_version", version)


@query("s1_month_scan", "SELECT * FROM bars WHERE ts_code IN (SELECT max(ts_code) FROM bars) AND trade_date BETWEEN DATE '1995-03-10' AND DATE '1997-02-20'")
def _(t):
    path = scratch_path(t.spark, "bars")
    tables.append(t.bars, path, BARS)
    table = tables.open_table(t.spark, path, tables.with_month(t.bars, "trade_date")[0].schema)
    last = table.agg(F.max("ts_code")).first()[0]
    return tables.scan(table, last, "19950310", "19970220")


@query("d3_idempotent_upsert", "SELECT * FROM bars_now")
def _(t):
    # Replaying the whole log must not change the current rows.
    return versions.current(t.bars.unionByName(t.bars), BARS.keys)


@query("d3_replay_changes", "SELECT ts_code, trade_date, close FROM bars WHERE false")
def _(t):
    log = t.bars.select("ts_code", "trade_date", "close", "_version")
    replay = versions.with_version(log, F.col("_version") + 10)
    return versions.replay_changes(log, replay, BARS.keys)


SCOPES = f"""(SELECT {code('s_suppkey')} AS ts_code, CASE WHEN s_nationkey > 5 THEN DATE '1998-03-02' + CAST(s_nationkey AS INTEGER) END AS trade_date
  FROM supplier WHERE s_acctbal < 3000
  UNION ALL SELECT NULL, last_day(CAST(ts AS DATE)) - INTERVAL 9000 DAY FROM events
  UNION ALL SELECT NULL, NULL FROM region)"""


def _scopes(t):
    from ..sources.domain import security_code

    nation = F.col("s_nationkey")
    day = F.when(nation > 5, F.date_add(F.lit("1998-03-02").cast("date"), nation))
    by_code = t.raw("supplier").filter("s_acctbal < 3000").select(
        security_code(F.col("s_suppkey")).alias("ts_code"), day.alias("trade_date"))
    by_day = t.raw("events").select(F.lit(None).cast("string").alias("ts_code"),
                                    F.date_sub(F.last_day(F.col("ts").cast("date")), 9000).alias("trade_date"))
    nothing = t.raw("region").select(F.lit(None).cast("string").alias("ts_code"), F.lit(None).cast("date").alias("trade_date"))
    return by_code.unionByName(by_day).unionByName(nothing)


@query("d4_delete_scopes", f"""SELECT b.* FROM bars b WHERE NOT EXISTS (SELECT 1 FROM {SCOPES} s
  WHERE (s.ts_code IS NOT NULL OR s.trade_date IS NOT NULL) AND (s.ts_code IS NULL OR s.ts_code = b.ts_code)
    AND (s.trade_date IS NULL OR CAST(s.trade_date AS DATE) = b.trade_date))""")
def _(t):
    return versions.delete_scopes(t.bars, _scopes(t))


@query("f8_scope_period_match", """SELECT f.* FROM financials f WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT ts_code, end_date FROM financials
  WHERE statement = 'income') u WHERE u.ts_code = f.ts_code AND strftime(u.end_date, '%Y%m') = strftime(f.end_date, '%Y%m'))""")
def _(t):
    units = t.financials.filter("statement = 'income'").select(
        "ts_code", F.date_format("end_date", "yyyyMMdd").alias("period")).distinct()
    return versions.within_scopes(t.financials, units)


VERSIONED = {"bars": "ts_code, trade_date", "adj_factor": "ts_code, trade_date", "moneyflow": "ts_code, trade_date",
             "financials": "statement, ts_code, end_date", "index_weight": "index_code, con_code, trade_date",
             "state_log": "interface, scope_key"}


def _versioned(t):
    return {"bars": (t.bars, BARS), "adj_factor": (t.adj_factor, ADJ_FACTOR), "moneyflow": (t.moneyflow, MONEYFLOW),
            "financials": (t.financials, FINANCIALS), "index_weight": (t.index_weight, INDEX_WEIGHT),
            "state_log": (t.state_log, STATE)}


def each(template: str) -> str:
    return "\nUNION ALL ".join(template.format(t=name, k=keys) for name, keys in VERSIONED.items())


@query("d5_duplicate_ratio", "SELECT *, row_count / CAST(key_count AS DOUBLE) AS dup_ratio FROM ("
       + each("SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT ({k})) AS key_count FROM {t}") + ")")
def _(t):
    return versions.duplicate_ratio({n: (df, spec.keys) for n, (df, spec) in _versioned(t).items()})


@query("d6_version_history", """SELECT interface, scope_key, status, _version,
  row_number() OVER (PARTITION BY interface, scope_key ORDER BY _version DESC) AS version_rank FROM state_log""")
def _(t):
    return versions.history(t.state_log.select("interface", "scope_key", "status", "_version"), STATE.keys)


@query("d7_delete_state", """SELECT interface, scope_key, status, _version FROM state_log
  WHERE NOT ((interface IN ('if_3_date_loop', 'if_4_per_symbol') OR starts_with(interface, 'if_1')) AND status <> 'done')""")
def _(t):
    doomed = state.doomed_units(["if_3_date_loop", "if_4_per_symbol"], ["if_1"], not_done=True)
    return versions.delete_where(t.state_log, doomed)[0].select("interface", "scope_key", "status", "_version")


@query("d7_dry_run", "SELECT status, count(*) AS doomed FROM state_log WHERE status IN ('failed', 'running') GROUP BY status")
def _(t):
    return versions.delete_where(t.state_log, state.doomed_units(statuses=["failed", "running"]))[1]


@query("s6_versioned_append", "SELECT ts_code, trade_date, close, CAST(1714000000000 AS BIGINT) AS _version FROM bars_now")
def _(t):
    path = scratch_path(t.spark, "append")
    rows = market.ohlcv(t.bars, adjust="none").select("ts_code", "trade_date", "close")
    tables.append(rows, path, BARS, 1_714_000_000_000)
    return tables.read(t.spark, path)


@query("s9_month_placement", """SELECT CAST(year(trade_date) * 100 + month(trade_date) AS INTEGER) AS _month, count(*) AS row_count, min(trade_date) AS first_day,
  max(trade_date) AS last_day FROM bars GROUP BY 1""")
def _(t):
    placed, month = tables.with_month(t.bars, "trade_date")
    return placed.groupBy(month).agg(F.count(F.lit(1)).alias("row_count"), F.min("trade_date").alias("first_day"),
                                     F.max("trade_date").alias("last_day"))


@query("s8_json_records", """SELECT '{"statement":"' || statement || '","ts_code":"' || ts_code || '","end_date":"' || end_date || '","ann_date":"'
  || ann_date || '","version":' || _version || '}' AS record FROM fin_now""")
def _(t):
    rows = market.financials(t.financials).select("statement", "ts_code", "end_date", "ann_date", F.col("_version").alias("version"))
    return tables.json_records(rows)


@query("f11_guarded_sql", """SELECT ts_code, count(*) AS days, max(close) AS top FROM bars_now WHERE trade_date >= DATE '1997-01-01' GROUP BY ts_code""")
def _(t):
    text = """WITH b AS (SELECT * FROM bars_now WHERE trade_date >= :start)
              SELECT ts_code, count(*) AS days, max(close) AS top FROM b GROUP BY ts_code"""
    import datetime

    return query_sql(t.spark, text, {"start": datetime.date(1997, 1, 1)}, {"bars_now": versions.current(t.bars, BARS.keys)})


CANDIDATES = f"""(SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN {code('c_custkey')} WHEN 'HOUSEHOLD' THEN c_name
    WHEN 'MACHINERY' THEN lower({code('c_custkey')}) WHEN 'BUILDING' THEN {code('c_custkey')} ELSE c_custkey || '.SH' END AS ts_code,
  CASE WHEN c_nationkey < 12 THEN '2024' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '30' ELSE '2024-01-0' || (c_nationkey % 10) END AS day,
  CASE WHEN c_acctbal < 0 THEN 'NYSE' ELSE 'SZSE' END AS exchange FROM customer)"""
REASONS = f"""SELECT *, CASE WHEN NOT regexp_full_match(ts_code, '[0-9]{{6}}\\.(SH|SZ|BJ)') THEN 'bad_code'
  WHEN NOT regexp_full_match(day, '[0-9]{{8}}') THEN 'bad_date_shape'
  WHEN exchange NOT IN ('SSE', 'SZSE', 'BSE', 'CFFEX', 'SHFE', 'DCE', 'CZCE') THEN 'bad_exchange' END AS reason FROM {CANDIDATES}"""


def _candidates(t):
    from ..sources.domain import security_code

    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    good = security_code(key)
    text = (
        F.when(segment.isin("FURNITURE", "BUILDING"), good).when(segment == "HOUSEHOLD", F.col("c_name"))
        .when(segment == "MACHINERY", F.lower(good)).otherwise(F.concat(key.cast("string"), F.lit(".SH")))
    )
    day = F.when(nation < 12, F.concat(F.lit("2024"), F.lpad(nation.cast("string"), 2, "0"), F.lit("30"))).otherwise(
        F.concat(F.lit("2024-01-0"), (nation % 10).cast("string")))
    return t.raw("customer").select("c_custkey", text.alias("ts_code"), day.alias("day"),
                                    F.when(F.col("c_acctbal") < 0, "NYSE").otherwise("SZSE").alias("exchange"))


def _rules():
    return {"bad_code": checks.is_code(F.col("ts_code")), "bad_date_shape": checks.is_date_shape(F.col("day")),
            "bad_exchange": checks.is_exchange(F.col("exchange"))}


@query("f1_valid_rows", f"SELECT * EXCLUDE (reason) FROM ({REASONS}) WHERE reason IS NULL")
def _(t):
    return checks.split_valid(_candidates(t), _rules())[0]


@query("f1_rejected_rows", f"SELECT * FROM ({REASONS}) WHERE reason IS NOT NULL")
def _(t):
    return checks.split_valid(_candidates(t), _rules())[1]


@query("f3_strict_dates", f"""SELECT c_custkey, day, regexp_full_match(day, '[0-9]{{8}}') AND try_strptime(day, '%Y%m%d') IS NOT NULL AS is_day
  FROM {CANDIDATES}""")
def _(t):
    return _candidates(t).select("c_custkey", "day", is_day_text(F.col("day")).alias("is_day"))
