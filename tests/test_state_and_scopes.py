import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill.operators import scopes, state
from quotemill.operators.versions import current

from .conftest import rows

LOG_SCHEMA = ("interface string, scope_key string, status string, rows bigint, last_success_at timestamp_ntz, heartbeat_at timestamp_ntz, "
              "attempts int, last_error string, _version bigint")
T0 = dt.datetime(2024, 1, 10, 12)


def unit(interface, scope, status, version=1, n=1, at=T0, attempts=0, error=""):
    return (interface, scope, status, n, at if status == "done" else dt.datetime(1970, 1, 1), at, attempts, error, version)


@pytest.fixture
def log(spark):
    return spark.createDataFrame([
        unit("daily", "daily:20240109", "failed", 1), unit("daily", "daily:20240109", "done", 2, 50), unit("daily", "daily:20240110", "running", 1),
        unit("income", "income:20231231", "failed", 1, error="SSL handshake failed", attempts=2), unit("income", "income:20230930", "done", 1, 9),
        unit("basic", "basic:full", "partial", 1), unit("calls", "calls:full", "done", 1, 3),
    ], LOG_SCHEMA)


@pytest.fixture
def interfaces(spark):
    names = ["daily", "income", "basic", "calls", "never"]
    return spark.createDataFrame([(n, f"t_{n}", "P0" if n == "daily" else "P1", n != "calls" or True) for n in names],
                                 "interface string, table_name string, priority string, enabled boolean")


def test_coverage_rules(interfaces, log):
    got = {r["interface"]: (r["status"], r["total_rows"], r["done"]) for r in state.coverage_report(interfaces, log).collect()}
    assert got == {"daily": ("healthy", 51, 1), "income": ("failed", 10, 1), "basic": ("partial", 1, 0), "calls": ("healthy", 3, 1),
                   "never": ("not_started", 0, 0)}
    assert state.coverage_report(interfaces, log, priority="p0").count() == 1
    assert state.coverage_report(interfaces, log, interface="never").first()["last_sync"] is None
    with pytest.raises(ValueError):
        state.coverage_report(interfaces, log, priority="P9")


def test_old_versions_do_not_count(log):
    assert rows(state.by_status(log)) == [("done", 3, 62), ("failed", 1, 1), ("partial", 1, 1), ("running", 1, 1)]
    assert state.interface_status(log, "daily").count() == 2
    assert rows(state.retryable(log).select("scope_key")) == [("basic:full",), ("income:20231231",)]


def test_totals_row(log):
    got = state.with_totals(log).filter("is_total").collect()
    assert [(r["interface"], r["units"]) for r in got] == [(None, 6)]


def test_pivot_flags(log):
    assert {r["interface"]: r["flag"] for r in state.status_pivot(log).collect()} == {"daily": "", "income": "***", "basic": "~~~", "calls": ""}


def test_error_classes(spark):
    texts = ["Unrecognized column z", "Unknown strategy: q", "handshake", "the read operation timed out", "Unable to create Python array",
             "unsupported operand type", "", "odd"]
    log = spark.createDataFrame([unit(f"i{j}", f"i{j}:{k}", "failed", error=e) for k, e in enumerate(texts) for j in range(7)], LOG_SCHEMA)
    got = {r["bucket"]: (r["units"], r["sample_interfaces"]) for r in state.error_classes(log).collect()}
    assert set(got) == {"schema_drift", "planner_strategy", "ssl_timeout", "read_timeout", "nullable_violation", "date_serialization", "empty_error", "other"}
    assert set(got.values()) == {(7, "i0,i1,i2,i3,i4")}


def test_run_outcomes(spark):
    df = spark.createDataFrame([("a", "done", T0), ("a", "done", T0), ("b", "done", T0), ("b", "failed", T0), ("c", "failed", T0)],
                               "run_id string, status string, started_at timestamp_ntz")
    assert {r["run_id"]: r["status"] for r in state.run_outcomes(df).collect()} == {"a": "done", "b": "partial", "c": "failed"}
    assert [r["run_id"] for r in state.recent_runs(state.run_outcomes(df), 2).collect()] == ["a", "b"]


def test_reset_and_resume(log, spark):
    after = current(log.unionByName(state.reset_failed(log, 100)), ["interface", "scope_key"])
    row = after.filter("scope_key = 'income:20231231'").first()
    assert (row["status"], row["attempts"], row["last_error"], row["rows"], row["_version"]) == ("pending", 3, "", 0, 100)
    planned = spark.createDataFrame([("income", "income:20231231"), ("daily", "daily:20240109")], "interface string, scope_key string")
    keep, orphans = state.resume_set(planned, log)
    assert rows(keep) == [("income", "income:20231231")] and rows(orphans.select("scope_key")) == [("basic:full",)]


def test_a_reset_sees_the_row_that_the_counts_see(spark):
    tied = spark.createDataFrame([unit("a", f"a:{k // 2}", ("failed", "done")[k % 2], 1, n=k, error=f"e{k}") for k in range(80)], LOG_SCHEMA)
    counted = {r["status"]: r["units"] for r in state.by_status(tied).collect()}
    assert 0 < counted["failed"] < 40 and state.reset_failed(tied, 2).count() == counted["failed"]


def test_stale_units(log):
    as_of = F.lit("2024-01-10 12:10:01").cast("timestamp_ntz")
    assert [(r["scope_key"], r["status"], r["last_error"]) for r in state.stale_units(log, as_of).collect()] == [("daily:20240110", "partial", "heartbeat timeout")]
    assert state.stale_units(log, F.lit("2024-01-10 12:10:00").cast("timestamp_ntz")).count() == 0


def test_doomed_units(log):
    hit = lambda **k: sorted({r["scope_key"] for r in log.filter(state.doomed_units(**k)).collect()})
    assert hit(interfaces=["daily"], not_done=True) == ["daily:20240109", "daily:20240110"]
    assert hit(prefixes=["ca", "ba"]) == ["basic:full", "calls:full"]
    assert hit(statuses=["running"]) == ["daily:20240110"] and hit() == []


STRATEGIES = ("full_once", "date_loop", "period_loop", "monthly_window", "per_symbol", "per_symbol_period", "offset_paging")


def test_scope_keys_of_every_strategy(spark, declared):
    cal = spark.createDataFrame([("SSE", dt.date(2023, 7, 3), 1), ("SSE", dt.date(2023, 7, 4), 0)], "exchange string, cal_date date, is_open int")
    symbols = spark.createDataFrame([("stock", "000001.SZ")], "symbol_source string, ts_code string")
    counts = spark.createDataFrame([("i_offset_paging", dt.date(2023, 7, 3), 5001)], "interface string, trade_date date, row_count long")
    got = scopes.expected_units(declared, cal, symbols, counts, F.lit("2023-07-31").cast("date"))
    keys = {}
    for r in got.collect():
        keys.setdefault(r["strategy"], []).append(r["scope_key"].removeprefix(f"i_{r['strategy']}:"))
    assert {k: sorted(v) for k, v in keys.items()} == {
        "full_once": ["full"], "date_loop": ["20230703"], "period_loop": ["20230630"], "monthly_window": ["202306", "202307"], "per_symbol": ["000001.SZ"],
        "per_symbol_period": ["000001.SZ:20230630"], "offset_paging": ["20230703:00000000", "20230703:00005000"]}


def test_top_errors_need_a_recent_success(spark):
    log = spark.createDataFrame([
        unit("a", "a:1", "failed", 1), unit("a", "a:2", "partial", 1), unit("b", "b:1", "failed", 1), unit("c", "c:1", "failed", 1), unit("c", "c:1", "done", 2)], LOG_SCHEMA)
    log = log.withColumn("last_success_at", F.when(F.col("interface") == "b", F.lit("2024-01-01")).otherwise(F.lit("2024-01-09 12:00:00")).cast("timestamp_ntz"))
    assert rows(state.top_errors(log, F.lit("2024-01-10").cast("timestamp_ntz"))) == [("a", 2)]


def test_queries_agree_on_a_tied_version(spark):
    log = spark.createDataFrame([unit("i", f"i:{k}", s, 1, error=e) for k in range(40) for s, e in (("done", None), ("failed", "SSL handshake failed"))], LOG_SCHEMA)
    failed = {r["status"]: r["units"] for r in state.by_status(log).collect()}.get("failed", 0)
    assert sum(r["scope_key"] is not None for r in state.units(log, "last_error").filter("last_error LIKE 'SSL%'").collect()) == failed


@pytest.fixture
def declared(spark):
    df = spark.createDataFrame([(f"i_{s}", s, "SSE", None, "stock", dt.date(2023, 6, 1)) for s in STRATEGIES],
                               "interface string, strategy string, exchange string, date_field string, symbol_source string, start_date date")
    return df.withColumn("date_field", F.when(F.col("strategy") == "per_symbol", "ann_date"))


def test_symbols_times_quarters(spark, declared):
    symbols = spark.createDataFrame([("stock", "A"), ("stock", "B"), ("fund", "C")], "symbol_source string, ts_code string")
    day = lambda s: F.lit(s).cast("date")
    got = scopes.per_symbol_period(declared, symbols, day("2024-01-15")).collect()
    assert sorted(r["scope_key"].split(":", 1)[1] for r in got) == sorted(f"{c}:{q}" for c in "AB" for q in ("20230630", "20230930", "20231231"))
    whole = scopes.per_symbol(declared, symbols, day("2024-01-15")).collect()
    assert [r["params"] for r in whole if r["scope_key"].endswith(":A")] == [{"ts_code": "A"}]
    single = scopes.per_symbol(declared, symbols, day("2023-06-01")).collect()
    assert [r["params"] for r in single if r["scope_key"].endswith(":A")] == [{"ts_code": "A", "ann_date": "20230601"}]


def test_pages_follow_row_counts(spark, declared):
    cal = spark.createDataFrame([("SSE", dt.date(2024, 1, d), int(d != 6)) for d in (4, 5, 6)], "exchange string, cal_date date, is_open int")
    counts = spark.createDataFrame([("i_offset_paging", dt.date(2024, 1, 4), 12000)], "interface string, trade_date date, row_count bigint")
    got = scopes.offset_paging(declared, cal, counts, F.lit("2024-01-31").cast("date")).collect()
    assert sorted(r["scope_key"] for r in got) == [f"i_offset_paging:{k}" for k in (
        "20240104:00000000", "20240104:00005000", "20240104:00010000", "20240105:00000000")]
    assert scopes.incremental(declared, cal, F.lit("2024-01-06").cast("date")).collect()[0]["scope_key"] == "i_date_loop:20240105"
