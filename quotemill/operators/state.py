"""Load-state operators: `log` is always the append-only checkpoint log, resolved inside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..model import LOAD_STATES, PRIORITIES, RETRYABLE, STATE
from .versions import current

NEVER = "1970-01-01 00:00:00"


def units(log: DataFrame, *columns: str) -> DataFrame:
    """Newest state of each unit, cut to the keys and the named columns.

    The log is resolved whole: a tie on the version falls to a hash of all columns, so every query over the log sees
    the same row whatever it selects.
    """
    need = [*STATE.keys, *[c for c in columns if c not in STATE.keys]]
    return current(log, STATE.keys).select(*need)


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _rows() -> Column:
    return F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows")


def by_status(log: DataFrame) -> DataFrame:
    return units(log, "status", "rows").groupBy("status").agg(_n().alias("units"), _rows())


def by_interface_status(log: DataFrame) -> DataFrame:
    return units(log, "status").groupBy("interface", "status").agg(_n().alias("units"))


def interface_status(log: DataFrame, interface: str) -> DataFrame:
    """All units of one interface."""
    return units(log, "status", "rows", "last_success_at", "heartbeat_at", "attempts", "last_error").filter(
        F.col("interface") == interface
    )


def status_pivot(log: DataFrame) -> DataFrame:
    """Units per state in columns, with an attention flag."""
    counts = [_n(F.col("status") == s).alias(s) for s in LOAD_STATES]
    out = units(log, "status").groupBy("interface").agg(_n().alias("total"), *counts)
    flag = (
        F.when((F.col("failed") > 0) | (F.col("biz_err") > 0), "***")
        .when(F.col("partial") > 0, "~~~")
        .when(F.col("pending") > 0, "---")
        .otherwise("")
    )
    return out.withColumn("flag", flag)


def failure_share(log: DataFrame) -> DataFrame:
    return units(log, "status").groupBy("interface").agg(
        _n().alias("units"),
        _n(F.col("status") == "done").alias("done"),
        _n(F.col("status") == "failed").alias("failed"),
    )


def distinct_interfaces(log: DataFrame) -> DataFrame:
    """Records and distinct interfaces per status, over current units."""
    return units(log, "status").groupBy("status").agg(
        _n().alias("records"), F.count_distinct("interface").alias("interfaces")
    )


def with_totals(log: DataFrame) -> DataFrame:
    """Counts by (interface, status) and one grand-total row with both keys NULL."""
    # groupingSets on the DataFrame keeps one pass over the data.
    df = units(log, "status")
    sets = [[F.col("interface"), F.col("status")], []]
    return df.groupingSets(sets, "interface", "status").agg(
        _n().alias("units"), F.grouping_id().cast("int").alias("grouping")
    ).select("interface", "status", "units", (F.col("grouping") > 0).alias("is_total"))


def last_success(log: DataFrame) -> DataFrame:
    done = units(log, "status", "rows", "last_success_at").filter(F.col("status") == "done")
    return done.groupBy("interface").agg(F.max("last_success_at").alias("last_success"), _rows())


def stale_interfaces(log: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return last_success(log).select("interface", "last_success").filter(
        F.col("last_success") < as_of - F.expr(f"interval {days} days")
    )


def retryable(log: DataFrame) -> DataFrame:
    return units(log, "status", "attempts").filter(F.col("status").isin(*RETRYABLE))


def scopes_of_day(log: DataFrame, day: str) -> DataFrame:
    """Units whose scope key mentions a day, rolled up by interface and status."""
    hit = units(log, "status", "rows").filter(F.col("scope_key").contains(day))
    return hit.groupBy("interface", "status").agg(_n().alias("units"), _rows())


def freshness(log: DataFrame, cal: DataFrame, as_of: Column) -> DataFrame:
    """The roll-up above for the last open day up to as_of, which the plan looks up itself."""
    from .calendar import latest_trade_date

    day = latest_trade_date(cal, as_of).select(F.date_format("trade_date", "yyyyMMdd"))
    keyed = units(log, "status", "rows").withColumn("day", day.scalar())
    hit = keyed.filter(F.col("scope_key").contains(F.col("day")))
    return hit.groupBy("day", "interface", "status").agg(_n().alias("units"), _rows())


def errors_by_interface(log: DataFrame, length: int = 200) -> DataFrame:
    failed = units(log, "status", "last_error").filter(F.col("status") == "failed")
    return failed.groupBy("interface").agg(
        _n().alias("units"), F.max(F.substring("last_error", 1, length)).alias("sample_error")
    )


def distinct_errors(log: DataFrame) -> DataFrame:
    return units(log, "status", "last_error").filter(F.col("last_error") != "").select(
        "interface", "status", "last_error"
    ).distinct()


# Error texts and the bucket each one stands for, in test order.
ERROR_BUCKETS = {
    "Unrecognized column": "schema_drift",
    "Unknown strategy": "planner_strategy",
    "handshake": "ssl_timeout",
    "read operation timed out": "read_timeout",
    "Unable to create Python array": "nullable_violation",
    "unsupported operand type": "date_serialization",
}


def error_bucket(col: Column, buckets: Mapping[str, str] = ERROR_BUCKETS) -> Column:
    out = None
    for text, bucket in buckets.items():
        out = F.when(col.contains(text), bucket) if out is None else out.when(col.contains(text), bucket)
    return out.when(col == "", "empty_error").otherwise("other")


def error_classes(log: DataFrame, samples: int = 5) -> DataFrame:
    """Failed units per error bucket with the first sample interfaces by name.

    The samples are cut by rank before they are gathered, so no task holds a bucket's full name set.
    """
    failed = units(log, "status", "last_error").filter(F.col("status") == "failed").select(
        "interface", error_bucket(F.col("last_error")).alias("bucket")
    )
    pairs = failed.groupBy("bucket", "interface").agg(_n().alias("n"))
    first = Window.partitionBy("bucket").orderBy("interface")
    names = (
        pairs.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= samples)
        .groupBy("bucket").agg(F.array_join(F.sort_array(F.collect_list("interface")), ",").alias("sample_interfaces"))
    )
    return pairs.groupBy("bucket").agg(F.sum("n").alias("units")).join(names, "bucket")


def run_outcomes(df: DataFrame) -> DataFrame:
    """Per run: units, done, failed and the outcome; `df` has one (run_id, status, started_at) row per unit."""
    out = df.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"), _n().alias("units_total"),
        _n(F.col("status") == "done").alias("units_done"),
        _n(F.col("status") == "failed").alias("units_failed"),
    )
    outcome = F.when(F.col("units_failed") == 0, "done").when(F.col("units_done") > 0, "partial").otherwise("failed")
    return out.withColumn("status", outcome)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(n)


def top_interfaces(log: DataFrame, n: int = 20) -> DataFrame:
    """Largest (interface, status) groups, ties by name."""
    return by_interface_status(log).orderBy(F.col("units").desc(), "interface", "status").limit(n)


def top_rows(log: DataFrame, n: int = 15) -> DataFrame:
    return last_success(log).select("interface", "total_rows").orderBy(F.col("total_rows").desc(), "interface").limit(n)


def top_errors(log: DataFrame, as_of: Column, n: int = 10, interval: str = "24 hours") -> DataFrame:
    """Interfaces with the most failed or partial units among those with a success within the interval before `as_of`."""
    recent = (F.col("last_success_at") > as_of - F.expr(f"interval {interval}")) & (F.col("last_success_at") <= as_of)
    failing = units(log, "status", "last_success_at").filter(F.col("status").isin("failed", "partial") & recent)
    return failing.groupBy("interface").agg(_n().alias("errors")).orderBy(F.col("errors").desc(), "interface").limit(n)


def declared_without_state(interfaces: DataFrame, log: DataFrame) -> DataFrame:
    return interfaces.join(log.select("interface").distinct(), "interface", "left_anti")


def with_state_counts(interfaces: DataFrame, log: DataFrame) -> DataFrame:
    """Declared interfaces with their unit counts, zeros when nothing was ever loaded."""
    state = units(log, "status", "rows", "heartbeat_at").groupBy("interface").agg(
        *[_n(F.col("status") == s).alias(s) for s in ("done", "partial", "failed")],
        _rows(),
        F.max(F.when(F.col("status") == "done", F.col("heartbeat_at"))).alias("last_sync"),
    )
    zero = {c: 0 for c in ("done", "partial", "failed", "total_rows")}
    return interfaces.join(state, "interface", "left").fillna(zero)


def coverage_report(interfaces: DataFrame, log: DataFrame, interface: str | None = None,
                    priority: str | None = None) -> DataFrame:
    """Health of each enabled interface."""
    wanted = interfaces.filter("enabled")
    if priority is not None:
        if priority.upper() not in PRIORITIES:
            raise ValueError(f"invalid priority: {priority!r}")
        wanted = wanted.filter(F.col("priority") == priority.upper())
    if interface is not None:
        wanted = wanted.filter(F.col("interface") == interface)
        log = log.filter(F.col("interface") == interface)
    done, partial, failed = F.col("done"), F.col("partial"), F.col("failed")
    health = (
        F.when((done > 0) & (partial == 0) & (failed == 0), "healthy")
        .when(failed > 0, "failed")
        .when(partial > 0, "partial")
        .when(done == 0, "not_started")
        .otherwise("in_progress")
    )
    return with_state_counts(wanted, log).select(
        "interface", "priority", health.alias("status"), "last_sync", "total_rows", "done", "partial", "failed"
    )


def resume_set(planned: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Planned units that may be retried, and retryable keys no plan covers any more."""
    open_units = retryable(log)
    return (
        planned.join(open_units, list(STATE.keys), "left_semi"),
        open_units.join(planned, list(STATE.keys), "left_anti"),
    )


def resume_actions(planned: DataFrame, log: DataFrame) -> DataFrame:
    """Every retryable unit with what a resume would do: run it again, or report it as an orphan.
    One join answers both, where `resume_set` needs two."""
    keys = planned.select(*STATE.keys).distinct().withColumn("action", F.lit("resume"))
    return retryable(log).join(keys, list(STATE.keys), "left").fillna("orphan", ["action"])


def reset_failed(log: DataFrame, version: int | Column) -> DataFrame:
    """New pending versions of the failed units, one attempt further, ready to append. The version may be
    an expression over the old `_version`."""
    failed = units(log, "status", "attempts", STATE.version).filter(F.col("status") == "failed")
    never = F.lit(NEVER).cast("timestamp_ntz")
    return failed.select(
        *STATE.keys,
        F.lit("pending").alias("status"),
        F.lit(0).cast("bigint").alias("rows"),
        never.alias("last_success_at"),
        never.alias("heartbeat_at"),
        (F.col("attempts") + 1).cast("int").alias("attempts"),
        F.lit("").alias("last_error"),
        (version if isinstance(version, Column) else F.lit(version)).cast("bigint").alias(STATE.version),
    )


def stale_units(log: DataFrame, as_of: Column, minutes: int = 10, version: Column | int | None = None) -> DataFrame:
    """New partial versions of running units whose heartbeat is too old. The version is that of `as_of` unless given; it may be an expression
    over the old `_version`."""
    rows = units(log, "status", "rows", "last_success_at", "heartbeat_at", "attempts", STATE.version).filter(
        (F.col("status") == "running") & (F.col("heartbeat_at") < as_of - F.expr(f"interval {minutes} minutes"))
    )
    stamp = F.unix_millis(as_of.cast("timestamp")) if version is None else version
    return rows.select(
        *STATE.keys, F.lit("partial").alias("status"), "rows", "last_success_at", "heartbeat_at", "attempts",
        F.lit("heartbeat timeout").alias("last_error"),
        (stamp if isinstance(stamp, Column) else F.lit(stamp)).cast("bigint").alias(STATE.version),
    )


def doomed_units(interfaces: Sequence[str] = (), prefixes: Sequence[str] = (),
                 statuses: Sequence[str] = (), not_done: bool = False) -> Column:
    """Predicate of a state reset: any named interface or prefix, narrowed by status."""
    hit = F.lit(False)
    if interfaces:
        hit = hit | F.col("interface").isin(*interfaces)
    for prefix in prefixes:
        hit = hit | F.col("interface").startswith(prefix)
    if not interfaces and not prefixes:
        hit = F.lit(bool(statuses) or not_done)
    if statuses:
        hit = hit & F.col("status").isin(*statuses)
    if not_done:
        hit = hit & (F.col("status") != "done")
    return hit
