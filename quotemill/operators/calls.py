"""Call-log measures on a batch log; the streaming package repeats the windowed ones on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RATE_LIMITED, UNAUTHORIZED, FORBIDDEN, OK = 429, 401, 403, 200
#: Size of a latency sketch, and the rank error its users may rely on.
SKETCH_K, SKETCH_ERROR = 800, 0.01


def trailing_counts(calls: DataFrame, seconds: int = 60, time: str = "started_at", key: str = "bucket") -> DataFrame:
    """Calls of the same bucket in the `seconds` up to each call, itself included.

    A bucket can hold a third of all calls, so no window spans a bucket: equal instants are counted first,
    each instant is placed in its own time slot of that length and, as context, in the next one, and the
    range frame runs inside (bucket, slot). Two slots always cover the frame, so the result is exact.
    """
    instants = calls.groupBy(key, time).agg(F.count(F.lit(1)).alias("n"))
    slot = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")
    placed = instants.withColumn("own", slot).withColumn("slot", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    frame = (
        Window.partitionBy(key, "slot").orderBy(F.unix_micros(F.col(time).cast("timestamp")))
        .rangeBetween(-seconds * 1_000_000, Window.currentRow)
    )
    return (
        placed.withColumn("trailing_calls", F.sum("n").over(frame))
        .filter(F.col("own") == F.col("slot"))
        .select(key, time, "n", "trailing_calls")
    )


def over_limit(calls: DataFrame, limits: dict[str, int], seconds: int = 60) -> DataFrame:
    """Instants at which a bucket exceeded its allowance."""
    limit = F.lit(None).cast("int")
    for bucket, allowed in limits.items():
        limit = F.when(F.col("bucket") == bucket, allowed).otherwise(limit)
    return trailing_counts(calls, seconds).withColumn("allowed", limit).filter(F.col("trailing_calls") > F.col("allowed"))


def per_window(calls: DataFrame, width: str, *aggregates: Column, slide: str | None = None, by: tuple[str, ...] = (),
               time: str = "started_at") -> DataFrame:
    """Aggregates per tumbling or sliding window; works on batch and streaming frames alike."""
    window = F.window(F.col(time), width, slide) if slide else F.window(F.col(time), width)
    return calls.groupBy(window.alias("w"), *by).agg(*aggregates).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
        *[F.col(n) for n in _names(calls, aggregates)],
    )


def _names(df: DataFrame, aggregates: tuple[Column, ...]) -> list[str]:
    if df.isStreaming:
        df = df.sparkSession.createDataFrame([], df.schema)
    return df.agg(*aggregates).columns


def status_counts() -> tuple[Column, ...]:
    status = F.col("status")
    return (
        F.count_if(status == RATE_LIMITED).alias("rate_limited"),
        F.count_if(status == UNAUTHORIZED).alias("auth_error"),
        F.count_if(status == FORBIDDEN).alias("forbidden"),
    )


def latency_percentile(calls: DataFrame, q: float = 0.99, width: str = "1 hour") -> DataFrame:
    """Exact percentile of duration_ms per window.

    Durations are counted per (window, value) first and the percentile takes the counts as weights, so a
    window's state is its distinct durations, not its calls.
    """
    start = F.window("started_at", width)["start"].alias("window_start")
    counted = calls.groupBy(start, "duration_ms").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("window_start").agg(
        F.percentile("duration_ms", q, F.col("n")).alias("latency_ms"), F.sum("n").alias("calls")
    )


def latency_sketch(calls: DataFrame, width: str = "1 hour", k: int = SKETCH_K) -> DataFrame:
    """(window_start, sketch, calls): a KLL sketch of duration_ms per window. Its size depends on `k`, not on the calls or on how many
    durations differ, and sketches of parts of a log merge into that of the whole."""
    start = F.window("started_at", width)["start"].alias("window_start")
    return calls.groupBy(start).agg(
        F.kll_sketch_agg_bigint(F.col("duration_ms").cast("bigint"), k).alias("sketch"), F.count(F.lit(1)).alias("calls"))


def sketched_latency(sketches: DataFrame, q: float = 0.99) -> DataFrame:
    """The percentile per window from any number of sketches of it. With SKETCH_K its rank is off by more than SKETCH_ERROR of the
    calls only by rare chance (about half a percent at 99 % confidence); `latency_percentile` is the exact form."""
    return sketches.groupBy("window_start").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("calls").alias("calls")).select(
        "window_start", F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias("latency_ms"), "calls")


def rank_error(calls: DataFrame, estimates: DataFrame, q: float = 0.99, width: str = "1 hour") -> DataFrame:
    """(window_start, calls, rank_error) of estimated percentiles: the distance of q to the shares of calls that lie below and up to the estimate."""
    start = F.window("started_at", width)["start"].alias("window_start")
    counted = calls.groupBy(start, "duration_ms").agg(F.count(F.lit(1)).alias("n"))
    shares = counted.join(estimates.select("window_start", "latency_ms"), "window_start").groupBy("window_start").agg(
        F.sum("n").alias("calls"), F.sum(F.when(F.col("duration_ms") < F.col("latency_ms"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("duration_ms") <= F.col("latency_ms"), F.col("n")).otherwise(0)).alias("upto"))
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("calls") - q, F.lit(q) - F.col("upto") / F.col("calls"))
    return shares.select("window_start", "calls", off.alias("rank_error"))


def since(df: DataFrame, as_of: Column, interval: str, time: str = "started_at") -> DataFrame:
    """Rows newer than as_of minus an interval and not after as_of."""
    return df.filter((F.col(time) > as_of - F.expr(f"interval {interval}")) & (F.col(time) <= as_of))


def totals_of_day(calls: DataFrame, as_of: Column) -> DataFrame:
    """Calls and errors since midnight of as_of."""
    return calls.filter(F.col("started_at").between(F.date_trunc("day", as_of), as_of)).agg(
        F.count(F.lit(1)).alias("total_calls"), F.count_if(F.col("status") != OK).alias("errors")
    )


def auth_errors(calls: DataFrame, as_of: Column, interval: str = "24 hours") -> DataFrame:
    status = F.col("status")
    return since(calls, as_of, interval).agg(
        F.count_if(status == UNAUTHORIZED).alias("auth_401"), F.count_if(status == FORBIDDEN).alias("auth_403"),
        F.count_if(status.isin(UNAUTHORIZED, FORBIDDEN)).alias("auth_errors"),
    )


def top_callers(calls: DataFrame, n: int = 5) -> DataFrame:
    return calls.groupBy("interface").agg(F.count(F.lit(1)).alias("calls")).orderBy(F.col("calls").desc(), "interface").limit(n)


def retain(calls: DataFrame, days: int = 90, time: str = "started_at") -> DataFrame:
    """Calls of the last `days` days, counted back from the newest call; whole days are kept."""
    newest = calls.agg(F.date_sub(F.max(F.col(time)).cast("date"), days))
    return calls.filter(F.col(time).cast("date") >= newest.scalar())
