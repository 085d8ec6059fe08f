"""Streams over the driver's tables, drained with availableNow and compared with the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import STATE
from ..operators import calls, state
from ..session import scratch_path
from ..sources.domain import Domain
from ..streaming import sink, stale, upsert, windows
from .data_queries import HOURLY, RPM, SLIDING, SPLIT, capped_sql
from .registry import query
from .state_queries import NOW, as_of


def _events(t):
    """The event table as a file stream, whether it is one file or a folder of part files."""
    schema = t.raw("events").schema
    return t.spark.readStream.schema(schema).parquet(f"{t.folder}/event[s].parquet")


def _calls(t):
    return Domain.calls_from(_events(t))


def _folders(t, name):
    path = scratch_path(t.spark, name)
    return f"{path}/rows", f"{path}/checkpoint"


@query("r1_stream_calls_per_minute", RPM)
def _(t):
    out = windows.windowed(_calls(t), *_folders(t, "rpm"), "1 minute", F.count(F.lit(1)).alias("calls"), by=("bucket",))
    return out.withColumn("rps", F.col("calls") / F.lit(60.0))


@query("r1_stream_calls_per_hour", HOURLY)
def _(t):
    return windows.windowed(_calls(t), *_folders(t, "hourly"), "1 hour", F.count(F.lit(1)).alias("calls"))


@query("r2_stream_status_split", SPLIT)
def _(t):
    return windows.windowed(_calls(t), *_folders(t, "split"), "1 minute", *calls.status_counts())


@query("r3_stream_latency", """SELECT date_trunc('hour', started_at) AS window_start, date_trunc('hour', started_at) + INTERVAL 1 HOUR AS window_end,
  round(quantile_cont(duration_ms, 0.99), 4) AS latency_ms, count(*) AS calls FROM api_calls GROUP BY 1""")
def _(t):
    return windows.latency(_calls(t), *_folders(t, "latency")).withColumn("latency_ms", F.round("latency_ms", 4))


@query("r3_stream_latency_sketch", """SELECT date_trunc('hour', started_at) AS window_start, count(*) AS calls, true AS within_error
  FROM api_calls GROUP BY 1""")
def _(t):
    # A sketch is random, so its error is what can be told: the rank of every window's percentile against all calls of the window.
    got = windows.latency_from_sketches(_calls(t), *_folders(t, "sketch"))
    off = calls.rank_error(t.api_calls, got)
    return off.select("window_start", "calls", (F.col("rank_error") <= calls.SKETCH_ERROR).alias("within_error"))


@query("r4_stream_sliding_rate", SLIDING)
def _(t):
    return windows.windowed(_calls(t), *_folders(t, "sliding"), "60 seconds", F.count(F.lit(1)).alias("calls"), slide="10 seconds", by=("bucket",))


@query("r5_stream_stale_units", """SELECT interface, scope_key, 'partial' AS status, rows, last_success_at, heartbeat_at, epoch_us(heartbeat_at) // 1000 AS heartbeat_ms,
  attempts, 'heartbeat timeout' AS last_error, _version, greatest(_version + 1, (SELECT epoch_us(max(heartbeat_at)) // 1000 - 60000 FROM state_log)) AS flag_version FROM units
  WHERE status = 'running' AND epoch_us(heartbeat_at) // 1000 + 600000 < (SELECT epoch_us(max(heartbeat_at)) // 1000 - 60000 FROM state_log)""")
def _(t):
    # The clock is the log's own: a minute, in whole milliseconds, before the newest heartbeat of any version that the stream brought.
    rows, checkpoint = _folders(t, "stale")
    stale.follow(Domain.state_from(_events(t)), rows, checkpoint)
    clock = F.date_trunc("millisecond", stale.clock(t.spark, rows)).cast("timestamp_ntz") - F.expr("interval 1 minute")
    flags = stale.flag_stale(t.spark, rows, clock, version=F.col(STATE.version))
    millis = F.unix_millis(F.col("heartbeat_at").cast("timestamp")).alias("heartbeat_ms")
    return flags.select(*flags.columns[:6], millis, *flags.columns[6:], stale.flag_version(clock).alias("flag_version"))


@query("r5_stream_flagged_log", f"""SELECT status, count(*) AS units, CAST(sum(rows) AS BIGINT) AS total_rows FROM (
  SELECT CASE WHEN status = 'running' AND heartbeat_at < {NOW} - INTERVAL 10 MINUTE THEN 'partial' ELSE status END AS status, rows FROM units) GROUP BY status""")
def _(t):
    # The flags are versions like any other: appended to the log, they make their units partial.
    rows, checkpoint = _folders(t, "stale")
    stale.follow(Domain.state_from(_events(t)), rows, checkpoint)
    return state.by_status(t.state_log.unionByName(stale.flag_stale(t.spark, rows, as_of())))


@query("r6_stream_upsert", "SELECT * FROM units")
def _(t):
    path = scratch_path(t.spark, "upsert")
    return upsert.upsert(t.spark, Domain.state_from(_events(t)), STATE.keys, f"{path}/rows", f"{path}/checkpoint")


@query("r9_stream_load", f"""SELECT ts_code, CAST(strptime(day, '%Y%m%d') AS DATE) AS bar_date, {capped_sql('trade_date', 'NULL')} AS trade_date, vol, close,
  CASE WHEN trade_date <> ' NaN ' THEN amount END AS amount, CAST(1714000000000 AS BIGINT) AS _version FROM raw_bars""")
def _(t):
    path = scratch_path(t.spark, "load")
    t.payloads.select("payload").write.text(f"{path}/in")
    stream = t.spark.readStream.schema("value string").text(f"{path}/in")
    schema = T.StructType([
        T.StructField("ts_code", T.StringType()), T.StructField("day", T.StringType()), T.StructField("trade_date", T.DateType()),
        T.StructField("vol", T.LongType()), T.StructField("close", T.DoubleType()), T.StructField("amount", T.DoubleType()),
    ])
    rows = upsert.load_payloads(stream, "value", schema, 1_714_000_000_000).drop("_rejects")
    sink.drain(rows, f"{path}/rows", f"{path}/checkpoint", "append")
    out = sink.read(t.spark, f"{path}/rows").drop(sink.BATCH)
    return out.withColumn("bar_date", F.to_date("day", "yyyyMMdd")).drop("day")
