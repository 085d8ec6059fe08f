import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators import calls, state
from quotemill.operators.versions import current
from quotemill.plans import run
from quotemill.streaming import sink, stale, upsert, windows

from .conftest import rows
from .test_state_and_scopes import LOG_SCHEMA, unit

T0 = dt.datetime(2024, 1, 10, 12)
CALLS = "bucket string, started_at timestamp_ntz, duration_ms bigint, status int"


def random_calls(n, seed=1):
    rng = random.Random(seed)
    # Two thirds of the calls fall into one bucket, many at equal instants.
    return [("hot" if rng.random() < 0.67 else "cold", T0 + dt.timedelta(seconds=rng.randint(0, 400)), rng.randint(1, 50), rng.choice([200, 429, 401, 403]))
            for _ in range(n)]


def test_trailing_counts_match_brute_force(spark):
    data = random_calls(300)
    got = {(r["bucket"], r["started_at"]): r["trailing_calls"] for r in calls.trailing_counts(spark.createDataFrame(data, CALLS)).collect()}
    for bucket, at, *_ in data:
        assert got[bucket, at] == sum(1 for b, t, *_ in data if b == bucket and at - dt.timedelta(seconds=60) <= t <= at)


def test_latency_is_the_interpolated_percentile(spark):
    data = random_calls(200, 2)
    got = calls.latency_percentile(spark.createDataFrame(data, CALLS), 0.99).first()["latency_ms"]
    values, pos = sorted(d for *_, d, _ in data), 0.99 * 199
    low = int(pos)
    assert abs(got - (values[low] + (pos - low) * (values[low + 1] - values[low]))) < 1e-9


def test_sliding_windows_sum_to_tumbling_ones(spark):
    df = spark.createDataFrame(random_calls(100), CALLS)
    n = F.count(F.lit(1)).alias("n")
    assert calls.per_window(df, "60 seconds", n, slide="10 seconds").agg(F.sum("n")).first()[0] == 600
    assert calls.per_window(df, "1 minute", n).agg(F.sum("n")).first()[0] == 100


def test_retention_counts_back_from_the_newest_call(spark):
    df = spark.createDataFrame([("b", T0 - dt.timedelta(days=d), 1, 200) for d in (0, 89, 90, 91)], CALLS)
    assert calls.retain(df).count() == 3


def feed(spark, folder, batches, schema):
    """A file stream that takes one file per micro-batch, in order."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_windowed_stream_equals_batch_over_many_micro_batches(spark, tmp_path):
    data = sorted(random_calls(120), key=lambda r: r[1])
    stream = feed(spark, str(tmp_path / "in"), [data[i::4] for i in range(4)], CALLS)
    n = F.count(F.lit(1)).alias("n")
    got = windows.windowed(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "1 minute", n, by=("bucket",))
    assert rows(got) == rows(calls.per_window(spark.createDataFrame(data, CALLS), "1 minute", n, by=("bucket",)))


def test_upsert_ignores_order_and_replays(spark, tmp_path):
    batches = [[unit("a", "a:1", "running", 2)], [unit("a", "a:1", "pending", 1)], [unit("a", "a:1", "done", 3)], [unit("a", "a:1", "running", 2)],
               [unit("b", "b:1", "done", 1), unit("b", "b:1", "done", 1)]]
    stream = feed(spark, str(tmp_path / "in"), batches, LOG_SCHEMA)
    got = upsert.upsert(spark, stream, ["interface", "scope_key"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(got.select("scope_key", "status", "_version")) == [("a:1", "done", 3), ("b:1", "done", 1)]
    assert sink.read(spark, str(tmp_path / "out")).count() == 5


def test_late_keys_and_late_calls_are_kept(spark, tmp_path):
    late = [[unit("a", "a:1", "done", 2, at=T0 + dt.timedelta(days=30))], [unit("b", "b:1", "done", 1, at=T0)]]
    stream = feed(spark, str(tmp_path / "in"), late, LOG_SCHEMA)
    got = upsert.upsert(spark, stream, ["interface", "scope_key"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(got.select("scope_key", "_version")) == [("a:1", 2), ("b:1", 1)]
    data = sorted(random_calls(60), key=lambda r: r[1], reverse=True)
    stream = feed(spark, str(tmp_path / "calls"), [data[:20], data[20:40], data[40:]], CALLS)
    got = windows.latency(stream, str(tmp_path / "lat"), str(tmp_path / "lcp"), 0.5)
    want = calls.latency_percentile(spark.createDataFrame(data, CALLS), 0.5)
    assert rows(got.select("window_start", "latency_ms", "calls")) == rows(want)


def test_sketches_of_micro_batches_keep_the_rank_error(spark, tmp_path):
    rng = random.Random(5)
    data = [("b", T0 + dt.timedelta(seconds=rng.randint(0, 7000)), int(rng.paretovariate(1.2) * 1000), 200) for _ in range(6000)]
    frame = spark.createDataFrame(data, CALLS)
    stream = feed(spark, str(tmp_path / "in"), [data[i::3] for i in range(3)], CALLS)
    got = windows.latency_from_sketches(stream, str(tmp_path / "out"), str(tmp_path / "cp"), 0.9)
    for estimate in (got, calls.sketched_latency(calls.latency_sketch(frame), 0.9)):
        off = calls.rank_error(frame, estimate, 0.9).collect()
        assert len(off) == 2 and sum(r["calls"] for r in off) == 6000
        assert all(r["rank_error"] <= calls.SKETCH_ERROR for r in off)
    wrong = got.withColumn("latency_ms", F.col("latency_ms") * 2)
    assert all(r["rank_error"] > calls.SKETCH_ERROR for r in calls.rank_error(frame, wrong, 0.9).collect())


def test_stream_without_input_gives_no_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema(spark.createDataFrame([], CALLS).schema).parquet(str(tmp_path / "none"))
    assert windows.windowed(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "1 minute", F.count(F.lit(1)).alias("n")).count() == 0


def test_stale_flags(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [
        [unit("a", "a:1", "running", 2, at=at(0)), unit("b", "b:1", "running", 2, at=at(0)), unit("c", "c:1", "done", 2, at=at(0))],
        [unit("a", "a:1", "done", 3, at=at(5)), unit("d", "d:1", "running", 4, at=at(5))],
        [unit("b", "b:1", "running", 1, at=at(14))],  # late: older than the known version
        [unit("e", "e:1", "running", 5, at=at(15))],
    ]
    log = spark.createDataFrame([r for batch in batches for r in batch], LOG_SCHEMA)
    want = rows(state.stale_units(log, F.lit(at(15)).cast("timestamp_ntz"), version=99))
    assert [r[1] for r in want] == ["b:1"]
    for name, order in (("on", batches), ("back", batches[::-1])):
        stream = feed(spark, str(tmp_path / f"in-{name}"), order, LOG_SCHEMA)
        stale.follow(stream, str(tmp_path / name), str(tmp_path / f"cp-{name}"))
        assert rows(stale.flag_stale(spark, str(tmp_path / name), version=99)) == want
        # The flag is a version of the log: it makes the unit partial, whatever the clock of its row.
        flags = stale.flag_stale(spark, str(tmp_path / name))
        after = state.units(log.unionByName(flags), "status")
        assert rows(after.filter("status = 'partial'").select("scope_key")) == [("b:1",)] and rows(after.filter("status = 'running'").select("scope_key")) == [("d:1",), ("e:1",)]
        stale.release(spark, str(tmp_path / name), str(tmp_path / f"small-{name}"))
        assert rows(stale.flag_stale(spark, str(tmp_path / f"small-{name}"), version=99)) == want
        assert stale.board(spark, str(tmp_path / f"small-{name}")).filter("scope_key = 'a:1'").first()["heartbeat_at"] is None


def test_ties_resolve_on_a_stream_as_in_a_batch(spark, tmp_path):
    tied = [unit("a", f"a:{k % 3}", "done", 1, error=f"e{k}") for k in range(24)]
    stream = feed(spark, str(tmp_path / "in"), [tied[k::4] + tied[k::4] for k in range(4)], LOG_SCHEMA)
    got = upsert.upsert(spark, stream, ["interface", "scope_key"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(got) == rows(current(spark.createDataFrame(tied, LOG_SCHEMA), ["interface", "scope_key"]))


def test_load_stream_takes_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("ts_code", T.StringType()), T.StructField("trade_date", T.DateType()), T.StructField("close", T.DoubleType())])
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        stream = upsert.payload_files(spark, str(folder))
        sink.drain(upsert.load_payloads(stream, "value", schema, 7), str(tmp_path / "out"), str(tmp_path / "cp"), "append")
        return rows(sink.read(spark, str(tmp_path / "out")).select("ts_code", "trade_date", "close", "_version"))

    (folder / "a.json").write_text('{"fields":["ts_code","trade_date","close"],\n"items":[["A","2024/01/02",1.5],["B","20240103"]]}')
    first = [("A", dt.date(2024, 1, 2), 1.5, 7), ("B", dt.date(2024, 1, 3), None, 7)]
    assert run() == first
    (folder / "b.json").write_text('{"data":{"fields":["close","ts_code"],"items":[[2,"C"]]}}')
    assert run() == [*first, ("C", None, 2.0, 7)]


def test_increment_keeps_the_target_day(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS trade_date")
    assert upsert.increment(df, F.lit("2024-01-03").cast("date")).count() == 1


def test_stale_units_are_judged_by_the_clock_of_their_log(spark, tmp_path):
    # k % 6 names the status: 1 running, 2 done. The days lie beyond any fixed date, and the newest heartbeat is of a version that a later event replaces.
    start = dt.datetime(2031, 5, 6, 8)
    events = [(i, user, "click", start + dt.timedelta(minutes=at), 7.5, f'{{"k": {k}}}') for i, user, at, k in (
        (1, 1, 0, 1), (2, 2, 0, 2), (3, 3, 30, 1), (4, 4, 60, 1), (5, 4, 45, 2), (6, 5, 49, 1), (7, 6, 48, 1))]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = run("r5_stream_stale_units", spark, str(tmp_path))
    assert rows(got.select("interface", "_version", "heartbeat_at")) == [
        (f"if_{u}_offset_paging", v, start + dt.timedelta(minutes=at)) for u, v, at in ((1, 1, 0), (3, 3, 30), (6, 7, 48))]
    clock = int((start + dt.timedelta(minutes=59)).replace(tzinfo=dt.UTC).timestamp() * 1000)
    assert {(r["flag_version"], r["status"], r["last_success_at"]) for r in got.collect()} == {(clock, "partial", dt.datetime(1970, 1, 1))}
