"""Plans and results when one key holds a third of all rows."""

from pyspark.sql import functions as F

from quotemill.operators import calls, market, versions

from .conftest import rows


def skewed(spark, n=60_000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    return ids.select(F.when(hot, F.lit("000000.SH")).otherwise(F.concat(F.lpad((F.col("id") % 5000).cast("string"), 6, "0"), F.lit(".SZ"))).alias("ts_code"),
                      F.lit("2024-01-02").cast("date").alias("trade_date"), F.col("id").cast("double").alias("adj_factor"), F.col("id").alias("_version"))


def shuffled_rows(df):
    """Records written by each shuffle of the executed plan."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_old_versions_of_a_hot_key_do_not_reach_the_shuffle(spark):
    df = versions.current(skewed(spark), ["ts_code", "trade_date"])
    (written,) = shuffled_rows(df)
    tasks = spark.sparkContext.defaultParallelism
    # At most one row per key and map task, though the hot key alone has 20,000 rows.
    assert written < 40_000 + tasks
    assert df.filter("ts_code = '000000.SH'").first()["_version"] == 59_997


def test_latest_value_is_combined_before_the_shuffle(spark):
    df = market.latest_per_key(skewed(spark), "ts_code", "_version", "adj_factor")
    assert max(shuffled_rows(df)) < 40_000 + spark.sparkContext.defaultParallelism


def test_history_of_a_hot_key_is_ranked_in_blocks(spark):
    got = versions.history(skewed(spark).drop("adj_factor"), ["ts_code", "trade_date"]).filter("ts_code = '000000.SH'")
    assert rows(got.agg(F.min("version_rank"), F.max("version_rank"), F.count_distinct("version_rank"))) == [(1, 20_000, 20_000)]
    assert got.filter(F.col("version_rank") != (59_997 - F.col("_version")) / 3 + 1).count() == 0


def test_trailing_counts_of_a_hot_bucket(spark):
    df = spark.range(30_000).select(F.lit("hot").alias("bucket"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("started_at"))
    got = calls.trailing_counts(df).agg(F.min("trailing_calls"), F.max("trailing_calls"), F.sum("trailing_calls")).first()
    assert tuple(got) == (1, 61, 61 * 30_000 - sum(range(1, 61)))
