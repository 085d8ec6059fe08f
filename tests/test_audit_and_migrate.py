import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill.functions.fingerprint import fingerprint
from quotemill.model import BARS
from quotemill.operators import audit, migrate

from .conftest import rows
from .test_state_and_scopes import LOG_SCHEMA, unit

DAY = dt.date


def calendar_of(spark, *days):
    return spark.createDataFrame([("SSE", d, 1) for d in days], "exchange string, cal_date date, is_open int")


def test_missing_day(spark):
    cal = calendar_of(spark, DAY(2024, 1, 1), DAY(2024, 1, 2), DAY(2024, 1, 3))
    data = spark.createDataFrame([(DAY(2024, 1, 1),), (DAY(2024, 1, 3),), (None,)], "trade_date date")
    gaps = audit.trading_day_gaps(cal, audit.dataset_days({"bars": (data, "trade_date")}))
    assert rows(gaps) == [("bars", DAY(2024, 1, 2))]
    assert audit.gap_report(gaps, cal).first().asDict() == {
        "dataset": "bars", "gap_type": "trading_day", "missing_count": 1, "missing_dates": "20240102", "date_range": "20240101..20240103"}


def test_empty_calendar(spark):
    data = spark.createDataFrame([(DAY(2024, 1, 1),)], "trade_date date")
    cal = calendar_of(spark, DAY(2024, 1, 1)).filter("false")
    assert audit.trading_day_gaps(cal, audit.dataset_days({"bars": (data, "trade_date")})).count() == 0
    none = audit.dataset_days({"bars": (data.limit(0), "trade_date")})
    assert audit.trading_day_gaps(cal, none, ["bars"]).count() == cal.filter("is_open = 1").count()


def test_gaps_and_present_days_make_the_calendar(tables):
    days = audit.dataset_days({"bars": (tables.bars, "trade_date")})
    n = tables.trade_cal.filter("is_open = 1").select("cal_date").distinct().count()
    gaps = audit.trading_day_gaps(tables.trade_cal, days)
    assert gaps.count() + audit.days_with_data(tables.bars, tables.trade_cal, "19900101", "20991231").count() == n


def periods(spark, *days):
    return spark.createDataFrame([("income", d) for d in days], "name string, end_date date")


def test_missing_quarters(spark):
    report = audit.period_gaps(periods(spark, DAY(2023, 12, 31), DAY(2023, 9, 30)), "name").first()
    assert (report["missing_periods"], report["missing_count"], report["date_range"]) == ("20230331,20230630", 2, "20230930..20231231")


def test_last_year_is_expected_whole_and_full_years_are_silent(spark):
    assert audit.period_gaps(periods(spark, DAY(2024, 3, 31)), "name").first()["missing_periods"] == "20240630,20240930,20241231"
    full = periods(spark, DAY(2023, 3, 31), DAY(2023, 6, 30), DAY(2023, 9, 30), DAY(2023, 12, 31))
    assert audit.period_gaps(full, "name").count() == 0


def test_empty_period_table(spark):
    declared = spark.createDataFrame([("income",)], "name string")
    got = audit.period_gaps(periods(spark, DAY(2023, 3, 31)).filter("false"), "name", declared=declared).first()
    assert (got["issue"], got["missing_count"], got["date_range"]) == ("Table has no data", 0, "empty")


def test_row_count_statuses(spark):
    names = ["gone", "bare", "good", "bad", "half"]
    interfaces = spark.createDataFrame([(n, f"t_{n}") for n in names], "interface string, table_name string")
    counts = spark.createDataFrame([("t_bare", 0), ("t_good", 5), ("t_bad", 5), ("t_half", 5)], "table_name string, row_count bigint")
    log = spark.createDataFrame([unit("good", "a", "done"), unit("bad", "a", "failed"), unit("bad", "b", "partial"), unit("half", "a", "partial")], LOG_SCHEMA)
    got = {r["interface"]: r["status"] for r in audit.row_count_audit(interfaces, counts, log).collect()}
    assert got == {"gone": "missing", "bare": "empty", "good": "ok", "bad": "has_failures", "half": "has_partial"}


def test_fingerprint_is_stable_under_order_and_sensitive_to_values(tables):
    bars = tables.bars
    for portable in (False, True):
        first = fingerprint(bars, columns=bars.columns, portable=portable).collect()
        again = fingerprint(bars.repartition(7).orderBy("close"), columns=bars.columns, portable=portable).collect()
        other = fingerprint(bars.withColumn("close", F.col("close") + F.when(F.col("ts_code") == "000001.SZ", 0.01).otherwise(0)), columns=bars.columns, portable=portable).collect()
        assert first == again and first != other


UNIT = "unit_id string, ts_code string, trade_date date, end_date date, period string, rows_written bigint"


def test_write_check(spark):
    data = spark.sql("""SELECT 'A' AS ts_code, CAST(NULL AS date) AS trade_date, DATE '2024-03-31' AS end_date, id AS k, 1L AS _version FROM range(10)
                        UNION ALL SELECT 'B', NULL, DATE '2024-06-30', id, 1L FROM range(2)""")
    units = spark.createDataFrame([
        ("whole", "A", None, None, None, 5000), ("zero", "Z", None, None, None, 3), ("silent", "Z", None, None, None, 0),
        ("quarter", "A", None, None, "20240331", 150), ("loss", "A", None, None, "20240331", 5000), ("day", None, None, DAY(2024, 6, 30), None, 40),
        ("table", None, None, None, None, 200), ("table_loss", None, None, None, None, 999)], UNIT)
    got = {r["unit_id"]: (r["found"], r["verdict"]) for r in audit.write_check(units, data, ["ts_code", "k"]).collect()}
    plan = audit.write_check(units, data, ["ts_code", "k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Expand") == 1
    assert got == {"whole": (10, "ok"), "zero": (0, "no_rows"), "silent": (0, "ok"), "quarter": (10, "ok"), "loss": (10, "heavy_loss"),
                   "day": (2, "ok"), "table": (12, "ok"), "table_loss": (12, "heavy_loss")}


def test_duplicate_loss_needs_more_than_hundred_rows(spark):
    doubled = spark.range(60).union(spark.range(60))
    got = {r["table_name"]: (r["loss"], r["warn"]) for r in audit.duplicate_loss({"big": (doubled, ["id"]), "small": (spark.range(50).union(spark.range(50)), ["id"])}).collect()}
    assert got == {"big": (0.5, True), "small": (None, False)}


def test_profiles(spark):
    df = spark.createDataFrame([(1, 2.5, "x"), (3, None, None)], "a int, b double, c string")
    assert rows(audit.numeric_profile(df)) == [("a", 4.0, 1.0, 3.0), ("b", 2.5, 2.5, 2.5)]
    assert rows(audit.null_profile(df)) == [("a", 2, 0), ("b", 2, 1), ("c", 2, 1)]


@pytest.mark.parametrize("latest,verdict", [("2024-01-31 11:00:00", "ok"), ("2024-01-31 04:00:00", "looks_utc"), ("2023-12-01 00:00:00", "outdated"), (None, "ok")])
def test_update_lag(spark, latest, verdict):
    df = spark.createDataFrame([(latest,)], "u string").select(F.col("u").cast("timestamp_ntz").alias("u"))
    assert audit.update_lag(df, "u", F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")).first()["verdict"] == verdict


def test_alignment(spark):
    table = lambda *names: spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    source = table("ts_code", "end_date", "close", "created_at", "updated_at", "junk", "skip")
    got = migrate.aligned(source, ["ts_code", "cal_date", "close", "skip", "extra"], {"end_date": "cal_date"}, ["skip"])
    assert got.columns == ["ts_code", "cal_date", "close"]
    got = migrate.column_differences(table("a", "b", "created_at", "e"), table("a", "c", "d"), {"b": "c"})
    assert rows(got) == [("a", "both"), ("c", "both"), ("d", "target_only"), ("e", "source_only")]


def test_parts_union(spark):
    one = lambda n: spark.createDataFrame([(n,)], "id int")
    got = migrate.union_parts({"p_2021": one(2).withColumn("x", F.lit("e")), "p_2020": one(1), "p_default": one(9), "p_2019": None}, default="p_default")
    assert [(r["id"], r["part"], r["x"]) for r in got.collect()] == [(1, "p_2020", None), (2, "p_2021", "e"), (9, "p_default", None)]
    with pytest.raises(ValueError):
        migrate.union_parts({"p_2019": None})


def test_cross_part_duplicates(spark):
    part = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    got = migrate.cross_part_duplicates({"p_2019": part(1), "p_2020": part(1, 2, 2), "p_2021": part(3), "p_default": part(1, 2, 2)}, "p_default", ["id"])
    assert rows(got) == [("p_2020 & p_default", 2)]


def test_cell_compare_reports_the_first_mismatch_per_row(spark):
    schema = "k int, amount double, vol double, grade string"
    source = spark.createDataFrame([(1, 1.0, 5.0, "a"), (2, 1.0, None, "a"), (3, 1.0, 5.0, "a"), (4, 1.0, 5.0, "a"), (5, None, None, None), (6, 1.0, 1.0, "a")], schema)
    target = spark.createDataFrame([(1, 10000.5, 5.0, "a"), (2, 10000.0, 5.0, "b"), (3, 10002.0, 6.0, "b"), (4, 10000.0, 5.0, "b"), (5, None, None, None)], schema)
    got = migrate.compare_cells(source, target, ["k"], ["amount", "vol", "grade"])
    assert rows(got.select("k", "column_name")) == [(2, "vol"), (3, "amount"), (4, "grade")]
    verdict, shown = migrate.sample_check(source, target, ["k"], ["amount", "vol", "grade"], shown=2)
    assert tuple(verdict.first()) == (3, False) and [r["k"] for r in shown.collect()] == [2, 3]
    assert migrate.compare_cells(source, target, ["k"], ["amount"], sample=2).count() <= 2


def test_count_and_sum_checks(spark):
    source = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "amount double, vol double")
    target = spark.createDataFrame([(10000.0, 2.0), (30100.0, 4.5)], "amount double, vol double")
    assert tuple(migrate.count_check(source, target).first()) == (2, 2, 0, True)
    got = {r["column_name"]: (r["scale"], r["passed"]) for r in migrate.sum_check(source, target, ["amount", "vol"]).collect()}
    assert got == {"amount": (10000, True), "vol": (1, False)}


def test_a_target_log_counts_newest_versions(spark):
    source = spark.createDataFrame([(1, 2.0)], "k int, vol double")
    log = spark.createDataFrame([(1, 9.0, 1), (1, 2.0, 2)], "k int, vol double, _version long")
    assert migrate.compare_cells(source, log, ["k"], ["vol"]).count() == 0
    assert migrate.sum_check(source, log, ["vol"], keys=["k"]).first()["passed"]


def test_checkpoints_of_an_undated_table(spark):
    at = dt.datetime(2024, 1, 2, 3)
    got = migrate.day_checkpoints(spark.range(3), "basic", None, F.lit(at).cast("timestamp_ntz"))
    assert tuple(got.first()) == ("basic", "full", "done", 3, at, at, 0, "", 1704164400000)
    assert got.columns == spark.createDataFrame([], LOG_SCHEMA).columns


def test_gap_runs_leave_out_noise(spark):
    days = [DAY(2024, 1, d) for d in (2, 3, 4, 5, 8, 9, 10)]
    data = spark.createDataFrame([(days[0],), (days[3],), (days[5],)], "trade_date date")
    gaps = audit.trading_day_gaps(calendar_of(spark, *days), audit.dataset_days({"bars": (data, "trade_date")}))
    runs = lambda n: rows(audit.gap_runs(gaps, calendar_of(spark, *days), n).select("first_day", "last_day", "open_days"))
    assert runs(1) == [(days[1], days[2], 2), (days[4], days[4], 1), (days[6], days[6], 1)] and runs(2) == [(days[1], days[2], 2)]


def test_advanced_fingerprints_equal_full_ones(spark):
    before = spark.createDataFrame([("A", DAY(2024, 1, 2), 1.0, 1), ("B", DAY(2024, 1, 2), 2.0, 1), ("A", DAY(2024, 1, 3), 3.0, 1)], "ts_code string, trade_date date, close double, _version bigint")
    appended = spark.createDataFrame([("A", DAY(2024, 1, 2), 9.0, 2), ("C", DAY(2024, 1, 4), 4.0, 1), ("B", DAY(2024, 1, 2), 7.0, 0)], before.schema)
    columns = before.columns
    for portable in (False, True):
        first = audit.day_fingerprints(before, BARS, columns, portable)
        second = audit.day_fingerprints(before.unionByName(appended), BARS, columns, portable)
        assert rows(audit.advance_fingerprints(first, before, appended, BARS, columns, portable)) == rows(second)
        named = [df.withColumn("dataset", F.lit("bars")) for df in (first, second)]
        assert rows(audit.run_differences(*named)) == [("bars", DAY(2024, 1, 2), 2, 2), ("bars", DAY(2024, 1, 4), 0, 1)]
        assert audit.run_differences(named[0], named[0]).count() == 0


def test_table_counts_equal_resolved_counts(tables):
    from quotemill.operators.versions import current

    assert audit.table_counts({"bars": (tables.bars, BARS)}).first()["row_count"] == current(tables.bars, BARS.keys).count()
