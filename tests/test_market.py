import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill.functions import checks
from quotemill.operators import calendar, market
from quotemill.sources.sql_gate import query_sql

from .conftest import rows

CODES = {"000001.SZ": True, "600000.SH": True, "430047.BJ": True, "000001": False, "000001.XX": False, "00001.SZ": False,
         "000001.sz": False, "000001.SZ' OR 1=1": False, "": False}


def test_code_shapes(spark):
    df = spark.createDataFrame([(c,) for c in [*CODES, None]], "c string").select("c", checks.is_code(F.col("c")))
    assert {r[0]: r[1] for r in df.collect()} == {**CODES, None: False}


def test_exchanges_and_statements(spark):
    names = "SSE SZSE BSE CFFEX SHFE DCE CZCE".split()
    df = spark.createDataFrame([(n,) for n in [*names, "NYSE"]], "e string")
    assert df.filter(checks.is_exchange(F.col("e"))).count() == 7
    assert spark.createDataFrame([("income",), ("revenue",)], "s string").filter(checks.is_statement(F.col("s"))).count() == 1


@pytest.fixture
def bars(spark):
    return spark.sql("""SELECT * FROM VALUES
      ('000001.SZ', DATE '2024-01-02', 10D, 1), ('000001.SZ', DATE '2024-01-02', 11D, 2), ('000001.SZ', DATE '2024-01-03', 12D, 1),
      ('000001.SZ', DATE '2024-01-04', 13D, 1), ('600000.SH', DATE '2024-01-02', 5D, 1) AS t(ts_code, trade_date, close, _version)""").select(
        "ts_code", "trade_date", *[F.col("close").alias(c) for c in market.PRICES], F.lit(100.0).alias("vol"), F.lit(7.0).alias("amount"),
        F.lit(0.5).alias("pct_chg"), F.col("_version").cast("bigint"))


@pytest.fixture
def factors(spark):
    return spark.sql("""SELECT ts_code, trade_date, adj_factor, CAST(_version AS bigint) AS _version FROM VALUES
      ('000001.SZ', DATE '2024-01-02', 1D, 1), ('000001.SZ', DATE '2024-01-03', 2D, 1), ('000001.SZ', DATE '2024-02-01', 9D, 1),
      ('000001.SZ', DATE '2024-02-01', 4D, 2), ('600000.SH', DATE '2024-01-02', 3D, 1) AS t(ts_code, trade_date, adj_factor, _version)""")


def closes(df):
    return [(r["ts_code"], r["trade_date"].day, r["close"], r["vol"]) for r in market.by_day(df).collect()]


def test_adjustments(bars, factors):
    assert closes(market.ohlcv(bars, codes="000001.SZ", adjust="none")) == [("000001.SZ", 2, 11.0, 100.0), ("000001.SZ", 3, 12.0, 100.0), ("000001.SZ", 4, 13.0, 100.0)]
    # The base is the newest version of the newest factor, also outside the requested days.
    assert closes(market.ohlcv(bars, factors, "000001.SZ", "20240101", "20240131", "qfq")) == [("000001.SZ", 2, 2.75, 100.0), ("000001.SZ", 3, 6.0, 100.0)]
    assert closes(market.ohlcv(bars, factors, ["000001.SZ", "600000.SH"], adjust="hfq")) == [
        ("000001.SZ", 2, 11.0, 100.0), ("600000.SH", 2, 15.0, 100.0), ("000001.SZ", 3, 24.0, 100.0)]
    assert closes(market.ohlcv(bars, factors, None, "20240102", "20240102", "qfq")) == [("000001.SZ", 2, 2.75, 100.0), ("600000.SH", 2, 5.0, 100.0)]


@pytest.mark.parametrize("kwargs", [{"codes": "1.SZ"}, {"start": "2024-01-01"}, {"adjust": "both"}])
def test_bad_arguments(bars, factors, kwargs):
    with pytest.raises(ValueError):
        market.ohlcv(bars, factors, **kwargs)


def test_financials_by_statement_and_period(tables):
    whole = market.financials(tables.financials)
    some = market.financials(tables.financials, statement="income", periods=["19961231", "19971231"])
    assert rows(some) == sorted(r for r in rows(whole) if r[0] == "income" and r[2] in (dt.date(1996, 12, 31), dt.date(1997, 12, 31)))
    with pytest.raises(ValueError):
        market.financials(tables.financials, statement="other")


def test_index_and_flow_filters(tables):
    whole = rows(market.index_components(tables.index_weight))
    day = whole[0][2].strftime("%Y%m%d")
    assert rows(market.index_components(tables.index_weight, whole[0][0], day)) == [r for r in whole if r[0] == whole[0][0] and r[2] == whole[0][2]]
    flow = rows(market.moneyflow(tables.moneyflow))
    code = flow[0][0]
    assert rows(market.moneyflow(tables.moneyflow, code, "19960101", "19971231")) == [
        r for r in flow if r[0] == code and dt.date(1996, 1, 1) <= r[1] <= dt.date(1997, 12, 31)]


@pytest.fixture
def cal(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-08')) AS cal_date")
    is_open = F.dayofweek("cal_date").between(2, 6) & (F.dayofmonth("cal_date") != 1)
    return calendar.with_previous_open_day(
        days.withColumn("exchange", F.explode(F.array(F.lit("SSE"), F.lit("SZSE")))).withColumn("is_open", is_open.cast("int")))


def test_calendar(cal):
    got = calendar.trade_calendar(cal, "20240105", "20240108").collect()
    assert [(r[0].day, r[1], r[2].day) for r in got] == [(5, 1, 4), (6, 0, 5), (7, 0, 5), (8, 1, 5)]
    assert calendar.latest_trade_date(cal, "20240107").first()[0] == dt.date(2024, 1, 5)
    assert calendar.latest_trade_date(cal, "20231231").first()[0] is None
    assert sorted(r[0].day for r in calendar.trade_dates(cal, "20240101", "20240107").collect()) == [2, 3, 4, 5]
    with pytest.raises(ValueError):
        calendar.trade_calendar(cal, "20240101", "20240107", "NYSE")


def test_symbols_of_a_missing_table(spark):
    assert market.symbols(None, spark).count() == 0


def test_sql_gate(spark, bars):
    views = {"gate_bars": bars}
    assert query_sql(spark, "SELECT count(*) AS n FROM gate_bars WHERE close > :low -- tail", {"low": 11.5}, views).first()[0] == 2
    assert query_sql(spark, " with b AS (SELECT * FROM gate_bars) SELECT max(close) AS m FROM b ORDER BY m", views=views).first()[0] == 13.0
    assert query_sql(spark, "DESCRIBE gate_bars", views=views).count() == 10
    assert not spark.catalog.tableExists("gate_bars") and query_sql(spark, "SHOW VIEWS").count() >= 0


def test_sql_gate_reads_no_paths_and_calls_no_methods(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    for text in (f"SELECT * FROM parquet.`{tmp_path}/t`", "SELECT reflect('java.lang.System', 'getProperty', 'user.dir')", "SELECT `java_method`('a', 'b')"):
        with pytest.raises(Exception):
            query_sql(spark, text)
    assert spark.sql(f"SELECT * FROM parquet.`{tmp_path}/t`").count() == 1


@pytest.mark.parametrize("text", [
    "SELECT * FROM gate_secret", "SELECT 1 FROM gate_bars WHERE EXISTS (SELECT 1 FROM gate_secret)", "SELECT (SELECT max(id) FROM gate_secret) FROM gate_bars",
    "WITH gate_secret AS (SELECT * FROM gate_secret) SELECT * FROM gate_secret", "SELECT * FROM gate_bars, LATERAL (SELECT * FROM gate_secret)",
    "SELECT * FROM (WITH gate_secret AS (SELECT 1) SELECT * FROM gate_secret), gate_secret", "SELECT * FROM default.gate_bars", "SELECT * FROM range(5)",
    "SELECT * FROM IDENTIFIER('gate_secret')", "SELECT TRANSFORM(*) USING 'cat' FROM gate_bars", "DESCRIBE gate_secret", "DESCRIBE QUERY SELECT * FROM gate_secret",
    "SHOW CREATE TABLE gate_secret", "WITH a AS (SELECT 1) SELECT * FROM gate_bars UNION ALL SELECT * FROM gate_secret",
])
def test_sql_gate_reads_the_given_views_only(spark, bars, text):
    spark.range(3).createOrReplaceTempView("gate_secret")
    with pytest.raises(ValueError, match="allowed|given"):
        query_sql(spark, text, views={"gate_bars": bars})
    spark.catalog.dropTempView("gate_secret")


@pytest.mark.parametrize("text", [
    "DROP TABLE gate_bars", "INSERT INTO gate_bars VALUES (1)", "SELECTED x", "; SELECT 1", "DELETE FROM gate_bars",
    "CREATE TABLE t AS SELECT 1", "",
])
def test_sql_gate_rejects_other_statements(spark, text):
    with pytest.raises(ValueError):
        query_sql(spark, text)


def test_sql_gate_rejects_writes_behind_with(spark, bars, tmp_path):
    target = str(tmp_path / "t")
    spark.sql("SELECT 1D AS close").write.parquet(target)
    spark.read.parquet(target).createOrReplaceTempView("gate_target")
    for text in (f"WITH a AS (SELECT 2D AS close) INSERT INTO parquet.`{target}` SELECT * FROM a",
                 "WITH a AS (SELECT 2D AS close) INSERT INTO gate_target SELECT * FROM a",
                 "WITH a AS (SELECT 1) FROM a INSERT INTO gate_target SELECT 2D"):
        with pytest.raises(Exception):
            query_sql(spark, text)
    assert spark.read.parquet(target).count() == 1
