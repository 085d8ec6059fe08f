import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.dates import is_day_text, months_between, parse_day, parse_moment, quarter_ends
from quotemill.functions.units import MONEY, SHARES, is_money, is_share_count, load_scale, migration_scale, readable_quantity
from quotemill.operators.normalize import infer_types, migrated, migration_projection, new_columns, normalize, with_drift
from quotemill.sources.payloads import explode_items, payload_fields, read_payloads

from .conftest import rows


@pytest.mark.parametrize("name", "total_revenue total_profit total_assets total_liab total_mv n_income oper_cost circ_mv total_oper_revenue".split())
def test_money_columns(name):
    assert is_money(name) and load_scale(name, MONEY) == 10_000
    assert load_scale(name, T.DoubleType()) == 1


@pytest.mark.parametrize("name", "total_share total_holders holder_total total_shares ts_code ann_date end_date amount".split())
def test_columns_that_are_not_money(name):
    assert not is_money(name) and load_scale(name, MONEY) == 1


def test_share_columns_scale_only_as_share_decimals():
    assert is_share_count("total_share") and load_scale("total_share", SHARES) == 10_000
    assert load_scale("total_share", MONEY) == 1
    assert is_share_count("fund_amount") and load_scale("close", SHARES) == 1


@pytest.mark.parametrize("name", "total_revenue total_mv circ_mv net_profit amount buy_elg_amount total_assets total_liab admin_expense fin_expense".split())
def test_migration_scales(name):
    assert migration_scale(name) == 10_000


@pytest.mark.parametrize("name", "vol turnover_rate pe_ttm basic_eps total_share buy_sm_vol revenue_yoy tax_rate profit_per_share".split())
def test_migration_keeps(name):
    assert migration_scale(name) == 1


DAYS = {
    "2024": dt.date(2024, 1, 1), "202403": dt.date(2024, 3, 1), "20240315": dt.date(2024, 3, 15), "2024-03-15": dt.date(2024, 3, 15),
    "2024/03/15": dt.date(2024, 3, 15), "2024-03-15 10:20:30": dt.date(2024, 3, 15), " 20240315 ": dt.date(2024, 3, 15),
    "2024031512": dt.date(2024, 3, 15), "20240230": None, "202413": None, "-": None, "null": None, "None": None, "NaN": None,
    "0000-00-00": None, "00000000": None, "": None, "  ": None, "2024-3-15": None, "2024-03": None, "abcd": None, "20240": None,
    "2024-3-15 xx": None, "１９９９": None,
}


def test_flexible_dates(spark):
    df = spark.createDataFrame([(k,) for k in DAYS], "s string").select("s", parse_day(F.col("s")))
    assert {r[0]: r[1] for r in df.collect()} == DAYS


def test_strict_dates(spark):
    df = spark.createDataFrame([("20240229",), ("20230229",), ("2024-02-29",), (None,), ("2024022",)], "s string")
    assert [r[0] for r in df.select(is_day_text(F.col("s"))).collect()] == [True, False, False, False, False]


MOMENTS = {
    "20240102": dt.datetime(2024, 1, 2), "2024-01-02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
    "2024/01/02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04:05.123": dt.datetime(2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02": None, "2024-01/02 03:04:05": None, "soon": None,
    "2024-13-02 03:04:05": None, "": None,
}


def test_moments(spark):
    df = spark.createDataFrame([(k,) for k in MOMENTS], "s string").select("s", parse_moment(F.col("s")))
    assert {r[0]: r[1] for r in df.collect()} == MOMENTS


def field(name, kind, nullable=True):
    return T.StructField(name, kind, nullable)


def one(spark, values, *fields):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return normalize(df, T.StructType(list(fields))).first().asDict()


def test_money_is_scaled_and_totals_of_shares_are_not(spark):
    out = one(spark, {"total_revenue": "100.5", "n_income": "50.2", "total_share": "100.0"},
              field("total_revenue", MONEY), field("n_income", MONEY), field("total_share", MONEY))
    assert (out["total_revenue"], out["n_income"], out["total_share"]) == (Decimal("1005000.00"), Decimal("502000.00"), Decimal("100.00"))
    assert out["_rejects"] == []


def test_defaults_and_nulls(spark):
    out = one(spark, {"total_revenue": None, "n_income": None, "name": " ", "d": "", "k": " ", "e": "1960-05-01"},
              field("total_revenue", MONEY, False), field("n_income", MONEY), field("name", T.StringType(), False),
              field("d", T.DateType(), False), field("k", T.LongType(), False), field("e", T.DateType(), True))
    assert out == {"total_revenue": Decimal("0.00"), "n_income": None, "name": "", "d": dt.date(1970, 1, 1), "k": 0, "e": None, "_rejects": ["e"]}


def test_undeclared_columns_parse_dates_only(spark):
    out = one(spark, {"trade_date": "20240102", "total_revenue": "100.0"})
    assert out == {"trade_date": dt.date(2024, 1, 2), "total_revenue": "100.0", "_rejects": []}


def test_invalid_numbers_are_rejected(spark):
    out = one(spark, {"total_revenue": "n/a", "vol": "1e3", "at": "later"}, field("total_revenue", MONEY), field("vol", T.DoubleType()),
              field("at", T.TimestampNTZType()))
    assert out == {"total_revenue": None, "vol": 1000.0, "at": None, "_rejects": ["total_revenue", "at"]}


def test_numbers_become_text_in_text_columns(spark):
    df = spark.createDataFrame([(7, 20240102)], "code bigint, f_date bigint").select("code")
    assert normalize(df, T.StructType([field("code", T.StringType())])).first()[0] == "7"


def test_migrated_values(spark):
    df = spark.createDataFrame([(1.5, float("nan"), 2.0, "x"), (float("inf"), 1.0, None, None)], "amount double, net_profit double, vol double, note string")
    assert rows(migrated(df).fillna({"amount": -1.0, "net_profit": -1.0, "vol": -1.0, "note": ""})) == [(-1.0, 10000.0, -1.0, ""), (15000.0, -1.0, 2.0, "x")]


def test_migration_types(spark):
    df = spark.sql("SELECT true AS b, CAST(1 AS smallint) AS s, CAST(1.5 AS decimal(10,2)) AS d, array(1) AS j, CAST('a' AS string) AS t, "
                   "TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS m")
    out = migration_projection(df)
    assert dict(out.dtypes) == {"b": "tinyint", "s": "smallint", "d": "double", "j": "string", "t": "string", "m": "timestamp_ntz"}
    assert out.first()["m"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000) and out.first()["j"] == "[1]"


def test_declared_text_with_a_date_name_stays_text(spark):
    out = one(spark, {"update_flag": "20240102", "end_date": "n/a"}, field("update_flag", T.StringType()), field("end_date", T.StringType()))
    assert out["update_flag"] == "2024-01-02" and isinstance(out["end_date"], str | None) and out["_rejects"] == ["end_date"]


def test_required_text_with_a_date_name_stays_text(spark):
    for raw, want in (("20240102", "2024-01-02"), ("1", ""), ("", ""), (None, "")):
        assert one(spark, {"update_flag": raw}, T.StructField("update_flag", T.StringType(), False))["update_flag"] == want


def test_a_filter_does_not_repeat_the_parsing(spark):
    df = spark.createDataFrame([("x", "2024-01-02", "1.5")], "k string, end_date string, amount string")
    schema = T.StructType([T.StructField("end_date", T.DateType()), T.StructField("amount", T.DoubleType())])
    plain, kept = (x._jdf.queryExecution().optimizedPlan().toString() for x in (normalize(df, schema), normalize(df, schema).filter(F.size("_rejects") > 0)))
    assert kept.count("translate(") == plain.count("translate(") > 0 and "Filter" in kept


def test_drift_survives_a_value_the_type_cannot_hold(spark):
    out = with_drift(spark.createDataFrame([("a", 1.0)], "k string, v double"), spark.createDataFrame([("b", "n/a")], "k string, v string"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1.0), ("b", None)]


def test_drift_adds_text_columns(spark):
    table = spark.createDataFrame([("a", 1.0)], "k string, v double")
    drifted = spark.createDataFrame([("b", 2, 3)], "k string, v int, extra int")
    assert new_columns(table, drifted) == ["extra"]
    out = with_drift(table, drifted)
    assert dict(out.dtypes) == {"k": "string", "v": "double", "extra": "string"}
    assert sorted(tuple(r) for r in out.fillna("", ["extra"]).collect()) == [("a", 1.0, ""), ("b", 2.0, "3")]


WRAPPED = '{"code":0,"data":{"fields":["ts_code","trade_date","close"],"items":[["000001.SZ","20240101",15.5]]}}'
PLAIN = '{"fields":["a","b"],"items":[[1,2],[3]]}'
EMPTY = '{"data":{"fields":["a"],"items":[]}}'


def test_payload_shapes(spark):
    df = spark.createDataFrame([(WRAPPED,)], "p string")
    assert rows(explode_items(df, "p", ["ts_code", "trade_date", "close"]).drop("item_pos")) == [("000001.SZ", "20240101", "15.5")]
    plain = explode_items(spark.createDataFrame([(PLAIN,)], "p string"), "p", ["a", "b", "zz"])
    assert [tuple(r) for r in plain.orderBy("item_pos").collect()] == [(0, "1", "2", None), (1, "3", None, None)]
    empty = spark.createDataFrame([(EMPTY,)], "p string")
    assert explode_items(empty, "p", ["a"]).count() == 0 and payload_fields(empty, "p").first()[0] == ["a"]


def test_payload_files_skip_missing_names(spark, tmp_path):
    (tmp_path / "one.json").write_text(WRAPPED)
    (tmp_path / "two.json").write_text(PLAIN.replace("],[", "],\n["))
    got = read_payloads(spark, str(tmp_path), ["one", "two", "absent"])
    assert sorted(r["name"] for r in got.collect()) == ["one", "two"]
    assert explode_items(got.filter("name = 'two'"), "payload", ["a"]).count() == 2


def infer(spark, payload, fields, **kw):
    cells = explode_items(spark.createDataFrame([(payload,)], "p string"), "p", fields, "variant")
    return {r["field"]: r["type"] for r in infer_types(cells, fields, F.col("item_pos"), **kw).collect()}


def test_inference_rules(spark):
    payload = ('{"fields":["ts_code","d","iso","at","n","x","txt","nil","oper_income","fund_share"],"items":['
               '["000001.SZ",null,"2024-01-01","2024-01-01 10:00:00",1,1,"20240101x",null,1,1],'
               '["000001.SZ","20240101","x","y",2,1.5,"20240101","",1,1]]}')
    fields = ["ts_code", "d", "iso", "at", "n", "x", "txt", "nil", "oper_income", "fund_share"]
    assert infer(spark, payload, fields) == {
        "ts_code": "string", "d": "date", "iso": "date", "at": "timestamp", "n": "bigint", "x": "double", "txt": "string",
        "nil": "string", "oper_income": "decimal(18,2)", "fund_share": "decimal(18,4)", "_version": "bigint"}


def test_inference_overrides_and_numbers_that_look_like_days(spark):
    out = infer(spark, '{"fields":["custom_col","day"],"items":[[123,20240101]]}', ["custom_col", "day"], overrides={"custom_col": "string"})
    assert out == {"custom_col": "string", "day": "bigint", "_version": "bigint"}


def test_quarters_and_months(spark):
    day = lambda s: F.lit(s).cast("date")
    got = spark.range(1).select(quarter_ends(day("2023-03-31"), day("2024-01-15")).alias("q"), quarter_ends(day("2024-02-01"), day("2024-01-01")).alias("none"),
                                months_between(day("2023-11-20"), day("2024-01-02")).alias("m")).first()
    assert got["q"] == [dt.date(2023, 3, 31), dt.date(2023, 6, 30), dt.date(2023, 9, 30), dt.date(2023, 12, 31)]
    assert got["none"] == [] and got["m"] == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1)]


def test_readable_counts(spark):
    df = spark.createDataFrame([(950,), (1250,), (81_750_000,), (7_000_000_000,)], "n bigint").select(readable_quantity(F.col("n")))
    assert [r[0] for r in df.collect()] == ["950", "1.25 thousand", "81.75 million", "7.00 billion"]


def test_payloads_of_many_codes_share_a_file(spark, tmp_path):
    texts = [f'{{"fields":["ts_code","vol"],"items":[["{k}",{k}]]}}' for k in range(50)]
    spark.createDataFrame([(x,) for x in texts], "payload string").coalesce(2).write.text(str(tmp_path / "lines"))
    got = read_payloads(spark, str(tmp_path / "lines"), pattern="*.txt", lines=True)
    assert sorted(r["payload"] for r in got.collect()) == sorted(texts) and got.select("name").distinct().count() == 2
