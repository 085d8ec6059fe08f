"""Which load units should exist: one row per expected scope, derived from declarations and calendars.

Each function takes `interfaces` (interface, strategy, exchange, date_field, start_date, ...) and returns
(interface, strategy, scope_key, params). Period and month lists are exploded from per-row arrays, so
nothing is cross-joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import day_text, month_text, months_between, quarter_ends

COLUMNS = ("interface", "strategy", "scope_key", "params")


def key(*parts: Column) -> Column:
    """Scope key text: the interface and the parts that tell its units apart."""
    return F.concat_ws(":", F.col("interface"), *parts)


def _of(interfaces: DataFrame, strategy: str) -> DataFrame:
    return interfaces.filter(F.col("strategy") == strategy)


def _units(df: DataFrame, params: Column, *parts: Column) -> DataFrame:
    return df.select("interface", "strategy", key(*parts).alias("scope_key"), params.alias("params"))


def full_once(interfaces: DataFrame) -> DataFrame:
    return _units(_of(interfaces, "full_once"), F.create_map().cast("map<string,string>"), F.lit("full"))


def _open_days(interfaces: DataFrame, cal: DataFrame, as_of: Column) -> DataFrame:
    days = cal.filter(F.col("is_open") == 1).select("exchange", "cal_date")
    return interfaces.join(days, "exchange").filter(F.col("cal_date").between(F.col("start_date"), as_of))


def date_loop(interfaces: DataFrame, cal: DataFrame, as_of: Column) -> DataFrame:
    """One unit per open day of the interface's exchange, the parameter named by date_field."""
    df = _open_days(_of(interfaces, "date_loop"), cal, as_of).withColumn("day", day_text(F.col("cal_date")))
    field = F.coalesce("date_field", F.lit("trade_date"))
    return _units(df, F.create_map(field, "day"), F.col("day"))


def period_loop(interfaces: DataFrame, as_of: Column) -> DataFrame:
    df = _of(interfaces, "period_loop").withColumn("period", F.explode(quarter_ends(F.col("start_date"), as_of)))
    period = day_text(F.col("period"))
    return _units(df, F.create_map(F.lit("period"), period), period)


def monthly_window(interfaces: DataFrame, as_of: Column) -> DataFrame:
    df = _of(interfaces, "monthly_window").withColumn("month", F.explode(months_between(F.col("start_date"), as_of)))
    month = month_text(F.col("month"))
    return _units(df, F.create_map(F.lit("month"), month), month)


def per_symbol(interfaces: DataFrame, symbols: DataFrame, as_of: Column) -> DataFrame:
    """One unit per symbol of the interface's symbol source; the day only when a single day is asked for."""
    df = _of(interfaces, "per_symbol").join(symbols, "symbol_source")
    code = F.create_map(F.lit("ts_code"), F.col("ts_code"))
    day = F.map_concat(code, F.create_map(F.col("date_field"), day_text(as_of)))
    single = (F.col("start_date") == as_of) & F.col("date_field").isNotNull()
    return _units(df, F.when(single, day).otherwise(code), F.col("ts_code"))


def per_symbol_period(interfaces: DataFrame, symbols: DataFrame, as_of: Column) -> DataFrame:
    """Symbols times quarters: the quarters of an interface are an array that each symbol row explodes."""
    own = _of(interfaces, "per_symbol_period").withColumn("quarters", quarter_ends(F.col("start_date"), as_of))
    df = own.join(symbols, "symbol_source").withColumn("quarter", F.explode("quarters"))
    df = df.withColumn("period", day_text(F.col("quarter")))
    params = F.create_map(F.lit("ts_code"), F.col("ts_code"), F.lit("period"), F.col("period"))
    return _units(df, params, F.col("ts_code"), F.col("period"))


def offset_paging(interfaces: DataFrame, cal: DataFrame, day_rows: DataFrame, as_of: Column,
                  page_size: int = 5000) -> DataFrame:
    """One unit per page of each open day. `day_rows` holds known row counts (interface, trade_date,
    row_count); a day without a count still gets its first page."""
    days = _open_days(_of(interfaces, "offset_paging"), cal, as_of)
    known = day_rows.select("interface", F.col("trade_date").alias("cal_date"), "row_count")
    pages = F.greatest(F.ceil(F.coalesce("row_count", F.lit(0)) / page_size), F.lit(1)).cast("bigint")
    df = (
        days.join(known, ["interface", "cal_date"], "left")
        .withColumn("page", F.explode(F.sequence(F.lit(0).cast("bigint"), pages - 1)))
        .withColumn("offset", F.col("page") * page_size)
        .withColumn("day", day_text(F.col("cal_date")))
    )
    params = F.create_map(
        F.lit("trade_date"), F.col("day"), F.lit("offset"), F.col("offset").cast("string"),
        F.lit("limit"), F.lit(str(page_size)),
    )
    return _units(df, params, F.col("day"), F.lpad(F.col("offset").cast("string"), 8, "0"))


def expected_units(interfaces: DataFrame, cal: DataFrame, symbols: DataFrame, day_rows: DataFrame,
                   as_of: Column, page_size: int = 5000) -> DataFrame:
    """All expected units of all seven strategies."""
    return reduce(DataFrame.unionByName, [
        full_once(interfaces),
        date_loop(interfaces, cal, as_of),
        period_loop(interfaces, as_of),
        monthly_window(interfaces, as_of),
        per_symbol(interfaces, symbols, as_of),
        per_symbol_period(interfaces, symbols, as_of),
        offset_paging(interfaces, cal, day_rows, as_of, page_size),
    ])


def incremental(interfaces: DataFrame, cal: DataFrame, as_of: Column) -> DataFrame:
    """Units of the last open day only: the plan starts and ends on that day."""
    from .calendar import latest_trade_date

    day = cal.filter(F.col("cal_date") == latest_trade_date(cal, as_of).scalar())
    return date_loop(interfaces, day, as_of)
