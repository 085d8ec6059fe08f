"""Trading-calendar operators. A calendar has one row per exchange and day, so it is small by nature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..model import EXCHANGES


def with_previous_open_day(days: DataFrame) -> DataFrame:
    """Add pretrade_date: the last open day before cal_date on the same exchange."""
    before = Window.partitionBy("exchange").orderBy("cal_date").rowsBetween(Window.unboundedPreceding, -1)
    open_day = F.when(F.col("is_open") == 1, F.col("cal_date"))
    return days.withColumn("pretrade_date", F.last(open_day, ignorenulls=True).over(before))


def trade_calendar(cal: DataFrame, start: str | Column, end: str | Column, exchange: str = "SSE") -> DataFrame:
    if exchange not in EXCHANGES:
        raise ValueError(f"invalid exchange: {exchange!r}")
    return (
        cal.filter((F.col("exchange") == exchange) & F.col("cal_date").between(_day(start), _day(end)))
        .select("cal_date", "is_open", "pretrade_date")
        .orderBy("cal_date")
    )


def latest_trade_date(cal: DataFrame, as_of: str | Column) -> DataFrame:
    """One row: the last open day up to as_of, NULL when there is none."""
    return cal.filter((F.col("is_open") == 1) & (F.col("cal_date") <= _day(as_of))).agg(
        F.max("cal_date").alias("trade_date")
    )


def trade_dates(cal: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Distinct open days of any exchange."""
    return (
        cal.filter((F.col("is_open") == 1) & F.col("cal_date").between(_day(start), _day(end)))
        .select("cal_date")
        .distinct()
    )


def _day(value: str | Column) -> Column:
    """A call argument as a date: YYYYMMDD, YYYY-MM-DD or a column."""
    if isinstance(value, Column):
        return value
    return F.to_date(F.lit(value.replace("-", "")), "yyyyMMdd")
