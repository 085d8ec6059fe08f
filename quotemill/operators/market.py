"""Market and fundamentals queries. Tables are passed as version logs; every query resolves them first.

`codes` is one code, a list of codes, or None for the whole market. Key filters written above the
version resolution are pushed below it by Catalyst, down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.checks import require
from ..model import ADJ_FACTOR, BARS, CODE_PATTERN, DATE_PATTERN, INDEX_WEIGHT, FINANCIALS, MONEYFLOW, STATEMENTS
from .calendar import _day
from .versions import current

PRICES = ("open", "high", "low", "close")
BAR_COLUMNS = (*PRICES, "vol", "amount", "pct_chg")


def _codes(df: DataFrame, codes: str | Sequence[str] | None) -> DataFrame:
    if codes is None:
        return df
    codes = [require(c, CODE_PATTERN, "ts_code") for c in ([codes] if isinstance(codes, str) else codes)]
    return df.filter("ts_code IN ({})".format(", ".join(f"'{c}'" for c in codes)))


def _days(df: DataFrame, start: str | None, end: str | None, column: str = "trade_date") -> DataFrame:
    bounds = []
    if start is not None:
        bounds.append(f"{column} >= to_date('{require(start, DATE_PATTERN, 'start date')}', 'yyyyMMdd')")
    if end is not None:
        bounds.append(f"{column} <= to_date('{require(end, DATE_PATTERN, 'end date')}', 'yyyyMMdd')")
    return df.filter(" AND ".join(bounds)) if bounds else df


def latest_per_key(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Newest value per key as a plain hash aggregate with map-side combine."""
    return df.groupBy(key).agg(
        F.max(order).alias(order), F.max_by(value, order).alias(value)
    )


def ohlcv(bars: DataFrame, factors: DataFrame | None = None, codes: str | Sequence[str] | None = None,
          start: str | None = None, end: str | None = None, adjust: str = "qfq") -> DataFrame:
    """Daily bars: raw (none), rebased to the newest factor (qfq) or to the first listing (hfq).

    The newest factor is taken over the whole history of a code, not over the requested days. Days
    without a factor are dropped by the adjusted forms. Both tables resolve on (ts_code, trade_date), so
    the join that follows needs no further shuffle.
    """
    if adjust not in ("none", "qfq", "hfq"):
        raise ValueError(f"adjust must be none, qfq or hfq, got {adjust!r}")
    rows = _days(_codes(current(bars.select(*BARS.keys, *BAR_COLUMNS, BARS.version), BARS.keys), codes), start, end)
    rows = rows.drop(BARS.version)
    if adjust == "none":
        return rows
    known = _codes(current(factors.select(*ADJ_FACTOR.keys, "adj_factor", ADJ_FACTOR.version), ADJ_FACTOR.keys), codes)
    known = known.drop(ADJ_FACTOR.version)
    joined = rows.join(_days(known, start, end), list(BARS.keys))
    rebased = "adj_factor"
    if adjust == "qfq":
        latest = latest_per_key(known, "ts_code", "trade_date", "adj_factor")
        joined = joined.join(latest.selectExpr("ts_code", "adj_factor AS latest_factor"), "ts_code")
        rebased = "adj_factor / latest_factor"
    prices = [f"round({c} * {rebased}, 4) AS {c}" for c in PRICES]
    return joined.selectExpr("ts_code", "trade_date", *prices, "vol", "amount", "pct_chg")


def by_day(df: DataFrame, column: str = "trade_date", descending: bool = False) -> DataFrame:
    """Presentation order: by day, then by code."""
    day = F.col(column).desc() if descending else F.col(column)
    return df.orderBy(day, *[c for c in ("ts_code", "con_code") if c in df.columns])


def financials(df: DataFrame, codes: str | Sequence[str] | None = None, statement: str | None = None,
               periods: Sequence[str] | None = None) -> DataFrame:
    """Statement rows of one kind (or all four), for some fiscal periods (or all)."""
    rows = _codes(current(df, FINANCIALS.keys), codes)
    if statement is not None:
        if statement not in STATEMENTS:
            raise ValueError(f"unknown statement: {statement!r}")
        rows = rows.filter(F.col("statement") == statement)
    if periods:
        days = [_day(require(p, DATE_PATTERN, "period")) for p in periods]
        rows = rows.filter(F.col("end_date").isin(*days))
    return rows


def index_components(df: DataFrame, index_code: str | None = None, date: str | None = None) -> DataFrame:
    rows = current(df, INDEX_WEIGHT.keys)
    if index_code is not None:
        rows = rows.filter(F.col("index_code") == index_code)
    return rows if date is None else _days(rows, date, date)


def moneyflow(df: DataFrame, codes: str | Sequence[str] | None = None,
              start: str | None = None, end: str | None = None) -> DataFrame:
    return _days(_codes(current(df, MONEYFLOW.keys), codes), start, end)


def symbols(df: DataFrame | None, spark=None) -> DataFrame:
    """Distinct codes of a source table; an absent table gives no rows."""
    if df is None:
        return spark.createDataFrame([], "ts_code string")
    return df.select("ts_code").distinct()
