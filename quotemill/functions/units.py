"""Which columns are stored in units of ten thousand. Two rule sets exist and stay apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

SCALE = 10_000

# Load-path rule. Money suffixes, totals that are money, totals that are not.
MONEY_SUFFIXES = (
    "_amount", "_revenue", "_profit", "_cost", "_income",
    "_expense", "_asset", "_liability", "_equity", "_mv",
)
MONEY_TOTALS = (
    "total_revenue", "total_profit", "total_cogs", "total_assets",
    "total_liab", "total_hldr_eqy", "total_hldr_eqy_exc_min_int",
    "total_mv", "total_cur_assets", "total_nca", "total_cur_liab",
    "total_ncl", "total_oper_revenue", "total_oper_cost",
    "total_non_current_asset", "total_current_asset",
    "total_current_liab", "total_non_current_liab",
)
COUNT_TOTALS = ("total_share", "total_holders", "holder_total", "total_holder", "total_shares")
SHARE_SUFFIXES = ("_share", "_amount")

# Migration rule. Substrings that mark a scaled column, endings and names that do not.
MIGRATED_PARTS = (
    "amount", "revenue", "profit", "income", "cost",
    "expense", "asset", "liability", "liab", "equity",
    "mv", "capital", "surplus", "tax",
    "ebit", "ebitda", "fcff", "fcfe", "interest", "debt",
    "dividend",
)
UNSCALED_ENDINGS = (
    "_pct", "_rate", "_ratio", "_price", "_days",
    "_yoy", "_qoq", "_cost_ratio", "_tax_rate",
    "_per_share", "_share_pct", "_vol",
)
UNSCALED_NAMES = ("vol", "amount_vol", "turnover_rate", "pe", "pe_ttm", "pb", "ps", "ps_ttm")

MONEY = T.DecimalType(18, 2)
SHARES = T.DecimalType(18, 4)


def is_money(name: str) -> bool:
    name = name.lower()
    return name not in COUNT_TOTALS and (name.endswith(MONEY_SUFFIXES) or name in MONEY_TOTALS)


def is_share_count(name: str) -> bool:
    return name.lower().endswith(SHARE_SUFFIXES)


def load_scale(name: str, kind: T.DataType) -> int:
    """Factor of the load path; it depends on the declared decimal type and on the name."""
    scaled = (kind == MONEY and is_money(name)) or (kind == SHARES and is_share_count(name))
    return SCALE if scaled else 1


def migration_scale(name: str) -> int:
    """Factor of the migration path; it depends on the name alone."""
    name = name.lower()
    if name in UNSCALED_NAMES or name.endswith(UNSCALED_ENDINGS):
        return 1
    return SCALE if any(part in name for part in MIGRATED_PARTS) else 1


def migrated_value(name: str, col: Column, kind: T.DataType) -> Column:
    """Scaled value for the migration target; NaN and infinities become NULL."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        infinite = col.isin(float("inf"), float("-inf"))
        col = F.when(~(F.isnan(col) | infinite), col)
    elif not isinstance(kind, T.NumericType):
        return col
    if migration_scale(name) == 1:
        return col
    return (col.cast("double") if isinstance(kind, T.DecimalType) else col) * SCALE


def relative_difference(left: Column, right: Column) -> Column:
    return F.abs(left - right) / F.greatest(F.abs(right), F.lit(1.0))


def readable_quantity(count: Column) -> Column:
    """Counts as text: 950, 1.25 thousand, 3.40 million, 7.00 billion, 1.00 trillion."""
    text = count.cast("string")
    for size, word in ((10**3, "thousand"), (10**6, "million"), (10**9, "billion"), (10**12, "trillion")):
        hundredths = F.floor(count / (size // 100) + F.lit(0.5)).cast("bigint")
        scaled = F.concat(
            F.floor(hundredths / 100).cast("string"), F.lit("."),
            F.lpad((hundredths % 100).cast("string"), 2, "0"), F.lit(f" {word}"),
        )
        text = F.when(count >= size, scaled).otherwise(text)
    return text
