"""Validity predicates on user-facing values; each returns a non-null boolean."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..model import CODE_PATTERN, DATE_PATTERN, EXCHANGES, STATEMENTS


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_code(col: Column) -> Column:
    return _known(col.rlike(CODE_PATTERN))


def is_date_shape(col: Column) -> Column:
    return _known(col.rlike(DATE_PATTERN))


def is_exchange(col: Column) -> Column:
    return _known(col.isin(*EXCHANGES))


def is_statement(col: Column) -> Column:
    return _known(col.isin(*STATEMENTS))


def with_reason(df: DataFrame, rules: dict[str, Column], name: str = "reason") -> DataFrame:
    """Add the first failing rule's label, NULL for a valid row."""
    chain = reduce(
        lambda acc, rule: acc.when(~rule[1], F.lit(rule[0])),
        list(rules.items())[1:],
        F.when(~next(iter(rules.values())), F.lit(next(iter(rules)))),
    )
    return df.withColumn(name, chain)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reason; two lazy filters over one plan."""
    marked = with_reason(df, rules)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def require(value: str, pattern: str, what: str) -> str:
    """Check one call argument on the driver."""
    if not isinstance(value, str) or not re.fullmatch(pattern, value):
        raise ValueError(f"invalid {what}: {value!r}")
    return value
