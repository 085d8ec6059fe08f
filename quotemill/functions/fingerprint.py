"""Order-independent fingerprints: an XOR of row hashes, combined map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def portable_row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """60-bit hash any engine with md5 can repeat; fractions enter as ten-thousandths."""
    parts = []
    for name in columns:
        col, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.floor(col.cast("double") * 10_000 + 0.5).cast("bigint")
        parts.append(F.coalesce(col.cast("string"), F.lit("~")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None,
                version: str = "_version", portable: bool = False) -> DataFrame:
    """Row count, XOR of row hashes and newest version, per group or for the whole table."""
    columns = list(columns or df.columns)
    hashed = portable_row_hash(df, columns) if portable else row_hash(columns)
    return (
        df.select(*by, version, hashed.alias("_hash"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.bit_xor("_hash").alias("fingerprint"),
            F.max(version).alias("max_version"),
        )
    )
