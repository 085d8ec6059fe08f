"""Moving a source table into the warehouse: parts, column alignment and three layers of checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.units import migration_scale, relative_difference
from ..model import AUDIT_COLUMNS, VERSION
from .audit import numeric_profile, union_all
from .versions import current


def aligned(df: DataFrame, target: Sequence[str], renames: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """The columns of `df` that a target has, under the target's names; bookkeeping columns of the source never go over."""
    known, unwanted = set(target), {*AUDIT_COLUMNS, *drop}
    named = df.drop(*unwanted).withColumnsRenamed(dict(renames or {}))
    return named.select([c for c in named.columns if c in known])


def _renamed(df: DataFrame, renames: Mapping[str, str] | None) -> list[str]:
    return df.withColumnsRenamed(dict(renames or {})).columns


def column_differences(source: DataFrame, target: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """(column_name, side) for every column of the two tables, side being both, source_only or target_only."""
    spark = source.sparkSession
    sides = spark.createDataFrame(
        [(c, True, False) for c in _renamed(source.drop(*AUDIT_COLUMNS), renames)] + [(c, False, True) for c in target.columns],
        "column_name string, in_source boolean, in_target boolean")
    side = F.when(F.bool_or("in_source") & F.bool_or("in_target"), "both").when(F.bool_or("in_source"), "source_only").otherwise("target_only")
    return sides.groupBy("column_name").agg(side.alias("side"))


def union_parts(parts: Mapping[str, DataFrame | None], columns: Sequence[str] | None = None,
                default: str | None = None) -> DataFrame:
    """One table from yearly parts in name order, the default part last; absent parts are skipped and a
    column a part lacks is NULL. Each row keeps the name of its part."""
    names = sorted(n for n, df in parts.items() if df is not None and n != default)
    names += [default] if default and parts.get(default) is not None else []
    if not names:
        raise ValueError("no part exists")
    frames = []
    for name in names:
        df = parts[name]
        kept = [c for c in columns if c in df.columns] if columns else df.columns
        frames.append(df.select(*kept, F.lit(name).alias("part")))
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def cross_part_duplicates(parts: Mapping[str, DataFrame], default: str, keys: Sequence[str], last: int = 2) -> DataFrame:
    """Keys that each of the newest parts shares with the default part; pairs without any are left out.

    The parts are compared with the default part in one distinct-key join, not pair by pair.
    """
    newest = sorted(n for n in parts if n != default)[-last:]
    tagged = union_all([parts[n].select(F.lit(n).alias("part"), *keys) for n in newest]).distinct()
    both = tagged.join(parts[default].select(*keys).distinct(), list(keys), "left_semi")
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("duplicates")).select(
        F.concat_ws(" & ", "part", F.lit(default)).alias("pair"), "duplicates"
    )


def sample_keys(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """A repeatable sample: the n keys of smallest md5. Each task keeps only its own n smallest."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.select(*keys).distinct().orderBy(F.md5(text), *keys).limit(n)


def newest(target: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """A target kept as a version log, resolved to one row per key; one without versions as it is."""
    return current(target, keys) if keys and VERSION in target.columns else target


def compare_cells(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  sample: int | None = None, tolerance: float = 1e-4) -> DataFrame:
    """First mismatching cell of each row present on both sides, scaled by the migration rule.

    A missing value on one side only is a mismatch; numbers may differ by `tolerance` relative; anything
    else must be equal. With `sample`, only that many keys are looked at.
    """
    if sample is not None:
        source = source.join(sample_keys(source, keys, sample), list(keys), "left_semi")
    left = source.select(*keys, *[F.col(c).alias(f"l_{c}") for c in columns])
    right = newest(target, keys).select(*keys, *[F.col(c).alias(f"r_{c}") for c in columns])
    types = {f.name: f.dataType for f in source.schema.fields}
    checks = []
    for c in columns:
        a, b = F.col(f"l_{c}"), F.col(f"r_{c}")
        if isinstance(types[c], T.NumericType):
            wanted = a.cast("double") * migration_scale(c)
            differs = relative_difference(b.cast("double"), wanted) > tolerance
        else:
            differs = a != b
        bad = F.when(a.isNull() & b.isNull(), False).when(a.isNull() | b.isNull(), True).otherwise(differs)
        cell = F.struct(F.lit(c).alias("column_name"), a.cast("string").alias("source_value"), b.cast("string").alias("target_value"))
        checks.append(F.when(bad, cell))
    first = F.coalesce(*checks)
    return left.join(right, list(keys)).withColumn("cell", first).filter(F.col("cell").isNotNull()).select(*keys, "cell.*")


def count_check(source: DataFrame, target_current: DataFrame) -> DataFrame:
    """Layer 1: source rows against current target rows."""
    target = target_current.agg(F.count(F.lit(1)))
    out = source.agg(F.count(F.lit(1)).alias("source_count")).withColumn("target_count", target.scalar())
    diff = F.col("target_count") - F.col("source_count")
    return out.withColumn("diff", diff).withColumn("passed", F.col("diff") == 0)


def sample_check(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 sample: int | None = None, shown: int = 10) -> tuple[DataFrame, DataFrame]:
    """Layer 2: verdict row, and the first `shown` mismatches by key."""
    bad = compare_cells(source, target, keys, columns, sample)
    verdict = bad.agg(F.count(F.lit(1)).alias("mismatches")).withColumn("passed", F.col("mismatches") == 0)
    return verdict, bad.orderBy(*keys).limit(shown)


def sum_check(source: DataFrame, target: DataFrame, columns: Sequence[str], limit: float = 0.01, keys: Sequence[str] | None = None) -> DataFrame:
    """Layer 3: sums within one percent after scaling, with minima and maxima of both sides. With `keys`, a target log counts
    the newest version of each key only."""
    target = newest(target, keys)
    left = numeric_profile(source, columns).select(
        "column_name", F.col("total").alias("source_sum"), F.col("low").alias("source_min"), F.col("high").alias("source_max"))
    right = numeric_profile(target, columns).select(
        "column_name", F.col("total").alias("target_sum"), F.col("low").alias("target_min"), F.col("high").alias("target_max"))
    scale = F.lit(None).cast("int")
    for c in columns:
        scale = F.when(F.col("column_name") == c, migration_scale(c)).otherwise(scale)
    joined = left.join(right, "column_name").withColumn("scale", scale)
    wanted = F.coalesce(F.col("source_sum"), F.lit(0.0)) * F.col("scale")
    diff = relative_difference(F.coalesce(F.col("target_sum"), F.lit(0.0)), wanted)
    return joined.withColumn("diff_pct", diff).withColumn("passed", F.col("diff_pct") < limit)


def day_checkpoints(current_rows: DataFrame, interface: str, date_column: str | None, as_of: Column) -> DataFrame:
    """One done checkpoint per distinct day with its row count; one `full` row for an undated table. The rows have all columns of the
    load-state log, so they can be appended to it; `as_of` is their moment and gives their version."""
    if date_column is None:
        out = current_rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("scope_key", F.lit("full"))
    else:
        out = current_rows.groupBy(date_column).agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "scope_key", F.concat(F.lit(f"{interface}:"), F.date_format(date_column, "yyyyMMdd"))
        )
    moment = as_of.cast("timestamp_ntz")
    return out.select(
        F.lit(interface).alias("interface"), "scope_key", F.lit("done").alias("status"), "rows", moment.alias("last_success_at"),
        moment.alias("heartbeat_at"), F.lit(0).alias("attempts"), F.lit("").alias("last_error"),
        F.unix_millis(moment.cast("timestamp")).alias(VERSION))
