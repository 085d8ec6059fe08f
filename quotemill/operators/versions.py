"""Newest-version-per-key resolution and everything built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..model import SCOPE_DATE_COLUMNS, VERSION
from ..session import scratch_path

_RANK = "_rank"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def newest_rank(df: DataFrame, keys: Sequence[str], version: str = VERSION, within: Sequence[str] = ()) -> Column:
    """Rank of a row inside its key (and `within`), 1 for the newest version. Ties are ordered by a hash of
    the remaining columns, so they resolve the same way on every run."""
    rest = [c for c in df.columns if c not in (*keys, *within, version)]
    tie = f", xxhash64({_names(rest)}) DESC" if rest else ""
    return F.expr(f"row_number() OVER (PARTITION BY {_names([*keys, *within])} ORDER BY `{version}` DESC{tie})")


def current(df: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """One row per key, the newest. The row_number = 1 shape lets Spark drop older versions of a
    key before the shuffle (WindowGroupLimit), so a key with very many versions stays cheap."""
    return df.withColumn(_RANK, newest_rank(df, keys, version)).filter(f"{_RANK} = 1").drop(_RANK)


def history(df: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """All versions with their rank per key, 1 being the newest.

    One key may own very many versions, so no window spans a whole key. Versions are cut into blocks of
    2^12 and 2^24 units: rows are ranked inside a small block, and blocks are ranked by their counts.
    With millisecond versions the widest window holds one row per 4.7 hours of one key's history.
    """
    def block(bits: int) -> Column:
        return F.shiftright(F.col(version), bits)

    cut = df.withColumn("_small", block(12)).withColumn("_large", block(24))
    small = cut.groupBy(*keys, "_large", "_small").agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy(*keys, "_large").orderBy(F.col("_small").desc())
    small = small.withColumn("_before", F.sum("_n").over(newer) - F.col("_n"))
    large = small.groupBy(*keys, "_large").agg(F.sum("_n").alias("_m"))
    newer = Window.partitionBy(*keys).orderBy(F.col("_large").desc())
    large = large.withColumn("_earlier", F.sum("_m").over(newer) - F.col("_m"))
    offsets = small.join(large, [*keys, "_large"]).select(
        *keys, "_large", "_small", (F.col("_before") + F.col("_earlier")).alias("_offset")
    )
    return (
        cut.withColumn(_RANK, newest_rank(cut, keys, version, ("_large", "_small")))
        .join(offsets, [*keys, "_large", "_small"])
        .withColumn("version_rank", (F.col(_RANK) + F.col("_offset")).cast("bigint"))
        .drop(_RANK, "_small", "_large", "_offset")
    )


def with_version(df: DataFrame, version: int | Column, name: str = VERSION) -> DataFrame:
    """Stamp rows with a version; an existing column is replaced, never doubled."""
    return df.withColumn(name, (version if isinstance(version, Column) else F.lit(version)).cast("bigint"))


def row_version(updated_at: Column, created_at: Column, loaded_at: Column, zone: str = "Asia/Shanghai") -> Column:
    """Milliseconds of updated_at, else created_at, read as local times of `zone`, else of loaded_at (UTC)."""
    def millis(local: Column, tz: str) -> Column:
        return F.unix_millis(F.convert_timezone(F.lit(tz), F.lit("UTC"), local.cast("timestamp_ntz")).cast("timestamp"))

    return F.coalesce(millis(updated_at, zone), millis(created_at, zone), millis(loaded_at, "UTC"))


def replay_changes(df: DataFrame, replayed: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    """Current rows that differ, apart from the version, after appending `replayed`; empty when idempotent."""
    before = current(df, keys, version).drop(version)
    after = current(df.unionByName(replayed), keys, version).drop(version)
    return after.exceptAll(before)


def compact(spark: SparkSession, df: DataFrame, keys: Sequence[str], partition: str | None = None,
            path: str | None = None, version: str = VERSION) -> DataFrame:
    """Write only the current rows to a new path and return a reader of it.

    The old path is never overwritten in place: a lost executor can rerun its tasks, and readers of the
    old files are not disturbed. The caller swaps paths.
    """
    path = path or scratch_path(spark, "compact")
    rows = current(df, keys, version)
    write_clustered(rows, path, keys, partition)
    return spark.read.schema(rows.schema).parquet(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], partition: str | None = None,
                    mode: str = "errorifexists") -> int:
    """Write rows together by partition (by the first key without one) and sorted by keys, so row groups carry tight statistics; returns how many.

    The rebalancing shuffle reads its input once: nothing is sampled. Adaptive execution splits a partition that holds most rows
    among many tasks, by measured size, and joins small ones. With mode `overwrite` and a partition, only the partitions that `df` has rows of are
    replaced, at the commit of the job.
    """
    seen = Observation()
    by = [*([partition] if partition else []), *keys]
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", F.col(by[0])).sortWithinPartitions(*by)
    writer = rows.write.mode(mode).option("maxRecordsPerFile", 20_000_000).option("partitionOverwriteMode", "dynamic" if partition else "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return seen.get["rows"]


def compact_months(spark: SparkSession, path: str, keys: Sequence[str], partition: str, since: int, version: str = VERSION) -> list[int]:
    """Compact, in place, only the partitions that hold a version above `since`; returns their values. The others keep their files.

    The newest rows are written aside first, then replace their partitions in one commit, so an executor or a job that is lost on
    the way leaves a table that reads the same and can be compacted again.
    """
    table = spark.read.parquet(path)
    touched = sorted(r[0] for r in table.filter(F.col(version) > since).select(partition).distinct().collect())  # a calendar's months at most
    if touched:
        aside = scratch_path(spark, "compact-months")
        current(table.filter(F.col(partition).isin(touched)), [partition, *keys], version).write.parquet(aside)  # a file a task, not one for each month of each task
        rows = spark.read.schema(table.schema).parquet(aside)
        write_clustered(rows.select(*table.columns), path, keys, partition, mode="overwrite")
    return touched


SHAPE = "_shape"


def scope_names(df: DataFrame, scopes: DataFrame) -> list[str]:
    """The columns by which scopes can name rows of a table: ts_code, the date columns of the model, and period (eight digits,
    matched on the month of end_date)."""
    names = [c for c in ("ts_code", *SCOPE_DATE_COLUMNS) if c in scopes.columns and c in df.columns]
    return [*names, "period"] if "period" in scopes.columns and "end_date" in df.columns else names


def scope_shapes(names: Sequence[str]) -> list[tuple[str, ...]]:
    """Which columns a scope can set together: a code, one date column, a period, each or none."""
    codes, periods = [[n, None] if n in names else [None] for n in ("ts_code", "period")]
    dates = [*(n for n in names if n in SCOPE_DATE_COLUMNS), None]
    return [tuple(c for c in (code, day, period) if c) for code in codes for day in dates for period in periods]


def shape_number(names: Sequence[str], shape: Sequence[str]) -> int:
    """The shape as bits, the first name's the highest, as grouping_id counts them."""
    return sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n in shape)


def with_scope(scopes: DataFrame, names: Sequence[str]) -> DataFrame:
    """`scopes` with the values that count, as `_s_` columns (the first date column that is set; the month of a period), and their shape."""
    values: dict[str, Column] = {}
    earlier = F.lit(True)
    for name in names:
        value = F.col(name)
        if name in SCOPE_DATE_COLUMNS:
            value, earlier = F.when(earlier, value), earlier & value.isNull()
        values[name] = F.substring(value, 1, 6) if name == "period" else value
    shape = F.lit(0)
    for name, value in values.items():
        shape = shape + F.when(value.isNotNull(), shape_number(names, [name])).otherwise(0)
    return scopes.select("*", *[v.alias(f"_s_{n}") for n, v in values.items()], shape.cast("bigint").alias(SHAPE))


def scope_values(names: Sequence[str]) -> list[Column]:
    """The table's side of the same columns."""
    return [(F.date_format("end_date", "yyyyMM") if n == "period" else F.col(n)).alias(f"_s_{n}") for n in names]


def same_scope(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    same = left[SHAPE] == right[SHAPE]
    for n in names:
        same = same & left[f"_s_{n}"].eqNullSafe(right[f"_s_{n}"])
    return same


def _named(df: DataFrame, scopes: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows of `df` with their scope values, and the distinct scope values that some scope names."""
    names = scope_names(df, scopes)
    rows = df.select("*", *scope_values(names))
    columns = [f"_s_{n}" for n in names]
    # Every value tuple once for each shape it could be named by; columns outside the shape are null, as on the scopes' side.
    forms = F.explode(F.array(*[
        F.struct(F.lit(shape_number(names, shape)).cast("bigint").alias(SHAPE),
                 *[(F.col(f"_s_{n}") if n in shape else F.lit(None)).cast(rows.schema[f"_s_{n}"].dataType).alias(f"_f_{n}") for n in names])
        for shape in scope_shapes(names) if shape]))
    tuples = rows.select(*columns).distinct().withColumn("_form", forms).select(*columns, "_form.*")
    wanted = with_scope(scopes, names).filter(F.col(SHAPE) > 0).select(SHAPE, *columns).distinct()
    hit = tuples[SHAPE] == wanted[SHAPE]
    for n in names:
        hit = hit & tuples[f"_f_{n}"].eqNullSafe(wanted[f"_s_{n}"])
    return rows, tuples.join(wanted, hit, "left_semi").select(*columns).distinct(), columns


def _scoped(df: DataFrame, scopes: DataFrame, how: str) -> DataFrame:
    if not scope_names(df, scopes):
        return df if how == "left_anti" else df.limit(0)
    rows, named, columns = _named(df, scopes)
    same = F.lit(True)
    for c in columns:
        same = same & rows[c].eqNullSafe(named[c])
    return rows.join(named, same, how).select(*df.columns)


def delete_scopes(df: DataFrame, scopes: DataFrame) -> DataFrame:
    """Rows outside every scope. A scope names a code, the first date column it sets, and/or a period
    month; a scope that names nothing deletes nothing. Whatever shapes the scopes have, the table takes part in one join."""
    return _scoped(df, scopes, "left_anti")


def within_scopes(df: DataFrame, scopes: DataFrame) -> DataFrame:
    """Rows that some scope names: those that `delete_scopes` leaves out."""
    return _scoped(df, scopes, "left_semi")


def duplicate_ratio(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys and rows per key of each table; the ratio of an empty table is NULL."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(F.struct(*keys)).alias("key_count"),
        )
        for name, (df, keys) in tables.items()
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.withColumn("dup_ratio", F.try_divide(F.col("row_count").cast("double"), F.col("key_count")))


def delete_where(df: DataFrame, doomed: Column) -> tuple[DataFrame, DataFrame]:
    """Survivors of a delete by predicate (NULL survives), and the doomed counts by status for a dry run."""
    doomed = F.coalesce(doomed, F.lit(False))
    counts = df.filter(doomed).groupBy("status").agg(F.count(F.lit(1)).alias("doomed"))
    return df.filter(~doomed), counts
