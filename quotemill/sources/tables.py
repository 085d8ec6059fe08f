"""Scans, versioned sinks, rewrites and exports of Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..model import TableSpec
from ..operators.versions import current, row_version, with_version, write_clustered
from ..session import scratch_path

MONTH = "_month"


def with_month(df: DataFrame, date_column: str | None) -> tuple[DataFrame, str | None]:
    """Placement column yyyyMM of a date column; a table without that column stays unpartitioned."""
    if date_column is None or date_column not in df.columns:
        return df, None
    return df.withColumn(MONTH, (F.year(date_column) * 100 + F.month(date_column)).cast("int")), MONTH


def append(df: DataFrame, path: str, spec: TableSpec, version: int | Column | None = None) -> bool:
    """Append a versioned batch, placed by month; returns whether it held rows. An empty batch leaves the
    table as it was. Rows are counted while they are written, so the batch is not computed twice."""
    if version is not None:
        df = with_version(df, version, spec.version)
    placed, month = with_month(df, spec.date_column)
    return write_clustered(placed, path, spec.keys, month, mode="append") > 0


def append_bucketed(df: DataFrame, name: str, spec: TableSpec, buckets: int, path: str | None = None) -> DataFrame:
    """Append the newest rows of a versioned batch to a catalog table dealt into `buckets` by its keys, and return the table.

    Resolving the table on its keys, and joining it with others of the same keys and buckets, then needs no shuffle. The batch is
    resolved first: older versions of a key leave before rows are dealt, so one with very many of them fills no bucket, and a resolved
    table holds a row per key and batch at most. A bucket is one file a batch; `path` is where a new table lies.
    """
    spark = df.sparkSession
    rows = current(df, spec.keys, spec.version).repartition(buckets, *spec.keys)
    writer = rows.write.mode("append").format("parquet").bucketBy(buckets, *spec.keys).sortBy(*spec.keys)
    (writer if spark.catalog.tableExists(name) else writer.option("path", path or scratch_path(spark, "bucketed"))).saveAsTable(name)
    return spark.table(name)


def append_by_day(df: DataFrame, path: str, time: str, day: str = "_day") -> int:
    """Append rows of a log to the folders of their days."""
    return write_clustered(df.withColumn(day, F.col(time).cast("date")), path, [time], day, mode="append")


def drop_before(spark: SparkSession, path: str, partition: str, bound: str) -> list[str]:
    """Remove the partition folders of a table whose value is below `bound`, without reading a row; returns the values removed.

    Values compare as text, which suits days and months. Removing again what a lost run had begun to remove is harmless.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(root):  # one entry a partition
        name = status.getPath().getName()
        if name.startswith(f"{partition}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__") and name.split("=", 1)[1] < bound:
            files.delete(status.getPath(), True)
            gone.append(name.split("=", 1)[1])
    return sorted(gone)


def append_with_row_version(df: DataFrame, path: str, spec: TableSpec, loaded_at: Column) -> bool:
    """Append with the version each row carries in updated_at / created_at."""
    stamped = with_version(df, row_version(_or_null(df, "updated_at"), _or_null(df, "created_at"), loaded_at))
    return append(stamped.drop("updated_at", "created_at"), path, spec)


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("timestamp_ntz")


def open_table(spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """A stored table with its placement column. Opening lists the files once; keep the DataFrame for
    many lookups. A given schema spares reading file footers; left out, one footer speaks for all, and only `merge`
    reads them all, for a table whose files drifted."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", str(merge).lower())
    return reader.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return open_table(spark, path).drop(MONTH)


def scan(table: DataFrame, code: str | None = None, start: str | None = None, end: str | None = None,
         date_column: str = "trade_date", code_column: str = "ts_code") -> DataFrame:
    """Rows of an opened table by code and date range. Both the month folders and the row groups are
    pruned: a date predicate alone would not imply the month one."""
    df = table if code is None else table.filter(F.col(code_column) == code)
    for bound, low in ((start, True), (end, False)):
        if bound is None:
            continue
        day = F.to_date(F.lit(bound), "yyyyMMdd")
        df = df.filter(F.col(date_column) >= day if low else F.col(date_column) <= day)
        if MONTH in table.columns:
            month = F.lit(int(bound[:6]))
            df = df.filter(F.col(MONTH) >= month if low else F.col(MONTH) <= month)
    return df.drop(MONTH)


def scan_requests(df: DataFrame, requests: DataFrame, code: str = "ts_code", day: str = "trade_date") -> DataFrame:
    """Many scans at once: `requests` has one (code, start_date, end_date) row per code."""
    joined = df.join(requests, code)
    return joined.filter(F.col(day).between(F.col("start_date"), F.col("end_date"))).select(*df.columns)


def read_source(spark: SparkSession, url: str, table: str, columns: Sequence[str], where: str | None = None,
                split: tuple[str, int, int, int] | None = None, fetch_size: int = 100_000,
                options: Mapping[str, str] | None = None, small: bool = False) -> DataFrame:
    """A relational source through JDBC. Projection and predicate are pushed by the connector; `split`
    (column, low, high, parts) reads ranges in parallel. Without it the whole source would go through one task, so
    `split` may be left out only for a source the caller calls `small`."""
    if split is None and not small:
        raise ValueError("give a split, or say that the source is small")
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(options or {})}
    if split:
        column, low, high, parts = split
        opts |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    df = spark.read.format("jdbc").options(**opts).load()
    return select_where(df, columns, where)


def select_where(df: DataFrame, columns: Sequence[str], where: str | None = None,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """Projection with an optional predicate and order, as the source read takes them."""
    df = df.filter(where) if where else df
    df = df.select(*columns)
    return df.orderBy(*order_by) if order_by else df


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def rewrite(spark: SparkSession, df: DataFrame, keys: Sequence[str], renames: Mapping[str, str] | None = None,
            casts: Mapping[str, str] | None = None, adds: Mapping[str, str] | None = None,
            path: str | None = None, date_column: str | None = None) -> DataFrame:
    """Rewrite a table with columns renamed, retyped, then added, into a new path, in month folders of `date_column` (its new name). Values that do not fit
    a new type become NULL. The caller swaps paths after the row counts agree, which is checked here."""
    out = df.withColumnsRenamed(dict(renames or {}))
    out = out.withColumns({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()})
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in (adds or {}).items() if c not in out.columns})
    path = path or scratch_path(spark, "rewrite")
    keys = [(renames or {}).get(k, k) for k in keys]
    return _placed(spark, out, keys, path, date_column)


def rebuild(spark: SparkSession, df: DataFrame, keys: Sequence[str], path: str | None = None, date_column: str | None = None) -> DataFrame:
    """Copy a table into a new key order, so files are clustered by the new keys, in month folders of `date_column`; counts are checked."""
    return _placed(spark, df, keys, path or scratch_path(spark, "rebuild"), date_column)


def _placed(spark: SparkSession, df: DataFrame, keys: Sequence[str], path: str, date_column: str | None) -> DataFrame:
    """Write, and compare the rows that passed the write with those in the footers of its files."""
    placed, month = with_month(df.drop(MONTH), date_column)
    had = write_clustered(placed, path, keys, month)
    after = spark.read.schema(placed.schema).parquet(path)
    wrote = after.count()
    if wrote != had:
        raise ValueError(f"rewrite lost rows: {had} before, {wrote} after")
    return after


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text with all fields kept, dates in ISO form."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def export(df: DataFrame, path: str, form: str = "json") -> None:
    """Write a result: one JSON record per line for small results, Parquet for columnar use."""
    if form == "json":
        df.write.option("ignoreNullFields", "false").json(path)
    elif form == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"unknown export form: {form!r}")


