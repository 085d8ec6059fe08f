"""Data-quality audits. Each covers all datasets in one job instead of one query per dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.dates import day_text, quarter_ends
from ..functions.fingerprint import fingerprint
from ..functions.units import readable_quantity
from ..model import SCOPE_DATE_COLUMNS, TableSpec, VERSION
from .calendar import latest_trade_date, trade_dates
from .state import with_state_counts
from .versions import SHAPE, current, same_scope, scope_names, scope_shapes, scope_values, with_scope


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dataset_days(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct (dataset, day) pairs; versions do not matter for presence, so nothing is resolved."""
    return union_all([
        df.select(F.lit(name).alias("dataset"), F.col(day).alias("day")).filter(F.col("day").isNotNull()).distinct()
        for name, (df, day) in tables.items()
    ])


def trading_day_gaps(cal: DataFrame, days: DataFrame, datasets: Sequence[str] | None = None) -> DataFrame:
    """Open days of the calendar that a dataset lacks, one row each.

    The expected pairs come from an array of the open days, which a calendar bounds, exploded per dataset. `datasets`
    names those to look for: one without any row lacks every day. Left out, only datasets with a day are looked at.
    """
    open_days = cal.filter(F.col("is_open") == 1).agg(F.array_sort(F.collect_set("cal_date")))
    names = days.select("dataset").distinct()
    if datasets is not None:
        named = F.explode(F.array(*[F.lit(n) for n in datasets])) if datasets else F.explode(F.array().cast("array<string>"))
        names = cal.sparkSession.range(1).select(named.alias("dataset"))
    expected = names.withColumn("days", open_days.scalar()).select("dataset", F.explode("days").alias("day"))
    return expected.join(days, ["dataset", "day"], "left_anti")


def gap_report(gaps: DataFrame, cal: DataFrame) -> DataFrame:
    """Per dataset: the missing days as text, their count and the calendar range looked at."""
    bounds = cal.filter(F.col("is_open") == 1).agg(
        F.concat_ws("..", day_text(F.min("cal_date")), day_text(F.max("cal_date")))
    )
    return gaps.groupBy("dataset").agg(
        F.lit("trading_day").alias("gap_type"),
        F.count(F.lit(1)).alias("missing_count"),
        F.array_join(F.array_sort(F.collect_list(day_text(F.col("day")))), ",").alias("missing_dates"),
    ).withColumn("date_range", bounds.scalar())


def gap_runs(gaps: DataFrame, cal: DataFrame, min_days: int = 1) -> DataFrame:
    """Runs of consecutive missing open days per dataset: first and last day and how many open days; runs of fewer than `min_days` are noise.

    Islands by ordinals: the number of an open day less the number of a missing day within its dataset is the same along a run. Both
    windows are as long as the calendar.
    """
    opened = cal.filter(F.col("is_open") == 1).select(F.col("cal_date").alias("day")).distinct()
    numbered = opened.agg(F.array_sort(F.collect_list("day")).alias("days")).select(F.posexplode("days").alias("ordinal", "day"))
    along = Window.partitionBy("dataset").orderBy("day")
    runs = gaps.join(numbered, "day").withColumn("run", F.col("ordinal") - F.row_number().over(along))
    return runs.groupBy("dataset", "run").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("open_days"),
    ).filter(F.col("open_days") >= min_days).drop("run")


def period_gaps(df: DataFrame, by: str, period: str = "end_date", declared: DataFrame | None = None) -> DataFrame:
    """Quarter ends missing per dataset, from the first to the last full year seen.

    The last year is expected whole, so quarters still to come count as missing. With `declared` datasets,
    those without any period are reported too.
    """
    seen = df.select(by, F.col(period).alias("day")).filter(F.col("day").isNotNull()).distinct()
    bounds = seen.groupBy(by).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    expected = bounds.select(by, "first", "last", F.explode(
        quarter_ends(F.make_date(F.year("first"), F.lit(1), F.lit(1)), F.make_date(F.year("last"), F.lit(12), F.lit(31)))
    ).alias("day"))
    missing = expected.join(seen, [by, "day"], "left_anti")
    report = missing.groupBy(by).agg(
        F.count(F.lit(1)).alias("missing_count"),
        F.array_join(F.array_sort(F.collect_list(day_text(F.col("day")))), ",").alias("missing_periods"),
        F.concat_ws("..", day_text(F.min("first")), day_text(F.max("last"))).alias("date_range"),
    ).withColumn("issue", F.lit(None).cast("string"))
    if declared is None:
        return report
    empty = declared.select(by).join(seen, by, "left_anti").select(
        by, F.lit(0).cast("bigint").alias("missing_count"), F.lit("").alias("missing_periods"),
        F.lit("empty").alias("date_range"), F.lit("Table has no data").alias("issue"),
    )
    return report.unionByName(empty)


def missing_periods(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected minus actual (key, period) pairs."""
    return expected.join(actual.distinct(), expected.columns, "left_anti")


def row_count_audit(interfaces: DataFrame, counts: DataFrame, log: DataFrame) -> DataFrame:
    """Status of each declared interface; `counts` has (table_name, row_count) of the tables that exist."""
    base = with_state_counts(interfaces.select("interface", "table_name"), log).join(counts, "table_name", "left")
    n = F.col("row_count")
    status = (
        F.when(n.isNull(), "missing")
        .when((n == 0) & (F.col("done") == 0), "empty")
        .when(F.col("failed") > 0, "has_failures")
        .when(F.col("partial") > 0, "has_partial")
        .otherwise("ok")
    )
    return base.select(
        "interface", "table_name", status.alias("status"), F.coalesce(n, F.lit(0)).cast("bigint").alias("row_count"),
        "done", "partial", "failed",
    )


def table_counts(tables: Mapping[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    """Current rows per table: only keys and version are read, as distinct keys, with map-side combine."""
    return union_all([
        df.agg(F.lit(name).alias("table_name"), F.count_distinct(F.struct(*spec.keys)).alias("row_count"))
        for name, (df, spec) in tables.items()
    ])


def fingerprint_audit(tables: Mapping[str, tuple[DataFrame, TableSpec]], cal: DataFrame, as_of: Column,
                      portable: bool = False) -> DataFrame:
    """Fingerprint of the current rows of the last open day, one row per dataset that has that day."""
    latest = latest_trade_date(cal, as_of)
    parts = []
    for name, (df, spec) in tables.items():
        rows = current(df.filter(F.col(spec.date_column) == latest.scalar()), spec.keys)
        parts.append(
            fingerprint(rows, [spec.date_column], df.columns, portable=portable)
            .withColumnRenamed(spec.date_column, "trade_date").withColumn("dataset", F.lit(name))
        )
    return union_all(parts)


def day_fingerprints(df: DataFrame, spec: TableSpec, columns: Sequence[str], portable: bool = False) -> DataFrame:
    """(day, row_count, fingerprint, max_version) of the current rows of every day of a dated table."""
    rows = current(df.select(*dict.fromkeys([*spec.keys, spec.date_column, *columns, spec.version])), spec.keys)
    return fingerprint(rows, [spec.date_column], columns, spec.version, portable).withColumnRenamed(spec.date_column, "day")


def advance_fingerprints(days: DataFrame, before: DataFrame, appended: DataFrame, spec: TableSpec, columns: Sequence[str], portable: bool = False) -> DataFrame:
    """Day fingerprints after an append, from those before it: only keys with appended versions are read and hashed.

    XOR is its own inverse: rows that are superseded go out by being added once more, and their successors come in. The
    date column must be a key, so that a row never changes its day; `before` is the log without the appended rows.
    """
    keys = list(spec.keys)
    needed = list(dict.fromkeys([*keys, spec.date_column, *columns, spec.version]))
    touched = before.select(*needed).join(appended.select(*keys).distinct(), keys, "left_semi")
    old = day_fingerprints(touched, spec, columns, portable)
    new = day_fingerprints(touched.unionByName(appended.select(*needed)), spec, columns, portable)
    parts = union_all([days, new, old.withColumn("row_count", -F.col("row_count"))])
    return parts.groupBy("day").agg(
        F.sum("row_count").alias("row_count"), F.bit_xor("fingerprint").alias("fingerprint"), F.max("max_version").alias("max_version"),
    ).filter(F.col("row_count") > 0)


def run_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Where two runs' fingerprints (dataset, day, row_count, fingerprint) disagree; empty when the data stayed the same."""
    left = first.select("dataset", "day", F.col("row_count").alias("first_rows"), F.col("fingerprint").alias("first_print"))
    right = second.select("dataset", "day", F.col("row_count").alias("second_rows"), F.col("fingerprint").alias("second_print"))
    both = left.join(right, ["dataset", "day"], "full")
    differs = ~(F.col("first_print").eqNullSafe(F.col("second_print")) & F.col("first_rows").eqNullSafe(F.col("second_rows")))
    return both.filter(differs).select("dataset", "day", F.coalesce("first_rows", F.lit(0)).alias("first_rows"), F.coalesce("second_rows", F.lit(0)).alias("second_rows"))


def scope_counts(units: DataFrame, data: DataFrame, keys: Sequence[str], date_column: str | None = None) -> DataFrame:
    """Current rows found for each unit's scope, with the range of a date column.

    Units carry unit_id and the nullable scope columns. One pass over the data counts every scope shape as a grouping set, and one join on
    shape and values answers all units. A unit without any scope column owns the whole table; one that sets only columns the table lacks is left out.
    """
    used = {c for c in (*units.columns, date_column) if c in data.columns}
    if "period" in units.columns:
        used.add("end_date")
    # When a scope is told by key columns alone, distinct keys count the same as resolved rows, at less cost.
    rows = data.select(*keys).distinct() if used <= set(keys) else current(data, keys)
    names = scope_names(data, units)
    columns = [f"_s_{n}" for n in names]
    extra = [F.min("_date").alias("min_date"), F.max("_date").alias("max_date")] if date_column else []
    valued = rows.select(*scope_values(names), *([F.col(date_column).alias("_date")] if date_column else []))
    every = (1 << len(names)) - 1
    if names:
        sets = [[F.col(f"_s_{n}") for n in shape] for shape in scope_shapes(names)]
        found = valued.groupingSets(sets, *columns).agg(F.count(F.lit(1)).alias("found"), *extra, (F.lit(every) - F.grouping_id()).alias(SHAPE))
    else:
        found = valued.agg(F.count(F.lit(1)).alias("found"), *extra).withColumn(SHAPE, F.lit(0).cast("bigint"))
    mine = with_scope(units, names)
    lacking = [c for c in units.columns if c in ("ts_code", "period", *SCOPE_DATE_COLUMNS) and c not in names]
    for name in lacking:
        mine = mine.filter((F.col(SHAPE) > 0) | F.col(name).isNull())
    out = mine.join(found, same_scope(mine, found, names), "left")
    return out.select(*units.columns, "found", *(["min_date", "max_date"] if date_column else [])).fillna({"found": 0})


def write_check(units: DataFrame, data: DataFrame, keys: Sequence[str], date_column: str | None = None) -> DataFrame:
    """Verdict per load unit from rows written and current rows found in its scope."""
    checked = scope_counts(units, data, keys, date_column)
    wrote, found = F.col("rows_written"), F.col("found")
    named = [c for c in units.columns if c in (*SCOPE_DATE_COLUMNS, "period", "month")]
    whole_symbol = F.col("ts_code").isNotNull() if "ts_code" in units.columns else F.lit(False)
    for name in named:
        whole_symbol = whole_symbol & F.col(name).isNull()
    floor = F.greatest(F.lit(1).cast("bigint"), F.floor(wrote * 0.05).cast("bigint"))
    verdict = (
        F.when(wrote == 0, "ok")
        .when(found == 0, "no_rows")
        .when(~whole_symbol & (found < floor), "heavy_loss")
    )
    if date_column:
        verdict = verdict.when(F.col("min_date") > F.col("max_date"), "inverted_range")
    return checked.select("unit_id", "rows_written", "found", verdict.otherwise("ok").alias("verdict"))


def duplicate_loss(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], limit: float = 0.10) -> DataFrame:
    """Share of rows that version resolution removes, for tables above 100 rows, with a warning flag."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_rows"),
               F.count_distinct(F.struct(*keys)).alias("final_rows"))
        for name, (df, keys) in tables.items()
    ]
    loss = F.lit(1.0) - F.col("final_rows") / F.col("total_rows")
    return union_all(parts).withColumn("loss", F.when(F.col("total_rows") > 100, loss)).withColumn(
        "warn", F.coalesce(F.col("loss") > limit, F.lit(False))
    )


def load_volume_check(log: DataFrame, limits: DataFrame, ratios: DataFrame,
                      failed_limit: float = 0.10, ratio_limit: float = 1.5) -> DataFrame:
    """Findings: too many units, too many failures, too many duplicates. `limits` has (interface, max_units)."""
    counts = log.groupBy("interface").agg(
        F.count(F.lit(1)).alias("units"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    share = F.col("failed") / F.col("units")
    joined = counts.join(limits, "interface")
    too_many = joined.filter(F.col("units") > F.col("max_units")).select(
        F.col("interface").alias("subject"), F.lit("too_many_units").alias("finding"), F.col("units").cast("double").alias("measure"))
    failing = joined.filter(share > failed_limit).select(
        F.col("interface").alias("subject"), F.lit("failed_share").alias("finding"), F.round(share, 6).alias("measure"))
    doubled = ratios.filter(F.col("dup_ratio") > ratio_limit).select(
        F.col("table_name").alias("subject"), F.lit("dup_ratio").alias("finding"), F.round("dup_ratio", 6).alias("measure"))
    return union_all([too_many, failing, doubled])


def coverage(df: DataFrame, date_column: str, code_column: str, by: Sequence[str] = ()) -> DataFrame:
    """Date range, distinct codes and rows, per table or scope; an inverted range is flagged."""
    return df.groupBy(*by).agg(
        F.min(date_column).alias("min_date"), F.max(date_column).alias("max_date"),
        F.count_distinct(code_column).alias("codes"), F.count(F.lit(1)).alias("row_count"),
    ).withColumn("inverted", F.coalesce(F.col("min_date") > F.col("max_date"), F.lit(False)))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """sum, min and max of every numeric column, one pass over the table."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    aggs = []
    for c in columns:
        aggs += [F.sum(c).cast("double").alias(f"s_{c}"), F.min(c).cast("double").alias(f"n_{c}"),
                 F.max(c).cast("double").alias(f"x_{c}")]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"s_{c}").alias("total"), F.col(f"n_{c}").alias("low"),
                 F.col(f"x_{c}").alias("high"))
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and missing values of every column, one pass over the table."""
    columns = list(columns or df.columns)
    profile = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"z_{c}") for c in columns])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("n").alias("row_count"), F.col(f"z_{c}").alias("null_count"))
        for c in columns
    ]
    return profile.select(F.inline(F.array(*rows)))


def table_profile(tables: Mapping[str, DataFrame], version: str = VERSION) -> DataFrame:
    """Rows (versions included), newest version and a readable count per table, and one total row."""
    rows = union_all([
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.max(version).alias("max_version"))
        for name, df in tables.items()
    ])
    both = rows.rollup("table_name").agg(F.sum("row_count").alias("row_count"), F.max("max_version").alias("max_version"))
    return both.select(
        F.coalesce("table_name", F.lit("(total)")).alias("table_name"), "row_count", "max_version",
        readable_quantity(F.col("row_count")).alias("readable"),
    )


def largest_tables(profile: DataFrame, n: int = 20) -> DataFrame:
    return profile.filter(F.col("table_name") != "(total)").orderBy(F.col("row_count").desc(), "table_name").limit(n)


def describe_table(df: DataFrame, version: str = VERSION) -> DataFrame:
    """Columns with their types, plus row count, column count and newest version of the table."""
    stats = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(version).alias("last_version"))
    rows = [
        F.struct(F.lit(i + 1).cast("int").alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("column_type"))
        for i, f in enumerate(df.schema.fields)
    ]
    columns = F.inline(F.array(*rows))
    return stats.select(columns, "row_count", F.lit(len(rows)).cast("int").alias("column_count"), "last_version")


def update_lag(df: DataFrame, updated_at: str, as_of: Column) -> DataFrame:
    """Lag of the newest update against as_of and the verdict on its time zone."""
    seconds = F.abs(F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("latest").cast("timestamp")))
    hours = F.col("lag_seconds") / 3600
    verdict = (
        F.when(F.col("latest").isNull(), "ok")
        .when(F.col("lag_seconds") > 30 * 86400, "outdated")
        .when((hours > 7) & (hours < 9), "looks_utc")
        .otherwise("ok")
    )
    return df.agg(F.max(updated_at).alias("latest")).withColumn("lag_seconds", seconds).withColumn("verdict", verdict)


def days_with_data(df: DataFrame, cal: DataFrame, start: str, end: str) -> DataFrame:
    """Open days that do carry data, for sums against the gap audit."""
    return trade_dates(cal, start, end).join(df.select(F.col("trade_date").alias("cal_date")).distinct(), "cal_date", "left_semi")
