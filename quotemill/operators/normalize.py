"""From raw text columns to typed, scaled, defaulted rows: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.dates import EPOCH, not_before_epoch, parse_day, parse_moment, stripped
from ..functions.units import MONEY, SHARES, is_money, is_share_count, load_scale, migrated_value

# Fields always kept as text when a schema is inferred.
TEXT_FIELDS = ("ts_code", "exchange", "market", "area", "industry", "name")
MOMENTS = (T.TimestampType, T.TimestampNTZType)


def is_day_column(name: str, declared: T.DataType | None) -> bool:
    """Declared dates, and any column named like one unless it is declared a timestamp."""
    if isinstance(declared, T.DateType):
        return True
    return "date" in name.lower() and not isinstance(declared, MOMENTS)


def _default(kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.DateType):
        return F.lit(EPOCH).cast("date")
    return None


def typed_value(name: str, field: T.StructField | None, kind: T.DataType) -> Column:
    """The typed value of one raw column before defaults are filled."""
    col = F.col(name)
    if is_day_column(name, field.dataType if field else None):
        # A date-like name wins over a declared number type, as upstream dates arrive untyped; declared text stays text.
        day = parse_day(col) if isinstance(kind, T.StringType) else col.cast("date")
        day = not_before_epoch(day, field is None or field.nullable)
        return day.cast("string") if field is not None and isinstance(field.dataType, T.StringType) else day
    if field is None:
        return col
    target = field.dataType
    if isinstance(target, MOMENTS):
        return parse_moment(col) if isinstance(kind, T.StringType) else col.cast("timestamp_ntz")
    if isinstance(target, T.StringType):
        return col if isinstance(kind, T.StringType) else col.cast("string")
    scale = load_scale(name, target)
    raw = stripped(col) if isinstance(kind, T.StringType) else col
    if scale == 1:
        return raw.try_cast(target)
    wide = T.DecimalType(28, target.scale + 4)
    return (raw.try_cast(wide) * F.lit(scale)).try_cast(target)


def normalize(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows of `df` by a declared schema, plus `_rejects`: the columns whose non-blank text had no
    valid value. Blank text counts as missing; a missing value in a required column takes the default of
    its type. Columns outside the schema pass through, parsed only when named like a date.
    """
    declared = {f.name: f for f in schema.fields}
    # A generator of one row is a barrier: no filter or projection above it repeats the parsing below.
    parsed = df.select("*", F.inline(F.array(F.struct(*[
        typed_value(f.name, declared.get(f.name), f.dataType).alias(f"_v_{f.name}") for f in df.schema.fields
    ])))) if df.columns else df
    values, rejects = [], []
    for source in df.schema.fields:
        name, field, value = source.name, declared.get(source.name), F.col(f"_v_{source.name}")
        day = is_day_column(name, field.dataType if field else None)
        is_text = not day and (field is None or isinstance(field.dataType, T.StringType))
        if isinstance(source.dataType, T.StringType) and not is_text:
            lost = value.isNull() & F.col(name).isNotNull() & (stripped(F.col(name)) != "")
            rejects.append(F.when(lost, F.lit(name)))
        if field is not None and not field.nullable:
            if is_text:
                value = F.when(stripped(value) != "", value)
            # A column named like a date becomes one unless it is declared text, which stays text.
            default = _default(T.DateType() if day and not isinstance(field.dataType, T.StringType) else field.dataType)
            if default is not None:
                value = F.coalesce(value, default)
        values.append(value.alias(name))
    # array_except drops the NULLs inside generated code; array_compact would fall back to interpretation.
    none = F.array(F.lit(None).cast("string"))
    listed = F.array_except(F.array(*rejects), none) if rejects else F.array().cast("array<string>")
    return parsed.select(*values, listed.alias("_rejects"))


def infer_types(df: DataFrame, fields: list[str], order: Column, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """(field, type) rows for payload cells held as VARIANT columns, profiled over every row.

    Name rules come first; otherwise the first present value by `order` decides between text, day and
    moment, and any fraction among the numbers makes the column a double. One aggregate, no shuffle of
    the data.
    """
    overrides = dict(overrides or {})
    cells = df.select(order.alias("_pos"), *[
        part for name in fields for part in (
            F.expr(f"schema_of_variant({name})").alias(f"kind_{name}"),
            F.try_variant_get(F.col(name), "$", "string").alias(f"text_{name}"),
        )
    ])
    aggs = []
    for name in fields:
        kind, text = F.col(f"kind_{name}"), F.col(f"text_{name}")
        is_text = kind == "STRING"
        present = F.coalesce((kind != "VOID") & ~(is_text & (text == "")), F.lit(False))
        first = F.min(F.when(present, F.struct(F.col("_pos").alias("pos"), kind.alias("kind"), text.alias("text"))))
        fraction = F.bool_or(present & ~is_text & (kind != "BIGINT"))
        aggs += [first.alias(f"first_{name}"), fraction.alias(f"frac_{name}")]
    profile = cells.agg(*aggs)
    rows = [
        F.struct(F.lit(i).cast("int").alias("ordinal"), F.lit(name).alias("field"),
                 _inferred(name, overrides).alias("type"))
        for i, name in enumerate(fields)
    ]
    rows.append(F.struct(F.lit(len(fields)).cast("int").alias("ordinal"), F.lit("_version").alias("field"),
                         F.lit("bigint").alias("type")))
    return profile.select(F.inline(F.array(*rows)))


def _inferred(name: str, overrides: Mapping[str, str]) -> Column:
    if name in overrides:
        return F.lit(overrides[name])
    if name in TEXT_FIELDS:
        return F.lit("string")
    if is_money(name):
        return F.lit(MONEY.simpleString())
    if is_share_count(name):
        return F.lit(SHARES.simpleString())
    first = F.col(f"first_{name}")
    text, is_text = first["text"], first["kind"] == "STRING"
    return (
        F.when(first.isNull(), F.lit("string"))
        .when(is_text & text.rlike(r"^[0-9]{8}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit("date"))
        .when(is_text & text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\s+[0-9]{2}:[0-9]{2}:[0-9]{2}$"), F.lit("timestamp"))
        .when(is_text, F.lit("string"))
        .when(F.col(f"frac_{name}"), F.lit("double"))
        .otherwise(F.lit("bigint"))
    )


def migration_type(kind: T.DataType) -> str:
    """Target type of a source column: every fraction becomes a double, JSON and the unknown become text."""
    if isinstance(kind, T.BooleanType):
        return "tinyint"
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType, T.DateType, T.StringType)):
        return kind.simpleString()
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(kind, MOMENTS):
        return "timestamp_ntz"
    return "string"


def migration_projection(df: DataFrame) -> DataFrame:
    """Typed projection by the migration rules; moments keep milliseconds."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, MOMENTS):
            col = F.date_trunc("millisecond", F.col(f.name)).cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(f.name)
        else:
            col = F.col(f.name).cast(migration_type(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)


def migrated(df: DataFrame) -> DataFrame:
    """Scale all numeric columns by the migration rule."""
    return df.select(*[migrated_value(f.name, F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def with_drift(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows whose schema drifted: new columns join the table as nullable text, absent ones are NULL, and so
    is a value that the table's type cannot hold."""
    known = {f.name: f.dataType for f in table.schema.fields}
    aligned = [F.col(c).try_cast(known[c] if c in known else "string").alias(c) for c in rows.columns]
    return table.unionByName(rows.select(*aligned), allowMissingColumns=True)


def new_columns(table: DataFrame, rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in table.columns]
