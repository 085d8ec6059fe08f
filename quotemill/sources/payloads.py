"""Upstream payloads: `fields` plus `items` rows, at the top level or under `data`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_BODY = "fields array<string>, items array<array<{cell}>>"


def _parsed(payload: Column, cell: str) -> Column:
    body = _BODY.format(cell=cell)
    return F.from_json(payload, f"data struct<{body}>, {body}")


def explode_items(df: DataFrame, payload: str, fields: Sequence[str], cell: str = "string") -> DataFrame:
    """One row per item with one column per requested field, beside the other columns of `df`.

    A field the payload lacks and a cell beyond a short item are NULL. Cells are text, or VARIANT to
    keep the JSON kinds for type inference.
    """
    others = [c for c in df.columns if c != payload]
    wide = df.select(*others, _parsed(F.col(payload), cell).alias("_p")).select(
        *others,
        F.coalesce("_p.data.fields", "_p.fields").alias("_fields"),
        F.posexplode(F.coalesce("_p.data.items", "_p.items")).alias("item_pos", "_item"),
    )
    cells = []
    for name in fields:
        at = F.array_position("_fields", F.lit(name)).cast("int")
        cells.append(F.when(at > 0, F.try_element_at("_item", at)).alias(name))
    return wide.select(*others, "item_pos", *cells)


def payload_fields(df: DataFrame, payload: str) -> DataFrame:
    """Field lists of payloads, also of those without items."""
    parsed = _parsed(F.col(payload), "string")
    return df.select(F.coalesce(parsed["data"]["fields"], parsed["fields"]).alias("fields"))


def read_payloads(spark: SparkSession, folder: str, names: Sequence[str] | None = None,
                  pattern: str = "*.json", lines: bool = False) -> DataFrame:
    """Payload files of a folder tree as (name, payload) rows; a name without a file gives no row. A file is one payload, or with
    `lines` holds a payload a line: then any number of payloads needs few files, and a large file is read by many tasks."""
    glob = "{" + ",".join(names) + "}.json" if names else pattern
    split = {"lineSep": "\n"} if lines else {"wholetext": "true"}
    df = (
        spark.read.option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).options(**split).format("text").load(folder)
    )
    name = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    return df.select(name.alias("name"), F.col("value").alias("payload"))
