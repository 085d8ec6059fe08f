"""Idempotent upserts and the load path as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..model import VERSION
from ..operators.normalize import normalize
from ..operators.versions import current, with_version
from ..sources.payloads import explode_items
from . import sink


def upsert(spark: SparkSession, stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
           version: str = VERSION) -> DataFrame:
    """Append row versions batch by batch and return the current rows. Order of arrival does not matter:
    a late, older version never replaces a newer one, and no row is too late. Rows equal in every column are dropped inside a
    micro-batch; rows that tie on the version are kept and resolve by the rule of `current`, as they do in a batch."""
    sink.drain(stream, path, checkpoint, "append", lambda batch: batch.dropDuplicates())
    return current(sink.read(spark, path).drop(sink.BATCH), keys, version)


def payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole payload files of a folder as a stream with one `value` text per file."""
    return spark.readStream.format("text").option("wholetext", "true").schema("value string").load(folder)


def load_payloads(stream: DataFrame, payload: str, schema: T.StructType, version: int | Column) -> DataFrame:
    """Payload texts to typed, versioned rows; each micro-batch handles only files not seen before."""
    rows = explode_items(stream, payload, schema.fieldNames()).drop("item_pos")
    return with_version(normalize(rows, schema), version)


def increment(stream: DataFrame, day: Column, date_column: str = "trade_date") -> DataFrame:
    """Only the target day of a stream."""
    return stream.filter(F.col(date_column) == day)
