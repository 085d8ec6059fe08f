"""A replay-safe file sink: every micro-batch owns one folder, a retried batch replaces its own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.versions import current

BATCH = "_batch"


def start(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
          shape: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Drain what is available now into batch folders under `path`; `shape` is applied to each micro-batch before it is
    written. An empty folder stands there from the start, so a stream without input reads as no rows."""
    shape = shape or (lambda batch: batch)
    empty = shape(stream.sparkSession.createDataFrame([], stream.schema))
    empty.write.mode("overwrite").parquet(f"{path}/{BATCH}=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
          shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    query = start(stream, path, checkpoint, mode, shape)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last emission per key of an update-mode stream."""
    return current(read(spark, path), keys, BATCH).drop(BATCH)
