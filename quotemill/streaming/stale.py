"""Stale-unit detection on a stream of load-state versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..model import STATE
from ..operators.state import stale_units
from ..operators.versions import current
from . import sink

COLUMNS = (*STATE.keys, "status", "rows", "last_success_at", "heartbeat_at", "attempts", "last_error", STATE.version)
#: The newest heartbeat of any version that was followed, beside every row kept.
CLOCK = "_clock"


def follow(log: DataFrame, path: str, checkpoint: str) -> None:
    """Keep the newest version of each unit that a micro-batch brings.

    The rows are resolved on the map side before they move, so a unit with very many versions costs one row a task. There is no
    watermark: a file that is read late, with whatever event times, still counts. Versions that leave still move the clock.
    """
    sink.drain(log, path, checkpoint, "append", lambda batch: _clocked(current(batch.select(*COLUMNS), STATE.keys), batch, "heartbeat_at"))


def _clocked(rows: DataFrame, of: DataFrame, column: str) -> DataFrame:
    return rows.crossJoin(F.broadcast(of.agg(F.max(column).alias(CLOCK))))


def clock(spark: SparkSession, path: str) -> Column:
    """The newest heartbeat of all versions followed so far, those that newer ones replaced too."""
    return sink.read(spark, path).agg(F.max(CLOCK)).scalar()


def board(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of each unit followed so far."""
    return current(sink.read(spark, path).drop(sink.BATCH, CLOCK), STATE.keys)


def flag_stale(spark: SparkSession, path: str, as_of: Column | None = None, minutes: int = 10, version: Column | int | None = None) -> DataFrame:
    """A full `partial` version, ready to append to the log, of every followed unit that is still `running` with a heartbeat more than
    `minutes` before `as_of`, or before the newest heartbeat followed. Whatever the order of arrival, an older version never
    revives a unit, and the flag is newer than the row that it judges.
    """
    rows = board(spark, path)
    as_of = as_of if as_of is not None else clock(spark, path)
    return stale_units(rows, as_of, minutes, version if version is not None else flag_version(as_of))


def flag_version(as_of: Column) -> Column:
    """The version of a flag, newer than that of the row that it judges."""
    return F.greatest(F.unix_millis(as_of.cast("timestamp")), F.col(STATE.version) + 1)


def release(spark: SparkSession, path: str, to: str) -> None:
    """Write what was followed to a new path, one row for each unit; later batches may go on there.

    Of units that have ended (`done` or `biz_err`) only key, status and version stay, so that a late older version is known as such.
    """
    ended, kept = F.col("status").isin("done", "biz_err"), (*STATE.keys, "status", STATE.version)
    rows = board(spark, path).select(*[F.col(c) if c in kept else F.when(~ended, F.col(c)).alias(c) for c in COLUMNS])
    _clocked(rows, sink.read(spark, path), CLOCK).write.mode("overwrite").parquet(f"{to}/{sink.BATCH}=-1")
