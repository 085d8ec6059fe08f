"""Windowed call-log measures on a stream. The batch forms live in `operators.calls`.

Each micro-batch writes partial counts per window, and reading adds them up. So calls may arrive in any order and however
late: there is no watermark that could drop them, and no state that could grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.calls import latency_sketch, per_window, sketched_latency
from . import sink


def windowed(stream: DataFrame, path: str, checkpoint: str, width: str, *counts: Column, slide: str | None = None,
             by: tuple[str, ...] = (), time: str = "started_at") -> DataFrame:
    """Tumbling or sliding counts of everything the stream held so far; `counts` must be aggregates that add up."""
    sink.drain(stream, path, checkpoint, "append", lambda batch: per_window(batch, width, *counts, slide=slide, by=by, time=time))
    parts = sink.read(stream.sparkSession, path).drop(sink.BATCH)
    keys = ["window_start", "window_end", *by]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def latency(stream: DataFrame, path: str, checkpoint: str, q: float = 0.99, width: str = "1 hour") -> DataFrame:
    """Exact percentile of duration_ms per window: micro-batches count equal durations, reading weighs them."""
    counted = windowed(stream, path, checkpoint, width, F.count(F.lit(1)).alias("n"), by=("duration_ms",))
    return counted.groupBy("window_start", "window_end").agg(
        F.percentile("duration_ms", q, F.col("n")).alias("latency_ms"), F.sum("n").alias("calls"))


def latency_from_sketches(stream: DataFrame, path: str, checkpoint: str, q: float = 0.99, width: str = "1 hour") -> DataFrame:
    """Percentile of duration_ms per window within a stated rank error: micro-batches write one sketch per window, reading merges them."""
    sink.drain(stream, path, checkpoint, "append", lambda batch: latency_sketch(batch, width))
    return sketched_latency(sink.read(stream.sparkSession, path), q)
