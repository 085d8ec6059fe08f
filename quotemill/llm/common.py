"""What several of the operators share: tables, staged tables, and byte arithmetic on whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import scratch_path

U64 = np.uint64


#: Rows that cross to Python at once: whole texts of a few KB make batches of a few MB, which a task holds on both sides.
BATCH_ROWS = 1000

#: Spark's setting that shuffle files are deleted when the query that wrote them has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again.

    Cuts lineage, lets Spark plan the next step with the real size, and survives a lost executor. The shuffle files of the write go
    when it has ended, as nothing reads them again: left to the garbage collector, those of many steps lie on the disks at once.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `limit` bytes of text, or one row if that row is longer."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_binary())
        ends = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset: sizes.offset + len(sizes) + 1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch's texts in a row, and where each text starts (one more entry than rows); null is empty."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]: ends[-1]], ends - ends[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit words (the finaliser of SplitMix64, wrapping)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of a pair of names; the order of the two counts."""
    return mixed(left * U64(0x9E3779B97F4A7C15) + (right ^ U64(0xD1B54A32D192ED03)))


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one word; the last seven positions have none."""
    if len(raw) < 8:
        return np.zeros(0, U64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(raw), 8)).view("<u8")[:, 0]


#: Bits of a sieve's address: a sieve takes 2 MiB whatever it holds.
SIEVE_BITS = 24


def sieve(keys: DataFrame, column: str, hashed: bool = False) -> np.ndarray:
    """A bitmap of fixed size with the bit of every key set; two keys may share a bit, so it may keep too much, never too little.

    A key that is a hash itself (`hashed`) names its bit by its last bits, so that a task's own function can look it up (`held`).
    """
    bit = (F.col(column) if hashed else F.xxhash64(column)).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()  # 2 ** 18 rows at most
    out = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def held(kept: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (hashes, as signed words) have their bit in a sieve of hashes: spares a task the second Python worker of `sifted`."""
    bit = keys & ((1 << SIEVE_BITS) - 1)
    return (kept[bit >> 6] >> (bit & 63)) & 1 == 1


def sifted(df: DataFrame, column: str, kept: np.ndarray, inside: bool = True) -> DataFrame:
    """The rows whose key has its bit in the sieve (or, outside, has not): thins a table before its rows move to a join."""
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch["_bit"].to_numpy()
            hit = (kept[bit >> 6] >> (bit & 63)) & 1
            yield batch.filter(pa.array((hit == 1) == inside)).drop_columns(["_bit"])

    bit = F.xxhash64(column).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)).alias("_bit")
    return df.select("*", bit).mapInArrow(sift, df.schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a task's rows, which are sorted by `keys` (integers without nulls); one group is held at a time."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        rows = part if held is None else pa.concat_tables([held, part])
        new = np.zeros(len(rows), bool)
        for key in keys:
            x = rows[key].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield rows.slice(a, b - a)
        held = rows.slice(edges[-1])
    if held is not None:
        yield held
