"""Embedding near-duplicates by iterative quantisation (operator 9).

Rotations of the principal axes are learned so that the signs of the rotated vectors make balanced codes that lose little. The
codes are cut into substrings, one table each; vectors of one label that agree in a substring meet in a bucket and are compared
there with their original components in double precision. The number of bits of a substring follows the logarithm of the
largest label, and the number of tables follows from it and the recall asked for at the threshold.

A bucket beyond BLOCK rows is dealt into blocks, and every pair of blocks is compared by a task of its own, so no row is left
out. A pair that meets in several tables counts in the first. Tasks give sums and spanning links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .graph import components

THRESHOLD, RECALL = 0.93, 0.97
#: Bounds of the sample the rotations are learned from, in vectors and in numbers.
SAMPLE, SAMPLE_NUMBERS = 20_000, 1 << 23
CODE_BITS, ROUNDS, BLOCK = 64, 30, 1024


def tables_for(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a substring, number of tables) for labels of so many vectors at most."""
    bits = min(31, max(8, math.ceil(math.log2(max(1, vectors) / 8))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotations(sample: np.ndarray, bits: int, tables: int, seed: int = 7) -> tuple[np.ndarray, list[np.ndarray]]:
    """The centre, and matrices from components to code bits, enough for all tables.

    Unit vectors stay centred at the origin, which the cosine is about: a mean drawn into one large cluster would split it.
    """
    mean = np.zeros(sample.shape[1])
    _, axes = np.linalg.eigh(sample.T @ sample)
    width = min(CODE_BITS, sample.shape[1])
    axes = axes[:, ::-1][:, :width]
    flat, rng, out = (sample - mean) @ axes, np.random.default_rng(seed), []
    while len(out) * (width // min(bits, width)) < tables:
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        out.append(axes @ turn)
    return mean, out


def substrings(unit: np.ndarray, mean: np.ndarray, turns: list[np.ndarray], bits: int, tables: int) -> np.ndarray:
    """One number for each vector and table."""
    width = turns[0].shape[1]
    size = min(bits, width)
    codes = []
    for turn in turns:
        signs = (unit - mean) @ turn >= 0
        for k in range(width // size):
            codes.append(signs[:, k * size: (k + 1) * size] @ (1 << np.arange(size)))
    return np.stack(codes[:tables], axis=1).astype(np.int32)


def valid(vector: str):
    """Vectors that can have a cosine: no null, NaN or infinite component, and not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _units(vectors: pa.Array) -> np.ndarray:
    rows = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Only vectors of one label and one length are compared. A row with a null label, or with a vector that is null, empty or
    zero or holds null or non-finite components, links with nothing. Rows with equal vectors are copies: one point with a
    weight. Rows that repeat a vec_id are rows of their own; a row without vec_id has no say in component_id, and kept is
    false for it.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    kept = rows.withColumn("ok", F.col("label").isNotNull() & valid("v"))
    kept = kept.withColumn("node", F.when(F.col("ok"), F.concat(F.hex(F.xxhash64("v", "label")), F.lit("-"), F.hex(F.xxhash64("label", "v")))))
    points = kept.filter("ok").groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    points = staged(points.withColumn("size", F.size("v")), "vectors")
    most = points.groupBy("label", "size").count().agg(F.max("count")).first()[0]
    if most is None:
        return kept.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    bits, tables = tables_for(most, threshold, recall)
    sizes = points.groupBy("size").count().orderBy(F.desc("count"), "size").first()["size"]
    sample = points.filter(F.col("size") == sizes).orderBy(F.xxhash64("node"), "node").limit(max(1, min(SAMPLE, SAMPLE_NUMBERS // sizes))).select("v").toArrow()
    mean, turns = rotations(_units(sample["v"].combine_chunks()), bits, tables)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size in set(batch["size"].to_pylist()):
                part = batch.filter(pc.equal(batch["size"], size))
                unit = _units(part["v"])
                fitted = np.zeros((len(unit), len(mean)))  # other lengths are cut or filled for the code alone
                fitted[:, : min(size, len(mean))] = unit[:, : len(mean)]
                codes = substrings(fitted, mean, turns, bits, tables)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(unit) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([part[c] for c in ("node", "label", "size", "weight", "v")] + [lists], ["node", "label", "size", "weight", "v", "codes"])

    label = points.schema["label"].dataType.simpleString()
    codes = staged(points.select("node", "label", "size", "weight", "v").mapInArrow(encode, f"node string, label {label}, size int, weight long, v array<double>, codes array<int>"), "codes")
    spread = codes.select("node", "label", "size", F.posexplode("codes").alias("turn", "code"))
    buckets = spread.groupBy("label", "size", "turn", "code").count().filter("count > 1")
    buckets = staged(buckets.select("label", "size", "turn", "code", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "buckets")
    met = codes.select("*", F.posexplode("codes").alias("turn", "code")).join(buckets, ["label", "size", "turn", "code"])
    own = F.pmod(F.xxhash64("node", "turn"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("task", F.xxhash64("label", "size", "turn", "code", F.least("own", "other"), F.greatest("own", "other")))
    keys = ["task", "label", "size", "turn", "code"]
    dealt = met.withColumn("pair", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).withColumn("same", F.col("own") == F.col("other"))
    dealt = dealt.select(*keys, "pair", "same", "own", "node", "weight", "v", "codes").repartition("task").sortWithinPartitions(*keys, "pair", "own")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cut = _last_group(rest)
            if cut:
                yield from _groups(rest.slice(0, cut), threshold)
            held = rest.slice(cut)
        if held is not None:
            yield from _groups(held, threshold)

    found = staged(dealt.mapInArrow(compare, "node string, links long, root string"), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joint = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct(), "vector-links")
    graph = points.select("node", "weight", "least").join(counts, "node", "left").join(joint, "node", "left").withColumn("component", F.coalesce("component", "node"))
    graph = staged(graph, "linked-vectors")
    least = graph.groupBy("component").agg(F.min("least").alias("component_id"))
    graph = graph.join(least, "component").select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = kept.select("vec_id", "node").join(staged(graph, "vector-groups"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _bounds(rows: pa.Table) -> np.ndarray:
    """Where groups begin; the rows are sorted by group."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in ("task", "size", "turn", "code", "pair"):
        x = rows[name].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    labels = rows["label"].combine_chunks().dictionary_encode()
    x = (labels.combine_chunks() if isinstance(labels, pa.ChunkedArray) else labels).indices.to_numpy()
    new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _last_group(rows: pa.Table) -> int:
    return int(_bounds(rows)[-1]) if len(rows) else 0


def _groups(rows: pa.Table, threshold: float) -> Iterator[pa.RecordBatch]:
    starts = _bounds(rows)
    nodes, weights = rows["node"].combine_chunks(), rows["weight"].to_numpy()
    codes = np.stack(rows["codes"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)) if len(rows) else None
    own, same, turn = rows["own"].to_numpy(), rows["same"].to_numpy(), rows["turn"].to_numpy()
    vectors = rows["v"].combine_chunks()
    out: tuple[list, list, list] = ([], [], [])
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
        if b - a < 2:
            continue
        unit = _units(vectors.slice(a, b - a))
        if same[a]:
            x, y = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
        else:
            first = np.flatnonzero(own[a:b] == own[a])
            second = np.flatnonzero(own[a:b] != own[a])
            x, y = np.nonzero(unit[first] @ unit[second].T >= threshold)
            x, y = first[x], second[y]
        if not len(x):
            continue
        at = int(turn[a])
        once = ~(codes[a:b][x, :at] == codes[a:b][y, :at]).any(axis=1)  # pairs that met in an earlier table count there
        x, y = x[once], y[once]
        if not len(x):
            continue
        w = weights[a:b]
        links = np.bincount(x, w[y], b - a) + np.bincount(y, w[x], b - a)
        root = np.arange(b - a)
        while True:
            before = root.copy()
            np.minimum.at(root, x, root[y])
            np.minimum.at(root, y, root[x])
            root = root[root]
            if (root == before).all():
                break
        hit = np.flatnonzero(links)
        names = nodes.take(pa.array(a + hit)).to_pylist()
        out[0].extend(names)
        out[1].extend(links[hit].astype(np.int64).tolist())
        out[2].extend(nodes.take(pa.array(a + root[hit])).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["node", "links", "root"])
