"""Exact Jaccard join of documents on word shingles, as a join in a metric space (operator 2).

The Jaccard distance is a metric, so distances to a pivot tell which documents may be near each other.

1. Neighbourhoods. Two sets within the limit differ in at most D elements, and D follows from their sizes. Each set is split by
   hash into more than D classes, some of which must be the same in both. A cell is one class with one content, so documents
   that share no cell are too far apart, exactly; most cells hold one set only and end here.
2. Regions. Documents tied together by cells form a region around one of them, its pivot. Documents of different regions share
   no cell. Passages that many documents share tie them all, near or not, so a large region is joined again within itself by the
   shingles that are rarest in it, of which near sets must share one, and parted into smaller regions: first by counts in a sketch of
   fixed size, from the texts and without moving their sets, then by exact counts. This goes on until regions are small enough for
   blocks or do not get smaller.
3. Pivots. The sets of a region are measured against its pivot, and those within the limit are linked to it.
4. Windows. In a region that is not one component yet, links lie between documents whose distances to the pivot differ by no more
   than the limit (triangle inequality): each window of distances is compared with itself and the next one.
5. Blocks. A region of one block is one task. Otherwise a window is dealt into blocks, every pair of blocks is a task, and a task multiplies the incidence matrices of its
   sets, which gives all intersections exactly. Tasks return spanning links, never pairs.

Documents with the same set are one point of the space from the start, so groups of copies cost one comparison.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, groups, joined, mixed, pieces, sieve, sifted, staged, text_bytes
from .graph import components

SHINGLE, PERCENT = 3, 90
#: Two keys of each of a batch's sets, from the names in them and where each set starts.
Keys = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
#: Cells and the nodes that have them, piece by piece, from the rows of a task.
Cells = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]
#: A region of more sets is parted by rare shingles, which reads its sets a few times; a smaller one is compared block by block, which copies
#: each set to as many tasks as there are blocks in its windows. Both are exact.
PARTED = 4096
#: Sets of a block, and columns of an incidence matrix held at once.
BLOCK, COLUMNS = 256, 4096
#: Rows of cells that a task combines at a time.
HELD = 1 << 19
#: Bits of a place in the sketch of counts, places that a row of it holds, and its steps for a doubling of the count. The sketch only
#: orders shingles, and any order gives exact results: places that rare shingles share by chance make regions larger, not wrong.
SKETCH_BITS, SLOT, STEPS = 22, 1024, 8
#: Sizes fall into bands that grow by half; classes beyond D + 1, as a share of them; splittings tried before empty classes count
#: as content.
BAND, SPARE, SPLITS = 1.5, 0.15, 6
BASE = 0x9E3779B97F4A7C15 | 1
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BYTE = mixed(np.arange(1, 257, dtype=U64))


def word_names(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name of each word, and the text it stands in; words never cross texts."""
    n = len(raw)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    inner = ~BLANK[raw]
    opened, closed = inner.copy(), inner.copy()
    opened[1:] &= ~inner[:-1]
    closed[:-1] &= ~inner[1:]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    opened[edges] = inner[edges]
    closed[edges - 1] = inner[edges - 1]
    a, b = np.flatnonzero(opened), np.flatnonzero(closed) + 1
    powers = np.full(n, BASE, U64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(BYTE[FOLD[raw]] * powers)))
    back = np.full(n, pow(BASE, -1, 1 << 64), U64)
    back[0] = 1
    back = np.cumprod(back)
    names = mixed((sums[b] - sums[a]) * back[a] + (b - a).astype(U64) * U64(0xC2B2AE3D27D4EB4F))
    return names, np.searchsorted(starts, a, side="right") - 1


def shingle_sets(raw: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle names sorted by text and name, and where each text's set starts (one more entry than texts)."""
    words, owner = word_names(raw, starts)
    texts = len(starts) - 1
    counts = np.bincount(owner, minlength=texts)
    names, at = words, owner
    for k in range(1, size):
        names = joined(names[:-1], words[k:]) if len(names) > 1 else names[:0]
    full = at[: len(names)] == at[size - 1: size - 1 + len(names)] if len(names) else np.zeros(0, bool)
    names, at = names[full], at[: len(full)][full]
    first = np.concatenate(([0], np.cumsum(counts)))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for t in short.tolist():
            own = words[first[t]: first[t + 1]]
            name = mixed(own[:1] + U64(len(own)))
            for k in range(1, len(own)):
                name = joined(name, own[k: k + 1])
            whole.append(name[0])
        names, at = np.concatenate((names, np.array(whole, U64))), np.concatenate((at, short))
    order = np.lexsort((names, at))
    names, at = names[order], at[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (at[1:] != at[:-1])
    names, at = names[new], at[new]
    return names, np.searchsorted(at, np.arange(texts + 1))


def set_keys(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set; equal sets have equal keys. Empty sets have key 0."""
    full = np.flatnonzero(np.diff(first))
    low, high = np.zeros(len(first) - 1, U64), np.zeros(len(first) - 1, U64)
    if len(full):
        low[full] = mixed(np.add.reduceat(mixed(names), first[full]) + np.diff(first)[full].astype(U64))
        high[full] = mixed(np.add.reduceat(mixed(names ^ U64(0xA0761D6478BD642F)), first[full]))
    return low, high


def bands(percent: int) -> list[tuple[int, int, int, int]]:
    """(first size, end, most differing elements, classes) of sets in a band, or whose larger partner may lie in it."""
    edges, at = [], 1
    while at < 1 << 40:
        edges.append(at)
        at = max(at + 1, int(at * BAND))
    most = [2 * (b - 1) * (100 - percent) // (100 + percent) for b in edges[1:]]
    return [(a, b, d, d + 1 + math.ceil(SPARE * (d + 1))) for a, b, d in zip(edges[:-1], edges[1:], most, strict=True)]


def cells_of(names: np.ndarray, percent: int, table: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The cells of one set: for its own band, and for those of larger partners.

    D differing elements leave classes - D classes alike. Two sets miss each other only if all of these are empty, and then both
    have that many empty classes and both try the next splitting.
    """
    n, out = len(names), []
    most = n * 100 // percent
    for j, (a, b, differing, classes) in enumerate(table):
        if not (a <= n < b or n < a <= most) or not differing:
            continue
        for split in range(SPLITS):
            which = (joined(names, np.full(1, split + 1, U64)) % U64(classes)).astype(np.int64)
            content, count = np.zeros(classes, U64), np.bincount(which, minlength=classes)
            np.add.at(content, which, mixed(names))
            place = joined(np.full(1, (j << 8) + split, U64), np.arange(classes, dtype=U64))
            cell = joined(place, content)
            last = split == SPLITS - 1
            out.append(cell if last else cell[count > 0])
            if (count == 0).sum() < classes - differing:
                break
    return np.concatenate(out) if out else np.zeros(0, U64)


def sets_of(docs: DataFrame, size: int = SHINGLE, keys: Keys = set_keys) -> DataFrame:
    """doc_id, said (a hash of the text), n_shingles, node and check (the two keys of the set; null without words) of each row."""
    schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "said", "n_shingles", "node", "check")])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, first = shingle_sets(*text_bytes(batch), size)
            low, high = keys(names, first)
            empty = np.diff(first) == 0
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["said"], pa.array(np.diff(first), pa.int64()), *(pa.array(x.view(np.int64), mask=empty) for x in (low, high))], schema=schema)

    return _said(docs).mapInArrow(build, "doc_id long, said long, n_shingles long, node long, check long")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _said(docs: DataFrame) -> DataFrame:
    return _plain(docs).select("doc_id", "text", F.xxhash64("text").alias("said"))


def _cells(batches: Iterator[pa.RecordBatch], size: int, percent: int, keys: Keys) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and nodes of the sets of a task, piece by piece; a set's cells are given once, however many copies the task reads."""
    table, seen = bands(percent), set()
    for batch in pieces(batches):
        names, first = shingle_sets(*text_bytes(batch), size)
        found, owner = [np.zeros(0, U64)], [np.zeros(0, U64)]
        for t, (node, check) in enumerate(zip(*(x.tolist() for x in keys(names, first)), strict=True)):
            if (node, check) not in seen:
                seen.add((node, check))
                own = cells_of(names[first[t]: first[t + 1]], percent, table)
                found.append(own)
                owner.append(np.full(len(own), node, U64))
        yield np.concatenate(found).view(np.int64), np.concatenate(owner).view(np.int64)


def _ends(cell: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """(cell, lo, hi): the smallest node of each cell, and the largest if it is another."""
    order = np.argsort(cell, kind="stable")
    cell, node = cell[order], node[order]
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    lo, hi = np.minimum.reduceat(node, start), np.maximum.reduceat(node, start)
    return pa.RecordBatch.from_arrays([pa.array(cell[start]), pa.array(lo), pa.array(hi, mask=lo == hi)], ["cell", "lo", "hi"])


def cells(rows: DataFrame, own: Cells) -> DataFrame:
    """(cell, node) of every set."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, node in own(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(node)], ["cell", "node"])

    return rows.mapInArrow(build, "cell long, node long")


def shared_cells(rows: DataFrame, own: Cells) -> DataFrame:
    """(cell, lo) of the cells that several sets have, with the smallest node.

    Nearly all cells have one set, so a hash table of them before the shuffle would be as large as the rows themselves. Runs of HELD rows
    are combined where they are made, which is enough for cells that many sets have, and Spark aggregates behind the shuffle. A cell
    of one set moves its node once.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in own(batches):
            if len(part[0]):
                held.append(part)
            if sum(len(cell) for cell, _ in held) >= HELD:
                yield _ends(*map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield _ends(*map(np.concatenate, zip(*held, strict=True)))

    ends = rows.mapInArrow(build, "cell long, lo long, hi long").repartition("cell")
    return ends.groupBy("cell").agg(F.min("lo").alias("lo"), F.max(F.coalesce("hi", "lo")).alias("hi")).filter("lo <> hi").select("cell", "lo")


def ties_of(rows: DataFrame, own: Cells, name: str) -> DataFrame:
    """(a, b): every set that shares a cell, and the smallest set of that cell."""
    shared = staged(shared_cells(rows, own), f"shared-{name}")
    found = sifted(cells(rows, own), "cell", sieve(shared, "cell")).join(shared, "cell")
    return staged(found.select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct(), "ties")


def texts_of(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, pivot, text) of the sets in `involved` (node, pivot, doc_id, said): a text for each, or several that are equal.

    Texts move here, not sets of 64-bit names, which take more room and do not compress.
    """
    return sifted(_said(docs), "doc_id", sieve(involved, "doc_id")).join(involved, ["doc_id", "said"]).select("node", "pivot", "text")


def shingles(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of each set in `texts`, once."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, first = shingle_sets(*text_bytes(batch), size)
            yield pa.RecordBatch.from_arrays([batch["node"], pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(names.view(np.int64)))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(build, "node long, shingles array<long>").dropDuplicates(["node"])


def _named(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes of the sets in a piece, the names of their shingles within their regions, and where each set starts."""
    for batch in pieces(batches):
        names, first = shingle_sets(*text_bytes(batch), size)
        yield batch["node"].to_numpy(), joined(np.repeat(batch["pivot"].to_numpy().view(U64), np.diff(first)), names), first


def _place(names: np.ndarray) -> np.ndarray:
    return (names & U64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def crowding(texts: DataFrame, size: int) -> np.ndarray:
    """For each place of the sketch the logarithm of how many shingles of the sets in `texts` fall there, in steps: 4 MiB whatever it counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for _, names, _ in _named(batches, size):
            np.add.at(counts, _place(names), 1)
        rows = counts.reshape(-1, SLOT)
        filled = np.flatnonzero(rows.any(axis=1))
        for start in range(0, len(filled), 256):
            part = filled[start: start + 256]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([x.tobytes() for x in rows[part]], pa.binary())], ["slot", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["slot"]):
            total = np.zeros(SLOT, np.int64)
            for counts in rows["counts"]:
                total += np.frombuffer(counts.as_py(), np.uint32)
            levels = np.minimum(255, STEPS * np.log2(total + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([rows["slot"].combine_chunks()[:1], pa.array([levels.tobytes()], pa.binary())], ["slot", "levels"])

    dealt = texts.mapInArrow(count, "slot long, counts binary").repartition("slot").sortWithinPartitions("slot")
    out = np.zeros(1 << SKETCH_BITS, np.uint8).reshape(-1, SLOT)
    for row in staged(dealt.mapInArrow(add, "slot long, levels binary"), "sketch").toArrow().to_pylist():  # 2 ** 12 rows at most
        out[row["slot"]] = np.frombuffer(row["levels"], np.uint8)
    return out.reshape(-1)


def _rare(batches: Iterator[pa.RecordBatch], size: int, percent: int, levels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each set the shingles in the least crowded places, one more than a near set can lack: near sets have one of them in common."""
    for node, names, first in _named(batches, size):
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((names, levels[_place(names)], owner))
        kept = np.arange(len(names)) - first[owner] < (n * (100 - percent) // 100 + 1)[owner]
        yield names[order][kept].view(np.int64), node[owner[kept]]


def link_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, keys: Keys = set_keys) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that links reach.

    A row without words or with a null text links with nothing, nor does a row without doc_id (its component is null). Rows
    that repeat a text are copies; rows that repeat a doc_id are judged one by one and share the number.
    """
    rows, labels, _ = _linked(docs, size, percent, keys)
    return _numbered(rows, labels)


def _numbered(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def _points(rows: DataFrame) -> DataFrame:
    named = rows.filter("doc_id IS NOT NULL AND node IS NOT NULL")
    return named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min_by("said", "doc_id").alias("said"), F.min("check").alias("check"), F.max("check").alias("other"))


def _apart(rows: DataFrame, twins: DataFrame | None) -> DataFrame:
    """`rows` with a node of its own for each set: of different sets with one key, the one with the least check keeps it, and the others
    take a key made of both. `twins` has (node, least) of such keys; few tables have any, as the key has 64 bits."""
    if twins is None:
        return rows
    node = F.when(F.col("check") != F.col("least"), F.xxhash64("node", "check")).otherwise(F.col("node"))
    return rows.join(twins, "node", "left").withColumn("node", node).select(*rows.columns)


def _linked(docs: DataFrame, size: int, percent: int, keys: Keys = set_keys) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The sets of all rows, (node, least doc_id, component) of each set, and the keys that several sets have, if any.

    A set is known by both keys, 128 bits. Cells carry the first only: where it stands for several sets, these are tied, and from there on each has its own node.
    """
    rows, twins, doubled = staged(sets_of(docs, size, keys), "shingle-sets"), None, None
    points = staged(_points(rows), "points")
    shared_keys = points.filter("check <> other").select("node", F.col("check").alias("least"))
    if not shared_keys.isEmpty():
        twins = staged(shared_keys, "shared-keys")
        again = rows.join(twins, "node").filter("doc_id IS NOT NULL AND check <> least")
        doubled = staged(again.select(F.xxhash64("node", "check").alias("a"), F.col("node").alias("b")).distinct(), "parted-keys")
        rows = _apart(rows, twins)
        points = staged(_points(rows), "points")
    known = docs.filter("doc_id IS NOT NULL")
    ties = ties_of(_plain(known), partial(_cells, size=size, percent=percent, keys=keys), "cells")
    if doubled is not None:
        ties = ties.union(doubled)
    found = None
    if not ties.isEmpty():
        regions = components(ties).select("node", F.col("component").alias("pivot"))
        involved = staged(regions.join(points, "node").select("node", "pivot", "doc_id", "said"), "involved")
        involved = thinned(docs, involved, size, percent)
        sets = staged(shingles(texts_of(docs, involved), size), "involved-sets")
        links = region_links(sets.join(parted(sets, involved.select("node", "pivot"), percent), "node"), percent)
        found = components(links)
    labels = points.select("node", "doc_id")
    if found is not None:
        joint = labels.join(found, "node")
        least = joint.groupBy("component").agg(F.min("doc_id").alias("least"))
        labels = labels.join(joint.join(least, "component").select("node", "least", "component"), "node", "left").select(
            "node", F.coalesce("least", "doc_id").alias("least"), F.coalesce("component", "node").alias("component"))
    else:
        labels = labels.select("node", F.col("doc_id").alias("least"), F.col("node").alias("component"))
    return rows, staged(labels, "labels"), twins


def thinned(docs: DataFrame, involved: DataFrame, size: int, percent: int) -> DataFrame:
    """`involved` (node, pivot, doc_id, said) with the regions of more than PARTED sets parted by shingles that are rare by the sketch;
    sets that share none of these are left out.

    The fewer sets a sketch counts, the more it tells apart: the next round is worth its while as long as large regions lose half their sets.
    """
    columns, before = ["node", "pivot", "doc_id", "said"], None
    while True:
        counts = involved.groupBy("pivot").agg(F.count("*").alias("members"))
        large = staged(counts.filter(F.col("members") > PARTED), "large-regions")
        now = large.agg(F.sum("members")).first()[0]
        if now is None or before is not None and 2 * now > before:
            return involved
        # Read and joined anew by each pass: written once, the texts would lie beside everything that follows.
        texts = texts_of(docs, staged(involved.join(large, "pivot", "left_semi"), "large-region-sets"))
        ties = ties_of(texts, partial(_rare, size=size, percent=percent, levels=crowding(texts, size)), "rare-shingles")
        smaller = components(ties).select("node", F.col("component").alias("pivot")).join(involved.drop("pivot"), "node")
        involved = staged(involved.join(large, "pivot", "left_anti").select(*columns).union(smaller.select(*columns)), "thinned-regions")
        before = now


def parted(sets: DataFrame, regions: DataFrame, percent: int) -> DataFrame:
    """`regions` (node, pivot) with those of more than PARTED sets parted as far as rare shingles tell; sets tied to nothing are left out.

    A set within the limit of x lacks at most a known number of x's shingles. So among so many and one more of the rarest of each
    (rarity within the region, one order for all) one is common to both. Shingles that no other set has need not be named, only counted.
    """
    done: list[DataFrame] = []
    while True:
        counts = regions.groupBy("pivot").agg(F.count("*").alias("members"))
        large = staged(counts.filter(F.col("members") > PARTED), "large-regions")
        if large.isEmpty():
            break
        done.append(regions.join(large, "pivot", "left_anti").select("node", "pivot"))
        wide = regions.join(large, "pivot")
        own = sets.join(wide, "node").select("node", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"), "pivot")
        own = own.select("node", "n", F.xxhash64("pivot", "s").alias("cell"))
        often = staged(own.groupBy("cell").agg(F.count("*").alias("often")).filter("often > 1"), "shared-shingles")
        found = own.join(often, "cell").groupBy("node", "n").agg(F.collect_list(F.struct("often", "cell")).alias("found"))
        first = F.expr(f"slice(sort_array(found), 1, greatest(0, cast(n * {100 - percent} div 100 + 1 - (n - size(found)) AS int)))")
        rare = staged(found.select("node", F.explode(first).alias("x")).select("node", "x.cell"), "rare-shingles")
        least = rare.groupBy("cell").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("cell", "lo")
        ties = staged(rare.join(least, "cell").select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct(), "ties")
        if ties.isEmpty():
            regions = regions.limit(0)
            break
        smaller = components(ties).select("node", F.col("component").alias("pivot"))
        now = smaller.groupBy("pivot").agg(F.count("*").alias("now"))
        sized = staged(smaller.join(now, "pivot").join(wide.select("node", "members"), "node"), "smaller-regions")
        done.append(sized.filter("now = members").select("node", "pivot"))
        regions = sized.filter("now < members").select("node", "pivot")
    for part in done:
        regions = regions.select("node", "pivot").union(part)
    return staged(regions, "parted-regions")


def region_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span the components inside each region; `sets` has node, shingles and the region's pivot."""
    pivots = sets.filter("node = pivot").select("pivot", F.col("shingles").alias("_p"))
    sizes = sets.join(pivots, "pivot").withColumn("common", F.size(F.array_intersect("shingles", "_p")).cast("long")).withColumn("union", F.size("shingles") + F.size("_p") - F.col("common"))
    linked = 100 * F.col("common") >= percent * F.col("union")
    # In whole numbers: fractions would put distances that lie on the limit's multiples one window off, and linked sets two apart.
    window = F.expr(f"100 * (union - common) div (union * {100 - percent})").cast("int")
    stars = staged(sizes.select("node", "pivot", window.alias("window"), linked.alias("linked")), "distances")
    first = stars.filter("linked AND node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    # A region whose documents all hang on the pivot is one component.
    unsettled = stars.groupBy("pivot").agg(F.min("linked").alias("all"), F.count("*").alias("n")).filter("NOT all").select("pivot", "n")
    open_rows = staged(stars.join(unsettled, "pivot").select("node", "pivot", F.when(F.col("n") <= BLOCK, 0).otherwise(F.col("window")).alias("window")), "windows")
    counts = staged(open_rows.groupBy("pivot", "window").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    placed = open_rows.join(counts, ["pivot", "window"])
    for name, step in (("up", -1), ("down", 1)):
        placed = placed.join(counts.select("pivot", (F.col("window") + step).alias("window"), F.col("blocks").alias(name)), ["pivot", "window"], "left")
    own, none = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.array().cast("array<struct<kind:int,at:int,x:int,y:int,side:int>>")

    def task(kind: int, at, x, y, side):
        return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"))

    def blocks(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    here = F.col("window")
    tasks = F.concat(
        F.transform(blocks("blocks"), lambda k: task(0, here, F.least("own", k), F.greatest("own", k), F.col("own") > k)),
        F.when(F.col("up").isNotNull(), F.transform(blocks("up"), lambda k: task(1, here, F.col("own"), k, F.lit(0)))).otherwise(none),
        F.when(F.col("down").isNotNull(), F.transform(blocks("down"), lambda k: task(1, here - 1, k, F.col("own"), F.lit(1)))).otherwise(none))
    dealt = placed.withColumn("own", own).select("node", "pivot", F.explode(tasks).alias("t")).select("node", "pivot", "t.*")
    keys = ["task", "pivot", "kind", "at", "x", "y"]
    dealt = dealt.withColumn("task", F.xxhash64("pivot", "kind", "at", "x", "y")).join(sets.select("node", "shingles"), "node")
    dealt = dealt.select(*keys, "side", "node", "shingles").repartition("task").sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, keys):
            yield _spanning(rows, percent)

    return first.union(staged(dealt.mapInArrow(compare, "a long, b long"), "window-links"))


def _spanning(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """Links that span the components among the sets of one task."""
    lists = rows["shingles"].combine_chunks()
    node, sizes = rows["node"].to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    values, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    side = rows["side"].to_numpy()
    inner = rows["kind"][0].as_py() == 0 and rows["x"][0].as_py() == rows["y"][0].as_py()
    left, right = (np.arange(len(sizes)),) * 2 if inner else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    often = count > 1  # others are in no intersection
    number = np.cumsum(often) - 1
    keep = often[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        part = np.zeros((len(sizes), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        common += part[left] @ part[right].T
    common = common.astype(np.int64)
    hit = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
    x, y = np.nonzero(np.triu(hit, 1) if inner else hit)
    x, y, root = left[x], right[y], np.arange(len(sizes))
    while True:
        before = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(sizes)))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])


def one_of_each_group(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, keys: Keys = set_keys) -> DataFrame:
    """One row of `docs` for each group, of the smallest doc_id in it. Rows that repeat a doc_id are judged one by one: those of
    different groups all stay, of those in one group the one with the smallest set key. Rows without doc_id stay."""
    rows, labels, twins = _linked(docs, size, percent, keys)
    keep = staged(_numbered(rows, labels).filter("doc_id = component_id").select("doc_id").distinct(), "representatives")
    named = docs.join(keep, "doc_id", "left_semi").select(*docs.columns)
    again = staged(named.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return named.union(docs.filter("doc_id IS NULL"))
    own = rows.join(again, "doc_id", "left_semi").join(labels, "node", "left").filter("node IS NULL OR least = doc_id")
    chosen = staged(own.groupBy("doc_id", "component").agg(F.min("node").alias("node")).select("doc_id", "node"), "chosen-sets")
    twice = _apart(_with_node(named.join(again, "doc_id", "left_semi").select(*docs.columns), size, keys), twins)
    same = (twice["row.doc_id"].cast("long") == chosen["doc_id"]) & twice["node"].eqNullSafe(chosen["node"])
    one = twice.join(chosen, same, "left_semi").withColumn("_id", F.col("row.doc_id")).dropDuplicates(["_id", "node"]).select("row.*")
    return named.join(again, "doc_id", "left_anti").select(*docs.columns).union(one).union(docs.filter("doc_id IS NULL"))


def _with_node(docs: DataFrame, size: int, keys: Keys = set_keys) -> DataFrame:
    """(row, node, check) with the keys of each row's set, null without words."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch["_text"]:
                raw = (text.as_py() or "").encode()
                names, first = shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), size)
                found.append([int(x.view(np.int64)[0]) if len(names) else None for x in keys(names, first)])
            yield pa.RecordBatch.from_arrays([batch["row"], *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], ["row", "node", "check"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("_text"))
    none = F.lit(None).cast("long")
    return rows.mapInArrow(build, rows.select("row", none.alias("node"), none.alias("check")).schema)
