"""Removal of long repeated byte strings by distributed prefix doubling (operator 3).

A rank names the string of some length at a position: equal ranks, equal strings. Ranks of length 8 are the bytes themselves,
and ranks of length 2h are named by the pair of ranks at p and p + h, the offset doubling each round. Positions whose rank is
unique can start no repeated string, so they leave, and the next round sorts fewer pairs, until the length has passed the
threshold of 200 bytes.

Sorting every position of the corpus at short lengths would move many times the input, so the rounds are sparse:

* 64 bytes: only one position of each run of strings is sorted, the one with the smallest rank in the string (leftmost of
  equals). The choice depends on the string's bytes alone, so equal strings choose alike, and a unique choice settles its run.
* run: the whole stretch that a run of strings covers, named by pairs of ranks of length 128. Equal stretches repeat as a whole.
* 184 and 216 bytes: where stretches differ, the strings of a run in cells of 17 starts: what all strings of the cell share
  (unique: none repeats), and all they cover (repeated: all repeat).
* 200 bytes: the strings of what is left, one by one.

Texts that occur more than once repeat as a whole; they stand for one text in every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, eight_bytes, held, joined, pieces, sieve, sifted, staged, text_bytes

LENGTH, RANK, CELL = 200, 64, 17
#: Starts a string offers to the choice, and how many positions one choice looks at (an offset fits in BITS).
STARTS, BITS = LENGTH - RANK + 1, 20
#: Bytes of text ranked at once: the arrays of a piece stay in the processor's cache. A longer text is one piece.
PIECE = 1 << 16


def ranks(raw: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of `length` (a power of two from 8 on) at every position that has one."""
    names, h = eight_bytes(raw), 8
    while h < length:
        names = joined(names[:-h], names[h:]) if len(names) > h else names[:0]
        h *= 2
    return names


def paired(long: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of strings of 128 to 256 bytes from the pair of ranks of length 128 at both of their ends."""
    return joined(long[at], long[at + (length - 128)])


def runs(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, first start, last start (places within the text), anchor, its rank and the rank of the stretch, for each run."""
    short = ranks(raw, RANK)
    long = joined(short[:-RANK], short[RANK:]) if len(short) > RANK else short[:0]
    step, none = (1 << BITS) - 2 * LENGTH, np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, max(len(raw) - LENGTH + 1, 0), step):
        part = short[begin: begin + step + STARTS - 1]
        least = (part >> U64(BITS) << U64(BITS)) | np.arange(len(part), dtype=U64)
        width = 1
        while width * 2 <= STARTS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (STARTS - width)], least[STARTS - width:])
        anchor = (least & U64((1 << BITS) - 1)).astype(np.int64) + begin
        at = np.arange(begin, begin + len(anchor))
        text = np.searchsorted(starts, at, side="right") - 1
        whole = at + LENGTH <= starts[text + 1]
        at, anchor, text = at[whole], anchor[whole], text[whole]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1 if len(first) else first
        found.append((text[first], at[first], at[last], anchor[first]))
    text, lo, hi, anchor = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none, none)
    size = hi - lo + LENGTH
    stretch = joined(joined(long[lo], long[lo + (size - 128) // 2]), long[lo + size - 128])
    stretch = joined(stretch, (size * 1024 + (anchor - lo)).astype(U64))
    return text, lo - starts[text], hi - starts[text], anchor - starts[text], short[anchor], stretch


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(text).alias("key"), text.alias("text"))


def _once(batch: pa.RecordBatch, seen: set[int]) -> pa.RecordBatch:
    """Rows whose key is new to the task."""
    new = []
    for i, key in enumerate(batch["key"].to_pylist()):
        if key not in seen:
            seen.add(key)
            new.append(i)
    return batch.take(pa.array(new, pa.int64()))


def _with_lists(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """The texts named in `lists`, each once, with their list: few move, and copies leave before they do."""
    kept = sieve(lists, "key", hashed=True)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            yield _once(batch.filter(pa.array(held(kept, batch["key"].to_numpy()))), seen)

    few = texts.mapInArrow(once, texts.schema)
    return few.join(lists, "key").dropDuplicates(["key"])


def all_runs(texts: DataFrame, kept: np.ndarray | None = None) -> DataFrame:
    """The runs of every text, or those whose rank may be in a sieve of ranks; a task gives those of a text once, however many copies it reads."""
    names = ["rank", "stretch", "key", "at", "last", "anchor"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, limit=PIECE):
            batch = _once(batch, seen)
            text, lo, hi, anchor, rank, stretch = runs(*text_bytes(batch))
            key = batch["key"].to_numpy()[text]
            columns = [rank.view(np.int64), stretch.view(np.int64), key, lo, hi, anchor]
            if kept is not None:
                hit = held(kept, columns[0])
                columns = [x[hit] for x in columns]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns[:3]), *(pa.array(x, pa.int32()) for x in columns[3:])], names)

    return texts.mapInArrow(build, "rank long, stretch long, key long, at int, last int, anchor int")


def repeated(rows: DataFrame, rank: str, inner: str) -> DataFrame:
    """Ranks found twice or more, and whether all of them have one and the same inner rank."""
    return rows.groupBy(rank).agg(F.count("*").alias("n"), F.min(inner).alias("lo"), F.max(inner).alias("hi")).filter("n > 1").select(rank, (F.col("lo") == F.col("hi")).alias("same"))


def settled(left: DataFrame, rank: str, inner: str, name: str, *place: str) -> tuple[DataFrame, DataFrame]:
    """From rows of repeated ranks: the ranges that repeat as a whole, and one range of each other inner rank, which goes on."""
    differing = left.filter("NOT same")
    inners = staged(differing.groupBy(rank, inner).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("one")), name)
    twice = inners.filter("n > 1").select(rank, inner)
    whole = left.filter("same").select("key", "at", "last").union(differing.join(twice, [rank, inner]).select("key", "at", "last"))
    return whole, inners.select("one.*")


def repeated_starts(texts: DataFrame) -> DataFrame:
    """(key, at, last): ranges of starts of strings that also start elsewhere; `texts` has key and text."""
    found = staged(repeated(all_runs(texts), "rank", "stretch"), "repeated-ranks")
    left = staged(all_runs(texts, sieve(found, "rank", hashed=True)).join(found, "rank"), "repeated-runs")
    whole, going_on = settled(left, "rank", "stretch", "stretches", "key", "at", "last", "anchor")

    # One run of each stretch goes on: what it finds settles a single stretch; the runs of a repeated one are settled already.
    near = _with_lists(texts, staged(going_on.groupBy("key").agg(F.collect_list(F.struct("at", "last", "anchor")).alias("open")), "open-runs"))
    cells = staged(near.mapInArrow(_cells, "core long, hull long, key long, at int, last int"), "cells")
    found = staged(repeated(cells, "core", "hull"), "repeated-cores")
    left = sifted(cells, "core", sieve(found, "core")).join(found, "core")
    whole_cells, going_on = settled(left, "core", "hull", "hulls", "key", "at", "last", "core")

    near = _with_lists(texts, staged(going_on.groupBy("key").agg(F.collect_list(F.struct("at", "last", "core")).alias("open")), "open-cells"))
    strings = staged(near.mapInArrow(_strings, "core long, name long, key long, at int"), "strings")
    names = staged(strings.groupBy("core", "name").count().filter("count > 1").select("core", "name"), "repeated-strings")
    ones = sifted(strings, "name", sieve(names, "name")).join(names, ["core", "name"]).select("key", "at", F.col("at").alias("last"))
    return whole.union(whole_cells).union(ones)


def _open(batch: pa.RecordBatch, *fields: str) -> tuple[np.ndarray, ...]:
    """Text of each open range, and its fields."""
    rows = batch["open"].to_pylist()
    text = np.repeat(np.arange(len(rows)), np.array([len(x) for x in rows], np.int64))
    return text, *(np.array([r[c] for x in rows for r in x], np.int64) for c in fields)


def _each(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts 2, 3: owners 0 0 1 1 1 and numbers 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of open runs: starts whose distance to the anchor is of one stretch of CELL, cut to the run."""
    for batch in pieces(batches, limit=PIECE):
        raw, starts = text_bytes(batch)
        long = ranks(raw, 128)
        text, at, last, anchor = _open(batch, "at", "last", "anchor")
        if not len(at):
            continue
        nearest = (anchor - last) // CELL
        run, number = _each((anchor - at) // CELL - nearest + 1)
        text, at, last, anchor = text[run], at[run], last[run], anchor[run]
        share = anchor - (nearest[run] + number) * CELL  # the cell's last start if no run's end cut it
        lo, hi, base = np.maximum(share - (CELL - 1), at), np.minimum(share, last), starts[text]
        core = joined(paired(long, base + share, LENGTH - (CELL - 1)), (anchor - share).astype(U64))
        hull = joined(paired(long, base + lo, LENGTH), long[base + hi + LENGTH - 128])
        hull = joined(hull, ((hi - lo) * 1024 + (anchor - lo)).astype(U64))
        key = batch["key"].to_numpy()[text]
        yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (core, hull)), pa.array(key), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["core", "hull", "key", "at", "last"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of open cells, one by one."""
    for batch in pieces(batches, limit=PIECE):
        raw, starts = text_bytes(batch)
        long = ranks(raw, 128)
        text, at, last, core = _open(batch, "at", "last", "core")
        if not len(at):
            continue
        cell, number = _each(last - at + 1)
        text, start = text[cell], at[cell] + number
        name = paired(long, starts[text] + start, LENGTH)
        yield pa.RecordBatch.from_arrays([pa.array(core[cell]), pa.array(name.view(np.int64)), pa.array(batch["key"].to_numpy()[text]), pa.array(start, pa.int32())], ["core", "name", "key", "at"])


def removed_ranges(lists: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal covered stretches of bytes from ranges of starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["at"], x["last"] + LENGTH) for x in lists):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return [(a, min(b, size)) for a, b in out]


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and on request what is kept as `kept` (binary, as a cut
    may fall inside a character).

    A null or empty text has no bytes and keeps none; texts under 200 bytes keep all. Rows that repeat a text are places where
    its strings start, whatever their doc_id (null or repeated ids too).
    """
    texts = _texts(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = staged(docs.select("doc_id", F.xxhash64(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha")), "texts")
    weights = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("sha").alias("lo"), F.max("sha").alias("hi"))
    weights = staged(weights.filter("n > 1"), "copied-texts")
    if not weights.filter("lo <> hi").isEmpty():
        raise ValueError("two different texts have the same key")
    lists = staged(repeated_starts(texts).groupBy("key").agg(F.collect_list(F.struct("at", "last")).alias("open")), "repeated-starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept = [], [], [], []
            for text, ranges in zip(batch["text"], batch["open"].to_pylist(), strict=True):
                raw = text.as_py().encode()
                gone = removed_ranges(ranges, len(raw))
                edges = [0, *(x for r in gone for x in r), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                removed.append(len(raw) - len(rest))
                spans.append(len(gone))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_text else None)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())], ["key", "n_removed", "n_spans", "kept_sha256", "kept"])

    results = staged(_with_lists(texts, lists).mapInArrow(cut, "key long, n_removed long, n_spans long, kept_sha256 string, kept binary"), "cut-texts")
    copied = (F.coalesce("n", F.lit(1)) > 1) & (F.col("n_bytes") >= LENGTH)
    out = rows.join(weights.select("key", "n"), "key", "left").join(results, "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if not with_text:
        return out.select(*columns)
    whole = texts.dropDuplicates(["key"]).select("key", F.col("text").cast("binary").alias("whole"))
    return out.join(whole, "key").select(*columns, F.when(copied, F.lit(b"")).otherwise(F.coalesce("kept", "whole")).alias("kept"))
