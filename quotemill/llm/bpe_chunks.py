"""BPE encoding and decoding with content-defined chunk reuse (operator 5).

Every text is cut where a rolling hash of its last 16 bytes hits a mask, so equal passages give equal chunks wherever they
stand. A chunk found in two or more different texts is encoded once, by the text that owns it, and its token ids are joined to
every other text; the rest is encoded in place. Chunks are encoded without their neighbours, so the tokens around each join
are encoded again, from a place before it to one after it where the tokenizer breaks whatever stands around, and the window
grows until both of its ends agree with token edges of the chunks.

The ids are those of the public byte-level vocabulary. Encoding runs in tiktoken, which holds the same ranks; the tests
compare it with the tokenizers library.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import U64, eight_bytes, joined, sieve, sifted, staged

#: The last bytes that decide on a cut, and how many cuts to expect: one in CHUNK_BYTES.
WINDOW, CHUNK_BYTES = 16, 1024
SPECIAL = "<|endoftext|>"
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


class Codec:
    """Encoder and decoder of one vocabulary; built once in each Python worker."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {SPECIAL: len(ranks)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        parts = [b""] * (len(ranks) + 1)
        for part, i in ranks.items():
            parts[i] = part
        parts[len(ranks)] = SPECIAL.encode()
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.raw = np.frombuffer(b"".join(parts), np.uint8)
        self.names = [str(i) for i in range(len(parts))]

    def encode(self, raw: bytes) -> np.ndarray:
        return np.array(self.encoding.encode(raw.decode(), allowed_special="all"), np.uint16)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.raw[at].tobytes()

    def digest(self, ids: np.ndarray) -> str:
        names = self.names
        return hashlib.sha256(",".join([names[i] for i in ids.tolist()]).encode()).hexdigest()


@cache
def codec(ranks_path: str) -> Codec:
    return Codec(ranks_path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cuts(raw: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Where chunks begin and end, 0 and the length included; never inside a character."""
    n = len(raw)
    eight = eight_bytes(raw)
    if len(eight) <= WINDOW // 2:
        return np.array([0, n]) if n else np.array([0])
    names = joined(eight[:-(WINDOW // 2)], eight[WINDOW // 2:])
    ends = np.flatnonzero(names % U64(chunk_bytes) == 0) + WINDOW
    ends = ends[ends < n]
    while (inside := (raw[ends] & 0xC0) == 0x80).any():
        ends = ends + inside
        ends = ends[ends < n]
    return np.unique(np.concatenate(([0], ends, [n])))


def breaks(raw: np.ndarray) -> np.ndarray:
    """Single blanks between two ASCII letters: a token begins at such a blank whatever stands around. Both ends count too."""
    inner = np.flatnonzero(LETTER[raw[:-2]] & (raw[1:-1] == 32) & LETTER[raw[2:]]) + 1 if len(raw) > 2 else np.zeros(0, np.int64)
    return np.concatenate(([0], inner, [len(raw)]))


def chunk_names(raw: bytes, edges: np.ndarray) -> list[bytes]:
    return [hashlib.md5(raw[a:b], usedforsecurity=False).digest() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def encode_text(raw: bytes, known: dict[int, np.ndarray], c: Codec, chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Token ids of a text from its chunks' ids (`known`, by the chunk's place in the text; others are encoded here)."""
    flat = np.frombuffer(raw, np.uint8)
    edges = cuts(flat, chunk_bytes)
    if len(edges) < 2:
        return np.zeros(0, np.uint16)
    if not known:
        return c.encode(raw)
    runs: list[np.ndarray | None] = [known.get(k) for k in range(len(edges) - 1)]
    # Neighbouring chunks that nobody has encoded yet are one stretch: no join between them, nothing to repair.
    keep = [k for k in range(len(runs)) if k == 0 or runs[k] is not None or runs[k - 1] is not None]
    edges = np.array([edges[k] for k in keep] + [len(flat)])
    parts = [runs[k] for k in keep]
    parts = [c.encode(raw[edges[k]: edges[k + 1]]) if ids is None else ids for k, ids in enumerate(parts)]
    ends = [edges[k] + np.cumsum(c.sizes[ids]) for k, ids in enumerate(parts)]
    token_edges = np.concatenate([edges[:1], *ends])
    safe = breaks(flat)
    agreed = safe[np.isin(safe, token_edges)]
    at = edges[1:-1]
    lo = agreed[np.searchsorted(agreed, at, side="right") - 1]
    hi = agreed[np.searchsorted(agreed, at, side="left")]
    ids, out, done = np.concatenate(parts), [], 0
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        if b <= done:
            continue
        a = max(a, done)
        out.append(ids[np.searchsorted(token_edges, done): np.searchsorted(token_edges, a)])
        if b > a:
            out.append(c.encode(raw[a:b]))
        done = b
    out.append(ids[np.searchsorted(token_edges, done):])
    return np.concatenate(out)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, chunk_bytes: int = CHUNK_BYTES, with_ids: bool = False) -> DataFrame:
    """All columns of `docs` but the text's bytes stay; adds n_tokens, ids_sha256, decoded_sha256 and, on request, the ids.

    A null text is an empty one (no tokens). Equal texts share a key, so copies and repeated rows need no doc_id to tell
    them apart; a null doc_id is as good as any. Columns of `docs` named as the added ones are replaced.
    """
    vocabulary = vocabulary or default_vocabulary()
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    keep = [x for x in docs.columns if x not in (*added, "_raw", "_key", "_known")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(*keep, text.cast("binary").alias("_raw"), F.unhex(F.md5(text)).alias("_key"))

    def refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, keys = [], []
            for key, raw in zip(batch["_key"].to_pylist(), batch["_raw"], strict=True):
                raw = raw.as_py()
                found = chunk_names(raw, cuts(np.frombuffer(raw, np.uint8), chunk_bytes))
                names += found
                keys += [key] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(keys, pa.binary())], ["chunk", "_key"])

    # One row per chunk of each different text: the combine on the map side folds copies of whole texts.
    chunks = keyed.select("_raw", "_key").mapInArrow(refs, "chunk binary, _key binary").groupBy("chunk", "_key").agg(F.count("*").alias("n"))
    chunks = staged(chunks, "chunks")
    shared = chunks.groupBy("chunk").agg(F.min("_key").alias("owner"), F.sum("n").alias("n")).filter("n > 1")
    shared = staged(shared.select("chunk", "owner"), "shared-chunks")

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, seen = codec(vocabulary), set()
        for batch in batches:
            names, ids = [], []
            for key, raw, wanted in zip(batch["_key"].to_pylist(), batch["_raw"], batch["wanted"], strict=True):
                if key in seen:  # a copy of the owner's text
                    continue
                seen.add(key)
                raw, wanted = raw.as_py(), set(wanted.as_py())
                edges = cuts(np.frombuffer(raw, np.uint8), chunk_bytes)
                for name, a, b in zip(chunk_names(raw, edges), edges[:-1], edges[1:], strict=True):
                    if name in wanted:
                        wanted.discard(name)
                        names.append(name)
                        ids.append(c.encode(raw[a:b]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(ids, pa.binary())], ["chunk", "ids"])

    owners = shared.groupBy(F.col("owner").alias("_key")).agg(F.collect_list("chunk").alias("wanted"))
    by_owner = sifted(keyed.select("_key", "_raw"), "_key", sieve(owners, "_key")).join(owners, "_key").mapInArrow(owned, "chunk binary, ids binary")
    # Only texts with a shared chunk move to the join; the others are encoded where they are read.
    mixed = sieve(chunks.join(shared, "chunk").select("_key"), "_key")
    book = staged(by_owner.groupBy("chunk").agg(F.min("ids").alias("ids")), "chunk-book")
    known = chunks.select("chunk", "_key").join(book, "chunk").groupBy("_key").agg(F.collect_list(F.struct("chunk", "ids")).alias("_known"))

    schema = keyed.select(*keep).schema
    names = [f.name for f in schema.fields]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            counts, digests, texts, lists = [], [], [], []
            for raw, book_rows in zip(batch["_raw"], batch["_known"], strict=True):
                raw = raw.as_py()
                found = {x["chunk"]: np.frombuffer(x["ids"], np.uint16) for x in book_rows.as_py() or ()}
                places: dict[int, np.ndarray] = {}
                if found:
                    edges = cuts(np.frombuffer(raw, np.uint8), chunk_bytes)
                    places = {k: found[x] for k, x in enumerate(chunk_names(raw, edges)) if x in found}
                ids = encode_text(raw, places, c, chunk_bytes)
                counts.append(len(ids))
                digests.append(c.digest(ids))
                texts.append(hashlib.sha256(c.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(ids.astype(np.int32))
            columns = [batch.column(batch.schema.get_field_index(x)) for x in names]
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    out = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    out = out.add("ids", ArrayType(IntegerType())) if with_ids else out
    moved = sifted(keyed, "_key", mixed).join(known, "_key", "left").select(*names, "_raw", "_known").mapInArrow(finish, out)
    alone = sifted(keyed, "_key", mixed, inside=False).select(*names, "_raw", F.lit(None).cast(known.schema["_known"].dataType).alias("_known"))
    return moved.union(alone.mapInArrow(finish, out))


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The texts of `ids` (array of int) as a column `text`; null ids give an empty text."""
    vocabulary = vocabulary or default_vocabulary()
    schema = encoded.drop("text").schema
    names = [f.name for f in schema.fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            texts = [c.decode(np.array(x.as_py() or [], np.int64)).decode("utf-8", "replace") for x in batch["ids"]]
            columns = [batch.column(batch.schema.get_field_index(x)) for x in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, "text"])

    return encoded.drop("text").mapInArrow(decode, schema.add("text", "string"))
