"""Encoding and decoding with a merge-type piece vocabulary by exact backtracking (operator 13).

Merging the best pair over and over gives one result, and that result is known by its neighbours: a sequence of pieces is the
encoding of its text if and only if every two adjacent pieces, merged anew from their characters, come out as the same two
pieces. So a text is encoded from left to right: an Aho-Corasick automaton gives the longest piece at each place, a piece that
does not stand next to the one before gives way to the next shorter one, and when none is left the last piece is taken back
and the place is marked in a bitfield of failed positions, to be entered never again. No place fails twice, so the work is
linear.

White space becomes a mark, and no piece of the vocabulary goes on past a mark after another character (checked when the
vocabulary is loaded). The stretches between such places are encoded on their own, and those met before are looked up.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

MARK = "▁"
#: Stretches longer than this are not remembered; so many are in each of two generations.
REMEMBERED_LENGTH, REMEMBERED = 48, 400_000


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """Bytes that are no character give one replacement each."""
    return "�", error.start + 1


class PieceCodec:
    """Encoder and decoder of one vocabulary; built once in each Python worker."""

    def __init__(self, model_path: str):
        import codecs

        import ahocorasick
        import sentencepiece

        codecs.register_error("each_byte", _each_byte)
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.normalize = model.normalize
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.unknown = model.unk_id()
        self.byte_ids: list[int] = [self.unknown] * 256
        #: What each id reads as: text, a byte, or nothing.
        self.reads: list[str | int] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.reads.append(int(piece[3:5], 16))
            elif model.is_control(i) or model.is_unknown(i):
                self.reads.append(" ⁇ " if model.is_unknown(i) else "")
            else:
                self.ids[piece], self.rank[piece] = i, model.get_score(i)
                self.reads.append(piece.replace(MARK, " "))
        #: Ids of pieces that begin with a mark: the first one of a text loses it.
        self.spaced = {i for piece, i in self.ids.items() if piece[0] == MARK}
        self.fallback = self.unknown not in self.byte_ids
        # Pieces that merging never makes are in no encoding.
        self.ids = {piece: i for piece, i in self.ids.items() if len(piece) == 1 or self.merged(piece) == [piece]}
        self.alphabet = {c for piece in self.ids for c in piece if c in self.ids}
        across = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        inner = "".join(map(re.escape, sorted(self.alphabet - {MARK})))
        self.stretch = re.compile(f"[{MARK}{inner}]+|[^{MARK}{inner}]" if across else f"{MARK}+[{inner}]*|[{inner}]+|[^{MARK}{inner}]", re.DOTALL)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:  # every character of a stretch is a piece anyway
            if len(piece) > 1:
                self.automaton.add_word(piece, (len(piece), len(piece) - 1))
        self.automaton.make_automaton()
        #: Pairs that have been merged anew: whether they stand next to each other.
        self.stands: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best pair, the leftmost of equals, over and over."""
        parts = [*text]
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank > best):
                    best, at = rank, k
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand(self, left: str, right: str) -> bool:
        found = self.stands.get((left, right))
        if found is None:
            if len(self.stands) >= REMEMBERED:
                self.stands.clear()
            found = self.stands[left, right] = self.merged(left + right) == [left, right]
        return found

    def backtracked(self, text: str) -> list[str]:
        """The pieces of a stretch whose characters are all pieces."""
        size, ids, stand = len(text), self.ids, self.stand
        longest = bytearray(b"\1") * size
        for end, (length, back) in self.automaton.iter(text):
            if length > longest[end - back]:
                longest[end - back] = length
        failed = bytearray((size >> 3) + 1)
        out: list[str] = []
        at, length = 0, longest[0]
        while at < size:
            while length:
                end = at + length
                piece = text[at:end]
                if piece in ids and not failed[end >> 3] >> (end & 7) & 1 and (not at or stand(out[-1], piece)):
                    out.append(piece)
                    at, length = end, longest[end] if end < size else 0
                    break
                length -= 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                length = len(out.pop())
                at -= length
        return out

    def encode_stretch(self, text: str) -> list[int]:
        """Ids of a stretch. A character that is no piece merges with nothing and is a stretch of its own, spelt in bytes."""
        if text in self.ids:  # merging makes it, so it is its own encoding
            return [self.ids[text]]
        if text[0] not in self.alphabet:
            return [self.byte_ids[b] for b in text.encode()] if self.fallback else [self.unknown]
        return [self.ids[p] for p in self.backtracked(text)]

    def known(self, stretch: str) -> tuple[int, str, str]:
        """How many ids a stretch has, the ids as text, and what they read as. Two generations are remembered, so frequent stretches stay when one is full."""
        found = self.memory.get(stretch)
        if found is None:
            found = self.older.get(stretch)
            if found is None:
                ids = self.encode_stretch(stretch)
                found = (len(ids), ",".join(map(str, ids)), self.read(ids))
            if len(stretch) <= REMEMBERED_LENGTH:
                if len(self.memory) >= REMEMBERED:
                    self.older, self.memory = self.memory, {}
                self.memory[stretch] = found
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for s in self.stretch.findall(self.normalize(text)) for i in self.known(s)[1].split(",")]

    def read(self, ids: list[int]) -> str:
        """The text of any ids; runs of byte pieces are read as UTF-8."""
        out: list[str] = []
        held = bytearray()
        for i in ids:
            part = self.reads[i]
            if isinstance(part, int):
                held.append(part)
                continue
            if held:
                out.append(held.decode("utf-8", "each_byte"))
                held.clear()
            out.append(part)
        if held:
            out.append(held.decode("utf-8", "each_byte"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids without the blank that was put before it."""
        first = next((i for i in ids if self.reads[i] != ""), None)
        return self.read(ids)[first in self.spaced:]


@cache
def codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None, with_ids: bool = False) -> DataFrame:
    """The columns of `docs` but text, and n_tokens, ids_sha256, decoded_sha256 and, on request, the ids of every row.

    A null text is an empty one (no tokens). Every row is encoded for itself where it is read, so nulls or repeats of doc_id do not
    matter. Columns of `docs` named as the added ones are replaced.
    """
    model = model or default_model()
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    keep = [x for x in docs.columns if x not in (*added, "text", "_text")]
    source = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            counts, digests, texts, lists = [], [], [], []
            for text in batch["_text"]:
                found = [c.known(s) for s in c.stretch.findall(c.normalize(text.as_py()))]
                counts.append(sum([x[0] for x in found]))
                digests.append(hashlib.sha256(",".join([x[1] for x in found]).encode()).hexdigest())
                # A stretch holds whole characters, so what its ids read as does not depend on its neighbours.
                read = "".join([x[2] for x in found])
                texts.append(hashlib.sha256(read[bool(found) and int(found[0][1].split(",", 1)[0]) in c.spaced:].encode()).hexdigest())
                if with_ids:
                    lists.append([int(i) for x in found for i in x[1].split(",")])
            columns = [batch.column(batch.schema.get_field_index(x)) for x in keep]
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, [*keep, *added])

    schema = source.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return source.mapInArrow(build, schema.add("ids", ArrayType(IntegerType())) if with_ids else schema)


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The texts of `ids` (array of int) as a column `text`; null ids and null entries give nothing."""
    model = model or default_model()
    keep = [x for x in encoded.columns if x != "text"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            texts = [c.decode([i for i in x.as_py() or () if i is not None]) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in keep), pa.array(texts, pa.string())], [*keep, "text"])

    return encoded.select(*keep).mapInArrow(build, encoded.select(*keep).schema.add("text", "string"))
