"""Fill-in-the-middle transformation over indexable skip lists (operator 12).

A text is a sequence of units (a word with the white space before it; white space at the end is a unit of its own). The skip
list of a text holds the units in its lowest lane; every lane above keeps each node with a chance of one in four. A link
carries how many units and how many code points it spans, so a rank is reached by going right while the accumulated units
allow it, and down otherwise; the code points gathered on the way are the place of the cut.

Documents are judged one by one where they are read: nothing moves between tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, pieces, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: The seed of all draws, the percentage of texts that are cut, and of these the percentage with the suffix first.
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


class SkipList:
    """Units of given code-point widths; `place(rank)` is the number of code points in the first `rank` units."""

    def __init__(self, widths: np.ndarray):
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(widths, dtype=np.int64)))
        nodes, tower = np.arange(len(at)), mixed(np.arange(len(at), dtype=U64))
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        down = np.zeros(0, np.int64)
        while True:
            # The head (node 0) is in every lane; a link's widths are those of the units between its two nodes.
            self.lanes.append((np.diff(nodes), np.diff(at[nodes]), down))
            if len(nodes) <= 4:
                break
            stays = (tower & U64(3)) == 0
            stays[0] = True
            if stays.all():
                break
            tower, down, nodes = tower[stays] >> U64(2), np.flatnonzero(stays), nodes[stays]

    def place(self, rank: int) -> int:
        units = points = node = 0
        for unit_widths, point_widths, down in reversed(self.lanes):
            while node < len(unit_widths) and units + unit_widths[node] <= rank:
                units += int(unit_widths[node])
                points += int(point_widths[node])
                node += 1
            node = int(down[node]) if len(down) else node
        if units != rank:
            raise IndexError(rank)
        return points


def unit_widths(raw: np.ndarray) -> np.ndarray:
    """Code points of each unit of a text given as UTF-8 bytes."""
    if not len(raw):
        return np.zeros(0, np.int64)
    inner = ~BLANK[raw]
    ends = np.flatnonzero(inner[:-1] & ~inner[1:]) + 1
    ends = np.concatenate((ends, [len(raw)]))  # a last word, or the white space after it
    points = np.concatenate((np.zeros(1, np.int64), np.cumsum((raw & 0xC0) != 0x80)))
    return np.diff(points[ends], prepend=0)


@dataclass
class Cut:
    """How a text is cut: its number of units, the form, and the code points of prefix and middle (none in a plain text)."""

    units: int
    form: str
    prefix: int | None = None
    middle: int | None = None


def cut(text: str, raw: np.ndarray, doc_id: int | None, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> Cut:
    widths = unit_widths(raw)
    n = len(widths)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k: k + 8], 16) for k in (0, 8, 16, 24))
    if not n or h3 % 100 >= rate or any(m in text for m in MARKS):
        return Cut(n, "plain")
    units, low, high = SkipList(widths), *sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix = units.place(low)
    return Cut(n, "spm" if h4 % 100 < suffix_first else "psm", prefix, units.place(high) - prefix)


def arranged(text: str, c: Cut) -> str:
    if c.form == "plain":
        return text
    end = c.prefix + c.middle
    prefix, middle, suffix = text[: c.prefix], text[c.prefix: end], text[end:]
    if c.form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restored(output: str, form: str) -> str:
    """The text from its arranged form. Texts that hold a mark are never cut, so each mark is found once."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX)
    return prefix + middle + suffix


ADDED = "n long, form string, prefix_chars long, middle_chars long, fim_text string"


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """The columns of `docs` and n, form, prefix_chars, middle_chars, fim_text of every row; columns of these names are replaced.

    A null text is an empty one and stays plain. A null doc_id draws as an empty one. Rows with equal doc_id and text are cut alike.
    """
    added = ["n", "form", "prefix_chars", "middle_chars", "fim_text"]
    keep = [x for x in docs.columns if x not in (*added, "_text", "_id")]
    source = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), F.col("doc_id").cast("long").alias("_id"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 1 << 20):
            raw, starts = text_bytes(batch, "_text")
            cuts, outputs = [], []
            for k, (text, doc_id) in enumerate(zip(batch["_text"], batch["_id"].to_pylist(), strict=True)):
                text = text.as_py()
                cuts.append(cut(text, raw[starts[k]: starts[k + 1]], doc_id, seed, rate, suffix_first))
                outputs.append(arranged(text, cuts[-1]))
            columns = [batch.column(batch.schema.get_field_index(x)) for x in keep]
            columns += [pa.array([c.units for c in cuts], pa.int64()), pa.array([c.form for c in cuts], pa.string())]
            columns += [pa.array([c.prefix for c in cuts], pa.int64()), pa.array([c.middle for c in cuts], pa.int64()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *added])

    schema = source.select(*keep).schema
    for name, kind in (x.split() for x in ADDED.split(", ")):
        schema = schema.add(name, kind)
    return source.mapInArrow(build, schema)


def restore(transformed: DataFrame) -> DataFrame:
    """The columns of `transformed` and restored_text, from fim_text and form alone; null if either is null or the marks are not as written."""
    keep = [x for x in transformed.columns if x != "restored_text"]
    schema = transformed.select(*keep).schema.add("restored_text", "string")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for output, form in zip(batch["fim_text"], batch["form"].to_pylist(), strict=True):
                output = output.as_py()
                well = output is not None and form is not None and (form == "plain" or all(output.count(m) == 1 for m in MARKS))
                texts.append(restored(output, form) if well else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in keep), pa.array(texts, pa.string())], [*keep, "restored_text"])

    return transformed.select(*keep).mapInArrow(build, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    whole = restore(transform(docs.select("doc_id", "text")))
    return whole.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
                        F.sha2(F.col("restored_text").cast("binary"), 256).alias("restored_sha256"))


#: The same rows in DuckDB's SQL, with the units as a list.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
e AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(units) + 1) AS x, CAST('0x' || h[9:16] AS UBIGINT) % (len(units) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
f AS (
  SELECT *, coalesce(array_to_string(units[1:least(x, y)], ''), '') AS prefix, coalesce(array_to_string(units[least(x, y) + 1:greatest(x, y)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(x, y) + 1:n], ''), '') AS suffix
  FROM e)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""
