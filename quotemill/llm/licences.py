"""Licence scans with a positional rare-token index (operator 8).

The templates' words form a small index: word -> (template, position). A stretch may differ from its template in a fixed share
of the words only, so of any larger number of positions one stands in place: each template is looked up at so many of its rarest
positions (highest inverse document frequency, counted over all documents), which misses no stretch, whatever else a file holds.
A posting votes for the place where its template would have to start. These places are compared word by word with the template,
and a label holds only if every mandatory phrase of the template stands inside that stretch.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Label, a stretch of the licence's notice, phrases that must stand in it.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the license", ("compliance with the license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that", ("source and binary forms",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution", "4 0")),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", ("with or without fee",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("free of charge", "this software")),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("public domain",)),
)
#: The share of a template's words that must stand in place.
LEAST_SHARE = 0.6


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER))


class Index:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates = [(label, words.split(), [p.split() for p in must]) for label, words, must in templates]
        self.phrases = [(p.split(), label) for p, label in phrases]
        self.first = {p[0] for p, _ in self.phrases}
        self.postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, words, _) in enumerate(self.templates):
            for i, w in enumerate(words):
                self.postings[w].append((t, i))
        #: Words without which a template's mandatory phrases cannot stand in a file.
        self.needed = [frozenset(w for p in must for w in p) for _, _, must in self.templates]
        self.vocabulary = frozenset(self.postings).union(*self.needed)

    def lookups(self, idf: dict[str, float]) -> list[list[tuple[str, int]]]:
        """(word, position) of each template's rarest positions: one more than a stretch may differ in."""
        out = []
        for _, words, _ in self.templates:
            least = next(k for k in range(len(words) + 1) if k / len(words) >= LEAST_SHARE)
            at = sorted(range(len(words)), key=lambda i: (-idf[words[i]], words[i], i))
            out.append([(words[i], i) for i in at[: len(words) - least + 1]])
        return out

    def base(self, words: list[str], present: set[str]) -> list[tuple[int, str]]:
        if not present & self.first:
            return []
        return [(i, label) for i, w in enumerate(words) if w in self.first for p, label in self.phrases if words[i: i + len(p)] == p]

    def scan(self, words: list[str], present: set[str], lookups: list[list[tuple[str, int]]]) -> list[tuple[str, float, int]]:
        """(label, share of words in place, start) of each verified stretch."""
        rare: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for t, needed in enumerate(self.needed):
            if needed <= present:
                for w, p in lookups[t]:
                    rare[w].append((t, p))
        if present.isdisjoint(rare):
            return []
        votes = {(t, i - p) for i, w in enumerate(words) if w in rare for t, p in rare[w]}
        out = []
        for t, start in votes:
            label, pattern, must = self.templates[t]
            if start < 0:
                continue
            stretch = words[start: start + len(pattern)]
            share = sum(a == b for a, b in zip(stretch, pattern, strict=False)) / len(pattern)
            if share >= LEAST_SHARE and all(any(stretch[k: k + len(p)] == p for k in range(len(stretch))) for p in must):
                out.append((label, share, start))
        return out


def word_weights(docs: DataFrame, index: Index) -> dict[str, float]:
    """Inverse document frequencies of the templates' words over all documents; as many entries as the templates have words."""
    vocabulary = index.vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, Counter()
        for batch in batches:
            for text in batch["text"]:
                n += 1
                seen.update(vocabulary.intersection(words_of(text.as_py() or "")))
        yield pa.RecordBatch.from_pydict({"word": ["", *seen], "n": [n, *seen.values()]}, pa.schema([("word", pa.string()), ("n", pa.int64())]))

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r["word"]: r["n"] for r in rows}
    return {w: math.log((1 + n.get("", 0)) / (1 + n.get(w, 0))) + 0.01 for w in vocabulary}


def scan(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    A null text has no words: zero counts, null places of words, empty labels, score 0. Rows that repeat are scanned alike.
    `places` lists label:start of the verified stretches; score is the best share of a template's words in place.
    """
    index = index or Index()
    lookups = index.lookups(word_weights(docs, index))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<string>"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch["text"]:
                words = words_of(text.as_py() or "")
                present = index.vocabulary.intersection(words)
                present |= index.first.intersection(words)
                base, found = index.base(words, present), index.scan(words, present, lookups)
                labels = {x for _, x in base}
                places = sorted({(start, label) for label, _, start in found})
                out.append((len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)),
                            ",".join(sorted(labels | {x[0] for x in found})), max([0.0, *(x[1] for x in found)]), [f"{b}:{a}" for a, b in places]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(look, schema)
