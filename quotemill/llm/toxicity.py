"""Toxicity by a counterfactually regularised classifier (operator 1).

Features are how often words, and words that begin with the same four to eight letters, occur in a thousand words of the text.
Those that tell the two labels apart best enter a logistic regression. For every labelled text with an identity term the
features of the same text with the term swapped for another of its group are made too, and the squared change of the score
between the two is added to the loss: a neutral mention of a group must not move the score.

Training takes at most TRAIN_ROWS labelled rows (those with the smallest hashes), so its size does not grow with the corpus;
every document is scored over its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

WORD = re.compile(r"[^\W\d_]+")
#: Neutral terms for groups of people; terms of one line stand in for each other.
IDENTITY = (
    "women men girls boys", "woman man", "muslim christian jewish hindu buddhist atheist", "muslims christians jews hindus buddhists atheists",
    "gay lesbian straight bisexual transgender", "black white asian latino arab", "immigrants refugees foreigners natives", "old young disabled deaf blind",
    "frauen männer", "muslime christen juden", "schwule lesben", "ausländer flüchtlinge", "femmes hommes", "musulmans chrétiens juifs", "immigrés étrangers",
    "mujeres hombres", "musulmanes cristianos judíos", "inmigrantes extranjeros",
)
SWAPS = {w: words[(i + 1) % len(words)] for words in map(str.split, IDENTITY) for i, w in enumerate(words)}
#: The bound of the training sample, of the features, and the evidence (share of variance times rows) a feature needs; of few rows, half the
#: variance is enough.
TRAIN_ROWS, FEATURES, EVIDENCE = 12_000, 1024, 14.0
PREFIXES = range(4, 9)
RIDGE, FAIRNESS, STEPS = 2e-4, 1.0, 400
#: Words remembered by a task with their features.
REMEMBERED = 200_000
#: Features whose sums a task holds before it hands them on; the sums of a feature meet again in the grouping.
GATHERED = 50_000


def held_out() -> Column:
    """Rows that no fit may see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _keys(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k)]


def _counts(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def _swapped(counts: Counter) -> Counter | None:
    """The words of the counterfactual text, or None if nobody is mentioned."""
    if not any(w in SWAPS for w in counts):
        return None
    out: Counter = Counter()
    for w, n in counts.items():
        out[SWAPS.get(w, w)] += n
    return out


def _rates(counts: Counter) -> dict[str, float]:
    total, seen = sum(counts.values()), Counter()
    for w, n in counts.items():
        for key in _keys(w):
            seen[key] += n
    return {k: math.log1p(1000 * n / total) for k, n in seen.items()}


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        places = {k: i for i, k in enumerate(self.weights)}
        weights, memory = np.array([*self.weights.values()]), {}

        def score(text: str) -> float:
            counts = _counts(text)
            seen: dict[int, int] = {}
            for w, n in counts.items():
                found = memory.get(w)
                if found is None:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    found = memory[w] = tuple(places[k] for k in _keys(w) if k in places)
                for i in found:
                    seen[i] = seen.get(i, 0) + n
            total = sum(counts.values())
            z = self.bias + sum(weights[i] * math.log1p(1000 * n / total) for i, n in sorted(seen.items()))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(toxic, text) of at most `rows` labelled documents outside the held-out fold. A document with several labels takes the largest."""
    one = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    few = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id").select("_toxic", "text")


def untold(clean: float, toxic: float) -> Model:
    """The model of labels that nothing tells apart: all texts score alike, by the share of label 1 but never as toxic."""
    return Model(min(math.log((toxic + 0.5) / (clean + 0.5)), math.log(0.49 / 0.51)))


def _sums(sums: dict[str, list[float]]) -> pa.RecordBatch:
    columns = [pa.array((row[i] for row in sums.values()), pa.float64(), size=len(sums)) for i in range(5)]
    return pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string(), size=len(sums)), *columns], ["key", "clean", "toxic", "v0", "v1", "vv"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES, fairness: float = FAIRNESS) -> Model:
    """Fit on the labelled rows. Without both labels, or if no feature tells them apart, see `untold`."""
    sample = training_rows(docs, labels, rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[float]] = {}
        for batch in batches:
            for toxic, text in zip(batch["_toxic"].to_pylist(), batch["text"], strict=True):
                sums.setdefault("", [0.0] * 5)[toxic] += 1
                for key, v in _rates(_counts(text.as_py() or "")).items():
                    row = sums.setdefault(key, [0.0] * 5)
                    row[toxic] += 1
                    row[2 + toxic] += v
                    row[4] += v * v
                if len(sums) >= GATHERED:
                    yield _sums(sums)
                    sums.clear()
        yield _sums(sums)

    from .common import staged

    sample = staged(sample, "toxicity-sample")
    sums = sample.mapInArrow(gather, "key string, clean double, toxic double, v0 double, v1 double, vv double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("clean", "toxic", "v0", "v1", "vv")])
    sums = staged(sums, "toxicity-features")
    counts = sums.filter("key = ''").select("clean", "toxic").first()
    n0, n1 = (counts["clean"], counts["toxic"]) if counts else (0.0, 0.0)
    n = n0 + n1
    if not n0 or not n1:
        return untold(n0, n1)
    mean = (F.col("v0") + F.col("v1")) / n
    gap = F.col("v1") / n1 - F.col("v0") / n0
    evidence = F.pow(gap, 2) * (n0 * n1 / n) / F.greatest(F.col("vv") / n - mean * mean, F.lit(1e-9))
    best = sums.filter("key <> '' AND clean + toxic >= 3").select("key", evidence.alias("evidence")).filter(F.col("evidence") >= min(EVIDENCE, n / 2))
    names = [r["key"] for r in best.orderBy(F.desc("evidence"), "key").limit(features).collect()]
    if not names:
        return untold(n0, n1)
    places = {k: i for i, k in enumerate(names)}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ids, values = [], [], []
            for toxic, text in zip(batch["_toxic"].to_pylist(), batch["text"], strict=True):
                own = _counts(text.as_py() or "")
                x = {places[k]: v for k, v in _rates(own).items() if k in places}
                kinds.append(toxic)
                ids.append([*x])
                values.append([*x.values()])
                if (other := _swapped(own)) is not None:  # the change of the features, as a row of kind 2
                    y = {places[k]: v for k, v in _rates(other).items() if k in places}
                    d = {k: x.get(k, 0.0) - y.get(k, 0.0) for k in {*x, *y}}
                    kinds.append(2)
                    ids.append([*d])
                    values.append([*d.values()])
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], ["kind", "ids", "vals"])

    fitted = sample.mapInArrow(rows_of, "kind int, ids array<int>, vals array<double>").orderBy("kind", "ids", "vals").toArrow()  # at most twice TRAIN_ROWS rows
    return fit(fitted["kind"].to_numpy(), fitted["ids"].to_pylist(), fitted["vals"].to_pylist(), names, fairness)


def fit(kind: np.ndarray, ids: list[list[int]], values: list[list[float]], names: list[str], fairness: float = FAIRNESS) -> Model:
    """Gradient descent with momentum on: log loss (both labels weigh by the root of their rarity) + ridge + fairness * change^2."""
    lengths = np.array([len(x) for x in ids])
    row, col = np.repeat(np.arange(len(ids)), lengths), np.array([i for x in ids for i in x], np.int64)
    val = np.array([v for x in values for v in x], float)
    scale = np.maximum(np.sqrt(np.bincount(col, val * val, len(names)) / max(1, len(ids))), 1e-6)
    val = val / scale[col]
    real, toxic = kind < 2, (kind == 1).astype(float)
    share = toxic[real].mean()
    importance = np.where(kind == 1, share**-0.5, (1 - share) ** -0.5) * real
    importance = importance / importance.sum()
    pairs = (kind == 2) / max(1, (kind == 2).sum())
    w, b, speed_w, speed_b = np.zeros(len(names)), math.log(share / (1 - share)), 0.0, 0.0
    norms = np.bincount(row, val * val, len(ids)) + 1
    rate = 1.0 / (0.25 * (importance * norms).sum() + 2 * fairness * (pairs * norms).sum() + RIDGE)
    rate = min(rate, 1.0)
    for step in range(STEPS):
        keep = step / (step + 3)
        aw, ab = w + keep * speed_w, b + keep * speed_b
        z = np.bincount(row, val * aw[col], len(ids))
        error = importance * (1 / (1 + np.exp(-np.clip(z + ab, -30, 30))) - toxic) * real
        pull = error + 2 * fairness * pairs * z
        grad = np.bincount(col, val * pull[row], len(names)) + RIDGE * aw
        new_w, new_b = aw - rate * grad, ab - rate * error.sum()
        speed_w, speed_b, w, b = new_w - w, new_b - b, new_w, new_b
    return Model(float(b), {k: float(x) for k, x in zip(names, w / scale, strict=True) if x})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs` and `toxic_score` (0 to 1). A null or empty text scores the model's bias."""
    schema = docs.drop("toxic_score").schema
    names = [f.name for f in schema.fields]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            scores = [of(t.as_py() or "") for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in names), pa.array(scores, pa.float64())], [*names, "toxic_score"])

    return docs.select(*names).mapInArrow(rate, schema.add("toxic_score", "double"))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row, repeated rows and null texts included."""
    rated = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return rated.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
