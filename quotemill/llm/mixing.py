"""Mixing sources to target weights by Poisson replication (operator 7), in built-in expressions only.

A source's weight asks for a mean number of repetitions of each of its documents. Each document draws its own number: a hash
of its identity gives a uniform number, and the Poisson distribution with that mean is inverted at it. So every document is
decided alone, a run repeats exactly, and expected sizes meet the weights. The copies are shuffled globally by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: A mean above this is the sum of several draws (Poisson numbers add up), so that the table of probabilities stays short and exp() in range.
DRAW_MEAN, TABLE = 16.0, 80
#: Weights: a source's share of the characters to this power; the sum of all expected characters is EPOCHS times the input's.
POWER, EPOCHS, SEED = 0.7, 1.0, "mix-1"
WORKING = ("copy", "position_key", "_copies", "_source", "_draws", "_table", "_u")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def cumulative(mean: Column) -> Column:
    """The distribution function of a Poisson number at 0, 1, 2, ... as an array."""
    empty = F.array().cast("array<double>")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TABLE)), F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.concat(empty, F.array(F.exp(-mean))).alias("all")),
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), (a["sum"] + a["p"] * mean / k).alias("sum"), F.concat(a["all"], F.array(a["sum"] + a["p"] * mean / k)).alias("all")),
        lambda a: a["all"])


def rates(docs: DataFrame, power: float = POWER, epochs: float = EPOCHS, weights: dict[str, float] | None = None) -> DataFrame:
    """source, n_docs, n_units, target share and mean repetitions of a document.

    Units are characters, at least one a document. `weights` gives the shares asked for by name (others get none); without it
    they follow the sources' sizes to `power`. A null source is a source of its own.
    """
    size = F.greatest(F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)), F.lit(1)).cast("long")
    sums = docs.select("source", size.alias("units")).groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("units").alias("n_units"))
    sums = staged(sums, "source-sizes")
    if weights is None:
        wanted = F.pow(F.col("n_units").cast("double"), F.lit(power))
    else:
        wanted = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]), F.coalesce("source", F.lit(""))), F.lit(0.0))
    sums = sums.withColumn("weight", wanted)
    units, weight = sums.agg(F.sum("n_units"), F.sum("weight")).first()
    share = F.col("weight") / F.lit(float(weight)) if weight else F.lit(0.0)
    return sums.select("source", "n_docs", "n_units", share.alias("share"), (share * epochs * F.lit(units) / F.col("n_units")).alias("mean"))


def draws(docs: DataFrame, table: DataFrame, seed: str = SEED) -> DataFrame:
    """`docs` with the column `_copies`; documents of a source without a mean get none."""
    count = F.greatest(F.ceil(F.col("mean") / DRAW_MEAN), F.lit(1)).cast("int")
    means = table.select(F.col("source").alias("_source"), count.alias("_draws"), cumulative(F.col("mean") / count).alias("_table"))
    means = staged(means, "source-means")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    each = F.transform(F.sequence(F.lit(1), F.col("_draws")), lambda j: F.size(F.filter(F.col("_table"), lambda c: c < F.col("_u")[j - 1])))
    us = F.transform(F.sequence(F.lit(1), F.col("_draws")), lambda j: uniform(F.lit(seed), identity, j.cast("string")))
    numbered = docs.join(means, docs["source"].eqNullSafe(means["_source"])).withColumn("_u", us)
    return numbered.withColumn("_copies", F.aggregate(each, F.lit(0), lambda a, x: a + x)).drop("_source", "_draws", "_table", "_u")


def mix(docs: DataFrame, power: float = POWER, epochs: float = EPOCHS, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """Each document as many times as it drew, in one global random order: the columns of `docs`, `copy` and `position_key`.

    Needs doc_id, source and text; a null doc_id draws by the word "null", rows that repeat draw alike, an empty table stays
    empty. Columns of `docs` that have a name of WORKING are left out. Order the result by position_key to read it shuffled;
    the partitions are dealt by it and sorted by it already.
    """
    names = [c for c in docs.columns if c not in WORKING]
    drawn = draws(docs.select(*names), rates(docs, power, epochs, weights), seed)
    copies = drawn.filter("_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = copies.withColumn("position_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("place"), identity, F.col("copy").cast("string"))))
    return keyed.repartition("position_key").sortWithinPartitions("position_key").select(*names, "copy", "position_key")


ORACLE = f"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n_docs, sum(greatest(coalesce(length(text), 0), 1))::BIGINT AS n_units FROM documents GROUP BY source
), weighed AS (SELECT *, pow(n_units::DOUBLE, {POWER}) AS weight FROM sizes
), means AS (
  SELECT source, (weight / (SELECT sum(weight) FROM weighed)) * {EPOCHS} * (SELECT sum(n_units) FROM weighed)::BIGINT / n_units AS mean FROM weighed
), parts AS (SELECT source, greatest(ceil(mean / {DRAW_MEAN}), 1)::INT AS n, mean / greatest(ceil(mean / {DRAW_MEAN}), 1) AS m FROM means
), steps AS (
  SELECT source, m, 0 AS k, exp(-m) AS p, exp(-m) AS c FROM parts
  UNION ALL SELECT source, m, k + 1, p * m / (k + 1), c + p * m / (k + 1) FROM steps WHERE k < {TABLE}
), tables AS (SELECT source, list(c ORDER BY k) AS cs FROM steps GROUP BY source
), drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, list_sum([
    len(list_filter(t.cs, lambda c: c < (('0x' || substr(md5('{SEED}|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0))
    for j in range(1, p.n + 1)])::INT AS copies
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source JOIN tables t ON t.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5('{SEED}|place|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS position_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn WHERE copies > 0)
"""
