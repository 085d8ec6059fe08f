"""Quality rules by distribution divergence (operator 4), in built-in expressions only.

Each document's histogram of character classes and of common words is compared with the histogram of all documents of its
language by the Jensen-Shannon distance (base 2, so 0 to 1). Short texts have ragged histograms: below a length guard a
distance is not judged. Base measures come with it: words, symbols, repeated lines and repeated eight-word windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BLANKS = r"[\x20\x09-\x0D]+"
#: Frequent words of four languages.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "that",
    "der", "die", "und", "den", "von", "zu",
    "le", "la", "les", "et", "des", "est",
    "el", "de", "y", "los", "que", "por",
)
#: Distances beyond these fail; a distance counts only for texts of so many characters or words at least.
CHAR_LIMIT, WORD_LIMIT, LEAST_CHARS, LEAST_WORDS = 0.2, 0.3, 400, 100
SPAN = 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once, though lambdas inside use it for each element."""
    return F.transform(F.array(value), body)[0]


def _paired(step: int):
    """Names of spans twice as long from the names of two spans that stand `step` words apart."""
    def pair(names: Column) -> Column:
        n = F.greatest(F.size(names) - step, F.lit(0))
        return F.zip_with(F.slice(names, 1, n), F.slice(names, step + 1, n), lambda x, y: F.xxhash64(x, y))

    return pair


def repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur more than once, from the hashes of all windows in order."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _bound(placed, lambda s: F.array_sort(F.transform(
        F.filter(s, lambda p, k: F.coalesce(F.get(s, k - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == p["h"], F.lit(False))),
        lambda p: p["i"])))
    covered = F.aggregate(
        twice, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + SPAN).alias("end"), (a["n"] + i + SPAN - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(0).cast("long")


def _kept_chars(text: Column, other: str) -> Column:
    return F.length(F.regexp_replace(text, other, ""))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base measures, and both histograms as arrays of counts."""
    base = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("words", words_of(F.col("text")))
    text, words = F.col("text"), F.col("words")
    windows = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        windows = _bound(windows, _paired(step))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    common = F.filter(words, lambda w: w.isin(*COMMON_WORDS))
    base = base.select(
        "doc_id", "lang", F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _kept_chars(text, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        _kept_chars(text, r"[^0-9]+").cast("long").alias("n_digits"), _kept_chars(text, r"[^\p{Lu}]+").cast("long").alias("n_capitals"),
        F.length(text).cast("long").alias("n_chars"), F.octet_length(text).cast("long").alias("n_bytes"),
        windows.alias("windows"), lines.alias("lines"),
        F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")).alias("common"), F.size(common).cast("long").alias("n_common"))
    counts = [((F.length("common") - F.length(F.replace(F.col("common"), F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long") for w in COMMON_WORDS]
    blanks, more = F.col("n_chars") - F.col("word_chars"), F.col("n_bytes") - F.col("n_chars")
    rest = F.greatest(F.col("word_chars") - F.col("n_symbols") - F.col("n_digits") - F.col("n_capitals") - more, F.lit(0))
    return base.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("windows")).alias("n_repeat_words"),
        "n_chars", F.array(blanks, "n_symbols", "n_digits", "n_capitals", more, rest).alias("chars"),
        F.array(*counts, F.col("n_words") - F.col("n_common")).alias("commons"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _shares(counts: Column) -> Column:
    return _bound(counts, lambda c: _bound(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))))


def js_distance(left: Column, right: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two lists of shares; 0 when either sums to 0."""
    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    total = F.aggregate(F.zip_with(left, right, lambda p, q: term(p, q) + term(q, p)), F.lit(0.0), lambda a, x: a + x)
    empty = (F.aggregate(left, F.lit(0.0), lambda a, x: a + x) == 0) | (F.aggregate(right, F.lit(0.0), lambda a, x: a + x) == 0)
    return F.when(empty, 0.0).otherwise(F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def quality(docs: DataFrame, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, least_chars: int = LEAST_CHARS, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: the base measures, char_distance, word_distance and the verdict `kept`.

    A null text has no words and fails the base rules; a null language is a language of its own. Rows that repeat are judged
    alike, row by row. The references are sums over all documents that pass the base rules.
    """
    rows = staged(measures(docs), "measures")
    n_chars, n_commons = 6, len(COMMON_WORDS) + 1
    sums = rows.filter(~base_failed()).groupBy("lang").agg(
        *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(n_chars)], *[F.sum(F.col("commons")[i]).alias(f"w{i}") for i in range(n_commons)])
    references = staged(sums.select(
        "lang", _shares(F.array(*[f"c{i}" for i in range(n_chars)])).alias("ref_chars"), _shares(F.array(*[f"w{i}" for i in range(n_commons)])).alias("ref_commons")), "references")
    judged = rows.join(references, "lang", "left").withColumns({
        "char_distance": F.coalesce(js_distance(_shares(F.col("chars")), F.col("ref_chars")), F.lit(0.0)),
        "word_distance": F.coalesce(js_distance(_shares(F.col("commons")), F.col("ref_commons")), F.lit(0.0)),
        "base_failed": base_failed()})
    fits = ((F.col("n_chars") < least_chars) | (F.col("char_distance") <= char_limit)) & ((F.col("n_words") < least_words) | (F.col("word_distance") <= word_limit))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & fits).alias("kept"),
        "char_distance", "word_distance")
