"""Small document tables with the cases every operator must stand: nulls, empty and long texts, copies, repeated rows, odd columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))
BASE = " ".join(f"term{i}" for i in range(400))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", None, 3), (5, "Ünï çødé 漢字 😀 text", "de", "b", 20),
    (6, LONG, "en", "a", len(LONG)), (7, BASE, "en", "a", len(BASE)), (8, BASE, "en", "a", len(BASE)), (9, BASE.replace("term17 ", "changed "), "en", "b", len(BASE)),
    (10, "the same row", "en", "a", 12), (10, "the same row", "en", "a", 12), (None, "no id here", "en", "a", 10), (11, "x" * 1000, "fr", "c", 1000),
]


def documents(spark, rows=ODD):
    return spark.createDataFrame([(*r,) for r in rows], SCHEMA).repartition(3)


def clashing(docs):
    """The same documents with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("key", "node", "score", "labels", "component", "_raw", "_key", "_known", "_u", "copy", "position_key", "_copies", "n", "word", "cell", "spans", "toxic", "rank")
    return docs.withColumns({x: F.lit("own") for x in names})
