"""Small documents with everything that may go wrong in them."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, row string"


def documents(spark, rows):
    """Documents from ``(doc_id, text, lang, source)``, with columns whose names clash with ours."""
    full = [(*r, None if r[1] is None else len(r[1]), 7, "x") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def odd(spark):
    long_text = " ".join(f"word{i % 997} and{i % 31}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t\n", None, None),
        (4, "one two three four five six seven\none two three four five six seven", "en", None),
        (4, "one two three four five six seven\none two three four five six seven", "en", None),
        (5, long_text, "en", "b"),
        (None, "no id here at all, but five words", "en", "a"),
        (6, "é ü ñ 中文 🙂   x" * 3, "fr", "b"),
        (7, "12 34 -- !!", None, "c"),
    ]
    return documents(spark, rows)


def empty(spark):
    return spark.createDataFrame([], DOCS)
