"""Small documents for the tests: texts of invented words, and rows that are awkward on purpose."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "the and tion ing er st wh ou".split(), "de": "ein sch ung keit ver zu ich ge".split()}


def text(seed, words=80, lang="en"):
    rng = random.Random(f"{seed}{lang}")
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def row(n, body, lang="en", source="s"):
    return (n, body, lang, source, None if body is None else len(body))


def awkward():
    """Nulls, blank and very long texts, repeated rows, a shared and a missing identifier."""
    return [
        row(1, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, text(4, 30_000)),
        row(5, text(5)),
        row(5, text(5)),
        row(None, text(6), None, None),
        row(None, None, None, None),
        row(7, text(7), None),
        row(8, "é" * 5000),
        row(9, "one"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def clashing(frame):
    """The same rows with columns named like those the operators add or use."""
    names = ("score", "kept", "shard", "slot", "size", "_text", "_order", "_id", "tokens", "rate", "copies", "label")
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit("other") for n in names})
