"""Documents with the cases that every operator must bear, and plain versions to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, other scripts, unpaired marks."""
    rows = [
        (1, None, None, None, None),
        (None, "a text without an id that goes on for some words", "en", "web", 5),
        (2, "", "en", "", 0),
        (3, " \t\n ", "en", "web", 4),
        (4, "word " * 40_000, "en", "web", 200_000),
        (5, "x" * 100_000, "en", None, 100_000),
        (6, "same words here again " * 5, "en", "web", 100),
        (6, "same words here again " * 5, "en", "web", 100),
        (7, "日本語のテキスト、句読点。𝔘𝔫𝔦𝔠𝔬𝔡𝔢 é́    end", "ja", "web", 30),
        (8, "a", "en", "web", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    """Other columns, among them names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["id", "key", "size", "order", "slot", "place", "row", "at", "gram", "component", "score", "toxicity", "held_out", "TEXT", "start", "edits"]
    return df.select("*", *[F.lit("clash").alias(n) for n in names])


def prose(rnd: random.Random, n: int, words: int = 400) -> list[str]:
    return [f"w{rnd.randrange(words)}" for _ in range(n)]
