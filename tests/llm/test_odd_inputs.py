"""Cases that an earlier round left out: clashing columns of the filters, short benchmark items, long numerals beside spelled digits."""

from __future__ import annotations

import pytest
from helpers import awkward, documents
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, pii, secrets, suffixes

PASSAGE = "the settlers of the northern valley brought their own seed and their own songs with them when they came over the pass in spring "


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id int, text string").selectExpr("cast(item_id as long) as item_id", "text")


@pytest.mark.parametrize("name", ["TEXT", "Doc_Id", "N_Chars"])
def test_filters_bear_names_that_differ_in_case_alone(spark, name):
    docs = awkward(spark).withColumn("other", F.lit("clash"))
    clash = docs.toDF(*[name if c == "other" else c for c in docs.columns])
    for keep in (secrets.without_secrets, suffixes.without_repeats, lambda d: decontaminate.without_benchmark(d, benchmark(spark, PASSAGE))):
        found = keep(clash)
        assert found.columns == clash.columns
        assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(repr(tuple(r)) for r in keep(docs).collect())


def test_filters_act_beside_such_columns(spark):
    repeated = " ".join(f"word{i}" for i in range(80))
    rows = [(1, f"{PASSAGE} and so on"), (2, f"one {repeated} end"), (3, f"two {repeated} last"), (4, 'password = "hG7kQ2vX9pLm4ZtRw8sB"')]
    docs = documents(spark, rows).select("*", F.lit("clash").alias("TEXT"))
    assert sorted(r["doc_id"] for r in decontaminate.without_benchmark(docs, benchmark(spark, PASSAGE)).collect()) == [2, 3, 4]
    cut = {r[0]: r[1] for r in suffixes.without_repeats(docs).collect()}
    assert cut[2] == rows[1][1] and "word40" not in cut[3]
    masked = {r[0]: r for r in secrets.without_secrets(docs).collect()}
    assert masked[1][1] == rows[0][1] and masked[4]["n_chars"] == len(masked[4][1])


def test_repeats_and_long_texts_with_benchmark_passages(spark):
    long = "filler words of no meaning " * 5000
    rows = [(1, PASSAGE), (1, PASSAGE), (None, f"x {PASSAGE} y"), (2, long + PASSAGE + long), (3, long)]
    found = decontaminate.contaminated(documents(spark, rows), benchmark(spark, PASSAGE)).collect()
    assert sorted(((r["doc_id"], r["start"]) for r in found), key=repr) == sorted([(1, 0), (1, 0), (None, 2), (2, len(long))], key=repr)


def test_short_items_stand_between_word_ends(spark):
    items = benchmark(spark, "What is 7 times 8?", "Paris", "is it so, or", "What is 7 times 8?")
    texts = ["He asked: what is 7 times 8? Nobody knew.", "What is 7 times 80?", "Whatis7times8", "somewhat is 7 times 8", "Paris is it so or not", "WHAT IS\n7 TIMES 8", "", None]
    found = decontaminate.contaminated(documents(spark, list(enumerate(texts))), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start"], r["end"], r["edits"]) for r in found) == [
        (0, 0, 10, 27, 0), (0, 3, 10, 27, 0), (2, 0, 0, 13, 0), (2, 3, 0, 13, 0), (4, 2, 6, 17, 0), (5, 0, 0, 17, 0), (5, 3, 0, 17, 0),
    ]
    kept = decontaminate.without_benchmark(documents(spark, list(enumerate(texts))), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7]


@pytest.mark.parametrize("text,kind", [
    ("call +44 two zero 7946 0958 now", "phone"),
    ("call +44 two zero 79460958 now", "phone"),
    ("card 41111111 1111 one one one one here", "card"),
    ("card 411111111111 one one one one here", "card"),
])
def test_numerals_of_any_length_beside_spelled_digits(spark, text, kind):
    found = pii.personal_data(documents(spark, [(1, text)])).first()
    assert found["spans"].startswith(f"{kind}:")


def test_a_long_numeral_is_no_identifier(spark):
    rows = [(1, "one " + "1234567890" * 30 + " two"), (2, "chapter one 1994 two hundred")]
    assert all(r["spans"] == "" for r in pii.personal_data(documents(spark, rows)).collect())
