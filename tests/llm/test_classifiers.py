"""Held-out accuracy, and what a score may depend on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality, secrets, toxicity
from lakeloom.llm.labelled import labelled_sample

#: The smaller tables have too few rows of the rarer class in the held-out fold.
BIG, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.01"


def area(rows):
    """Of pairs with unlike labels, how many are in the right order."""
    ones, zeros = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("score,label,least", [(toxicity.toxicity_scores, "toxic", 0.98), (quality.quality_scores, "quality", 0.98)])
def test_held_out(spark, score, label, least):
    docs, labels = (spark.read.parquet(f"{BIG}/{n}.parquet") for n in ("documents", "labels"))
    out = score(docs, labels).join(labels, "doc_id").where("held_out").select("score", label, "predicted").collect()
    assert area([(r[0], r[1]) for r in out]) >= least
    assert sum(r[1] == r[2] for r in out) / len(out) >= 0.9


@pytest.mark.parametrize("score,label,least", [(toxicity.toxicity_scores, "toxic", 0.95), (quality.quality_scores, "quality", 0.85)])
def test_held_out_of_a_small_table(spark, score, label, least):
    """There are about ten texts of the rarer class in this fold, so the bound is wider: one of them misplaced costs up to 0.1."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    out = score(docs, labels).join(labels, "doc_id").where("held_out").select("score", label).collect()
    assert area([(r[0], r[1]) for r in out]) >= least


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{n}.parquet") for n in ("documents", "labels"))
    docs, labels = docs.where("doc_id < 300"), labels.where("doc_id < 300")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (labelled_sample(docs, x, "toxic", 100, 20_000) for x in (labels, turned))
    assert a.texts == b.texts and list(a.labels) == list(b.labels)


def test_forest_tells_secrets_from_look_alikes(spark):
    forest, held = secrets.train(secrets.made_findings()), secrets.made_findings(400, seed=99)
    import numpy as np

    scores = forest.scores(np.array([secrets.features(a, v, b, forest.language) for a, v, b, _ in held]))
    assert np.mean((scores >= secrets.THRESHOLD) == np.array([y for *_, y in held])) > 0.95


def test_masked_where_found(spark):
    key = "AKIA" + "Q7ZP3M2X9LK4T8WB"
    rows = [(1, f"set aws_access_key = {key} now", "en", "web", 0), (2, "commit 3f786850e387550fdab836ed7e6dc881de23001b fixes it", "en", "web", 0), (3, None, "en", "web", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r for r in secrets.without_secrets(docs).collect()}
    assert key not in out[1]["text"] and "[SECRET]" in out[1]["text"] and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == rows[1][1] and out[3]["text"] is None


def test_forest_on_findings_that_it_was_not_made_from(spark):
    """Candidates in the documents, where a quoted value after a name for a token is a secret and a bare number is none."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    forest = secrets.trained_on(docs)
    assert len(forest.language.words) > 1000
    right = {0: [0, 0], 1: [0, 0]}
    for (text,) in docs.select("text").where("text is not null").collect():
        for _, a, b, score in secrets.judged(text, forest):
            left, value = text[max(0, a - 9) : a], text[a:b]
            label = 1 if left.lower() == 'token = "' and len(value) == 40 else 0 if value.isdigit() else None
            if label is not None:
                right[label][0] += (score >= secrets.THRESHOLD) == bool(label)
                right[label][1] += 1
    assert all(n > 50 and ok / n > 0.95 for ok, n in right.values()), right


def test_labels_may_have_clashing_columns(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    labels = labels.select("*", F.lit("x").alias("DOC_ID"), F.lit("y").alias("TOXIC"), F.lit(0).alias("label"))
    assert len(labelled_sample(docs, labels, "toxic", 100, 20_000).texts) > 50
