"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The presence of an n-gram (4 to 7 characters of the lower-cased text) counts as its log-count
ratio between toxic and other texts; a logistic regression on these values is fitted to a
bounded labelled sample and scores every whole text in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick
from .labelled import Sample, is_held_out, labelled_sample

BITS = 20
LENGTHS = (4, 5, 6, 7)
FEATURES = 2000
#: The fit takes this many rows of each class at most, of texts up to so many characters.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000
THRESHOLD = 0.5


def buckets(text: str) -> list[np.ndarray]:
    """For each n-gram length, the hash buckets of all n-grams of a whole text."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], codes
    for n in range(2, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n in LENGTHS:
            out.append((h * np.uint32(2654435769 + 2 * n)) >> np.uint32(32 - BITS))
    return out


@dataclass
class Toxicity:
    """``place`` maps a bucket to a feature (0: none), ``weights`` has their summed effect."""

    place: np.ndarray
    weights: np.ndarray
    bias: float

    def features(self, text: str | None) -> np.ndarray:
        found = [self.place[b] for b in buckets(text or "")]
        found = np.concatenate(found) if found else np.empty(0, np.uint16)
        return np.unique(found[found > 0])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[self.features(text)].sum()))))


def fit(sample: Sample, features: int = FEATURES, alpha: float = 0.5, l2: float = 1.0, rounds: int = 200) -> Toxicity:
    """Naive Bayes ratios, then logistic regression by gradient steps with Adam.

    A sample without both classes gives a model that scores every text 0.
    """
    place = np.zeros(1 << BITS, np.uint16)
    if not sample.usable:
        return Toxicity(place, np.zeros(1), -50.0)
    y, n = sample.labels, len(sample.labels)
    # n-grams are made twice, for the counts and for the features, rather than kept for all texts
    present = lambda t: np.unique(np.concatenate(b)) if (b := buckets(t)) else np.empty(0, np.uint32)
    p, q = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for t, label in zip(sample.texts, y, strict=True):
        (p if label else q)[present(t)] += 1
    positives = y.sum()
    ratio = np.log((p + alpha) / (positives + 2 * alpha)) - np.log((q + alpha) / (n - positives + 2 * alpha))
    strength = np.where(p + q >= 3, np.abs(ratio) / np.sqrt(1 / (p + alpha) + 1 / (q + alpha)), 0)
    best = np.sort(np.argsort(-strength, kind="stable")[:features])
    best = best[strength[best] > 0]
    place[best] = np.arange(1, len(best) + 1)
    x = np.zeros((n, len(best) + 1), np.float32)
    for i, t in enumerate(sample.texts):
        x[i, place[present(t)]] = 1
    x[:, 0] = 0
    scale = np.concatenate([[0], ratio[best]]).astype(np.float32)
    x *= scale
    y = y.astype(np.float32)
    weight = np.where(y == 1, sample.prior / positives, (1 - sample.prior) / (n - positives)).astype(np.float32)
    w, bias = np.full(x.shape[1], 0.01, np.float32), float(np.log(sample.prior / (1 - sample.prior)))
    m = v = np.zeros(x.shape[1] + 1, np.float32)
    for step in range(1, rounds + 1):
        error = (1 / (1 + np.exp(-(x @ w + np.float32(bias)))) - y) * weight
        grad = np.append(x.T @ error + l2 / n * w, error.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    return Toxicity(place, (w * scale).astype(np.float64), bias)


def scored(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs`` with ``toxicity``: 0 to 1, over whole texts; a null text counts as empty."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([held.value.score(t) for t in texts], dtype="float64")

    return docs.withColumn("toxicity", toxicity("text"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text, ...).

    ``labels`` (doc_id, toxic) serves for the fit alone, outside the held-out fold. Null and empty
    texts get the bias alone, repeated rows their own equal rows, an empty table none. Texts of any length are scored
    whole. Without labels of both classes every text gets a score near 0.
    """
    model = fit(labelled_sample(docs, labels, "toxic", SAMPLE_ROWS, SAMPLE_CHARS))
    return scored(pick(docs, "doc_id", "text"), model).select(
        "doc_id",
        is_held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
