"""Quality: random-indexing word vectors pooled per document, then a two-layer network.

Each word has a sparse random index vector made from its hash. A word's context vector is the sum
of the index vectors of its neighbours over the sample that the classifier is fitted to; rare
and unseen words share the context of their shape (case, digits, punctuation). A document is pooled
to the mean of its words' vectors, their spread about it in each dimension, the mean's length and
the share of words that repeat the one before: monotonous text has a long mean and little spread. A two-layer numpy network, whose probabilities are calibrated by a
temperature fitted to sample rows that it was not trained on, scores every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick
from .labelled import Sample, is_held_out, labelled_sample

DIMENSIONS, NONZERO, WINDOW, HIDDEN = 128, 8, 2, 32
POOLED = 2 * DIMENSIONS + 2
#: A word with fewer occurrences in the sample goes by its shape.
LEAST = 3
#: Least deviation that a pooled dimension is divided by, and the weight of the numbers on the whole text beside it.
STD_FLOOR, WHOLE_WEIGHT = 0.03, 4
SAMPLE_ROWS, SAMPLE_CHARS = 2500, 20_000
THRESHOLD = 0.3

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text) if text else []


def shape(token: str) -> str:
    """What an unseen word is known by."""
    if token.isdigit():
        return "\x000"
    if not token.isalpha():
        return f"\x00{token[:3]}"
    size = "s" if len(token) < 4 else "m" if len(token) < 9 else "l"
    return f"\x00{'A' if token.isupper() and len(token) > 1 else 'a' if token.islower() else 'Aa'}{size}"


def index_vector(token: str) -> np.ndarray:
    rng = np.random.default_rng(xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")))
    out = np.zeros(DIMENSIONS, np.float32)
    out[rng.choice(DIMENSIONS, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


@dataclass
class Quality:
    """``rows`` maps words and shapes to rows of ``vectors``; row 0 is for unknown shapes."""

    rows: dict[str, int]
    vectors: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    bias: float

    def ids(self, text: str | None) -> np.ndarray:
        get, rows = self.rows.get, self.rows
        return np.array([i if (i := get(t)) is not None else rows.get(shape(t), 0) for t in tokens(text)], np.int64)

    def pooled(self, text: str | None) -> np.ndarray:
        """Mean, spread, length of the mean and share of repeats; zeros for a text without words."""
        ids = self.ids(text)
        if not len(ids):
            return np.zeros(POOLED, np.float32)
        at, n = np.unique(ids, return_counts=True)
        share, rows = (n / len(ids)).astype(np.float32), self.vectors[at]
        mean = share @ rows
        spread = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
        return np.concatenate([mean, spread, [np.linalg.norm(mean), np.mean(ids[1:] == ids[:-1]) if len(ids) > 1 else 0]], dtype=np.float32)

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(_forward(self.layers, pooled)[1] / self.temperature + self.bias)))


def _forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean, std, w1, b1, w2, b2 = layers
    hidden = np.tanh((x - mean) / std @ w1 + b1)
    return hidden, hidden @ w2 + b2[0]


def _vectors(texts: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Context vectors of the sample's words and shapes, of unit length.

    Texts are cut into words twice rather than all kept as words, and neighbours are counted gap by gap: the driver holds little.
    """
    seen = Counter(t for text in texts for t in tokens(text))
    named = {t: t if n >= LEAST else shape(t) for t, n in seen.items()}
    rows = {t: i for i, t in enumerate(sorted(set(named.values()) | {shape(t) for t in seen}), 1)}
    place = {t: rows[name] for t, name in named.items()}
    del seen, named
    index = np.stack([np.zeros(DIMENSIONS, np.float32), *map(index_vector, rows)])
    # the words of all texts, with as many gaps (-1) after each as a window is wide
    every = np.concatenate([np.array([*map(place.__getitem__, tokens(t)), *[-1] * WINDOW], np.int32) for t in texts])
    context = index.copy()
    for gap in range(1, WINDOW + 1):
        for a, b in ((every[gap:], every[:-gap]), (every[:-gap], every[gap:])):
            both = (a >= 0) & (b >= 0)
            met, times = np.unique(a[both].astype(np.int64) * len(index) + b[both], return_counts=True)
            for i in range(0, len(met), 1 << 15):
                word, near = np.divmod(met[i : i + (1 << 15)], len(index))
                first = np.flatnonzero(np.diff(word, prepend=-1))
                context[word[first]] += np.add.reduceat(index[near] * times[i : i + (1 << 15), None].astype(np.float32), first)
    # a word's own index keeps it apart from others in the same company
    context = context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-6) + 0.5 * index / np.sqrt(NONZERO)
    return rows, (context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def fit(sample: Sample, epochs: int = 30, rate: float = 0.005, decay: float = 8.0, seed: int = 3) -> Quality:
    """Fit to the sample; one without both classes gives a model that scores every text alike.

    ``decay`` is the weights' penalty beside that of all rows together, so it fades as the sample grows.
    """
    if not sample.usable:
        layers = [np.zeros(POOLED), np.ones(POOLED), np.zeros((POOLED, 1)), np.zeros(1), np.zeros(1), np.zeros(1)]
        return Quality({}, np.zeros((1, DIMENSIONS), np.float32), layers, 1.0, 0.0)
    rows, vectors = _vectors(sample.texts)
    model = Quality(rows, vectors, [], 1.0, 0.0)
    x, y = np.stack([model.pooled(t) for t in sample.texts]), sample.labels
    rng = np.random.default_rng(seed)
    aside = rng.random(len(y)) < 0.2
    share = y[~aside].mean()
    weight = np.where(y == 1, sample.prior / max(y.mean(), 1e-9), (1 - sample.prior) / max(1 - y.mean(), 1e-9))
    # the floor keeps directions that hardly vary from being blown up; the two numbers on the whole text weigh more than one of many dimensions
    mean, std = x[~aside].mean(0), x[~aside].std(0) + STD_FLOOR
    std[-2:] /= WHOLE_WEIGHT
    w1 = rng.normal(0, 1 / np.sqrt(POOLED), (POOLED, HIDDEN))
    params = [w1, np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array([np.log((share + 1e-3) / (1 - share + 1e-3))])]
    m, v, step, l2 = [0 * p for p in params], [0 * p for p in params], 0, decay / len(y)
    train = np.flatnonzero(~aside)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
            step += 1
            xs = (x[part] - mean) / std
            hidden, logit = _forward([mean, std, *params], x[part])
            error = (1 / (1 + np.exp(-logit)) - y[part]) / len(part)
            back = np.outer(error, params[2]) * (1 - hidden**2)
            grads = [xs.T @ back + l2 * params[0], back.sum(0), hidden.T @ error + l2 * params[2], np.array([error.sum()])]
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    model.layers = [mean, std, *params]
    # temperature: the best of a grid on the rows set aside; the bias restores the prior of all labelled rows
    held = aside if 0 < y[aside].sum() < aside.sum() else ~aside
    logit = _forward(model.layers, x[held])[1]
    shift = np.log(sample.prior / (1 - sample.prior)) - np.log(share / (1 - share))
    target, part = y[held], weight[held]

    def loss(temperature: float, bias: float) -> float:
        z = logit / temperature + bias
        return float((part * (np.logaddexp(0, z) - target * z)).sum())

    grid = [(loss(t, b), t, b) for t in np.geomspace(0.5, 8, 25) for b in shift + np.linspace(-2, 2, 17)]
    _, model.temperature, model.bias = min(grid)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text, ...).

    ``labels`` (doc_id, quality) serves for the fit alone, outside the held-out fold. Null, empty
    and wordless texts are pooled to zeros; repeated rows get equal rows, an empty table none. Texts of any length
    are scored whole. Without labels of both classes every text gets the score 0.5.
    """
    model = fit(labelled_sample(docs, labels, "quality", SAMPLE_ROWS, SAMPLE_CHARS))
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            pooled = [held.value.pooled(t) for t in texts]
            yield pd.Series(held.value.scores(np.stack(pooled)) if pooled else [], dtype="float64")

    return (
        pick(docs, "doc_id", "text")
        .withColumn("score", quality("text"))
        .select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )
