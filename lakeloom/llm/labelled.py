"""Bounded labelled samples and the held-out fold that the classifiers share."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick


def is_held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is held out, as no label can name it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass
class Sample:
    """Labelled texts of both classes; ``prior`` is the share of label 1 among all labelled rows."""

    texts: list[str]
    labels: np.ndarray
    prior: float

    @property
    def usable(self) -> bool:
        return 0 < self.labels.sum() < len(self.labels)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, max_chars: int, seed: int = 17) -> Sample:
    """At most ``limit`` rows of each class outside the held-out fold, by seeded hash of the id.

    The bound is on what the model is fitted to; the prior is counted over all labelled rows.
    Only texts of at most ``max_chars`` characters serve for fitting, so what reaches the driver
    is bounded. A doc_id labelled twice counts once, with its larger label. Labels without doc_id, null labels and those
    other than 0 and 1 count as none; extra columns of either table don't matter, and without rows the sample is empty.
    """
    known = (
        pick(labels, "doc_id", label)
        .select("doc_id", F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = pick(docs, "doc_id", "text").where(F.length("text").between(1, max_chars))
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(2 * limit).collect()
    found = {}
    for r in rows:
        found.setdefault(r["text"], r["label"])
    total = sum(counts.values())
    return Sample(list(found), np.array(list(found.values()), np.float64), counts.get(1, 0) / total if total else 0.0)
