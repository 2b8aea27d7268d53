"""A training corpus from raw documents: reject, deduplicate, decontaminate, redact, mix.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame, which is written as Parquet and read again for the next. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, mixing, neardup, secrets, toxicity
from lakeloom.llm.common import pick, written
from lakeloom.llm.labelled import labelled_sample

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity is at the threshold or above; the model learns from labelled rows of ``docs``.

    Null and empty texts stay, rows alike share their fate; without labels of both classes everything stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", toxicity.SAMPLE_ROWS, toxicity.SAMPLE_CHARS))
    return toxicity.scored(pick(docs, *COLUMNS), model).where(F.col("toxicity") < toxicity.THRESHOLD).drop("toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    Of rows that share both id and text one stays, with the least of the other columns; rows with the same id and other
    texts stay or go together. Rows without an id, and null, empty and wordless texts, stay.
    """
    docs = pick(docs, *COLUMNS)
    gone = written(neardup.near_duplicates(docs).where("not kept").select("doc_id"), "gone")
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = written(again, "again")
    if again.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    once = docs.join(gone.union(again), "doc_id", "left_anti").select(*COLUMNS)
    repeated = docs.join(again.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    folded = repeated.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("least")).select("doc_id", "text", "least.*")
    return once.unionByName(folded).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a part of a benchmark item; null and empty texts stay, rows alike share their fate."""
    return decontaminate.without_benchmark(pick(docs, *COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and their lengths counted anew; null and empty texts stay as they are."""
    return secrets.without_secrets(pick(docs, *COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: (doc_id, size, source_size, target, taken), a row for each row."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: The stages learn from samples and compare by edit distance, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over ``documents``; each one's result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
