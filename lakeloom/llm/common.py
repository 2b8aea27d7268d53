"""What the training-data operators share: shared-folder tables, word hashes, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed: runs of anything but ASCII white space are words.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a one-machine master."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """While it lasts, what goes to Python at once is about ``n_bytes``, or one row: for rows of megabytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, n_bytes)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`written` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for t in tables for f in t.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, also where the input holds others whose names differ in case alone."""
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.select(*[F.col(f"c{df.columns.index(c)}").alias(c) for c in columns])


def replaced(df: DataFrame, name: str, value: Callable[[Column], Column]) -> DataFrame:
    """``df`` with another value for one column, also where others' names differ from it in case alone."""
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = f"c{df.columns.index(name)}"
    return by_place.withColumn(at, value(F.col(at))).toDF(*df.columns)


def kept_by(df: DataFrame, name: str, test: Callable[[Column], Column]) -> DataFrame:
    """The rows of ``df`` that meet a test of one column, also where others' names differ from it in case alone."""
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.where(test(F.col(f"c{df.columns.index(name)}"))).toDF(*df.columns)


class WordHashes(dict):
    """A bounded cache of 64-bit word hashes."""

    limit = 1 << 20

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words; bytes.split() cuts at exactly the white space that WORD excludes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes_of(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(hashes: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """A hash for each run of k words; for fewer words than k, one hash of them all."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < k:
        k = n
    out = np.full(n - k + 1, k, np.uint64)
    for j, m in enumerate(odd_numbers(k, seed)):
        out += mix(hashes[j : n - k + 1 + j] + np.uint64(j)) * m
    return mix(out)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for each id of ``edges`` (a, b): the smallest id reachable.

    Labels move to neighbours and through pointer jumps until none changes. Each round is a
    written table, so a lost executor costs one round at most; hubs are joined, never gathered.
    """
    spark = edges.sparkSession
    both = written(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(edges.select("b", "a"))
        .where("src <> dst")
        .distinct(),
        f"{name}-edges",
    )
    labels = written(
        both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("id"), F.least("src", "m").alias("component")),
        f"{name}-0",
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("dst"), "component"), "dst")
            .groupBy(F.col("src").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        moved = written(
            labels.join(near, "id")
            .select("id", F.col("component").alias("was"), F.least("component", "near").alias("next"))
            .join(jump, "next")
            .select("id", F.least("next", "far").alias("component"), "was"),
            f"{name}-round",
        )
        remove(spark, labels)
        labels = moved.select("id", "component")
        if moved.where("component <> was").isEmpty():
            remove(spark, both)
            return labels
