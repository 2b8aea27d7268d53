"""What has been seen by earlier runs: a store of 128-bit digests in hash buckets, each behind a Bloom filter.

A run's rows ask the filters first, of which there is a small one for each bucket and run. Rows that no filter knows are new without the store being
read. Digests of the others are looked up in their buckets, and only in buckets that some row asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import null_safe_digest
from .stores import scratch
from .versioned import VersionedTable

#: Buckets of the store; a filter takes BITS for each digest and sets HASHES of them, so that about one new row in a thousand is looked up.
BUCKETS, BITS, HASHES = 256, 16, 8

_DIGEST = "bucket int, hi long, lo long"

#: Types whose values differ if and only if their texts do.
_PLAIN = {"string", "bigint", "int", "smallint", "tinyint", "boolean", "date"}


def digested(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``__bucket``, ``__hi`` and ``__lo`` of its columns' digest; null and the empty text differ, missing columns are an error."""
    text = null_safe_digest(*columns)
    part = lambda at: F.conv(F.substring(text, at, 16), 16, -10).cast("long")
    return df.withColumn("__hi", part(1)).withColumn("__lo", part(17)).withColumn("__bucket", F.pmod("__hi", F.lit(buckets)).cast("int"))


def _places(hi: np.ndarray, lo: np.ndarray, n: int) -> np.ndarray:
    """The bits of a filter of ``n`` bits that each digest sets, by two hashes and their sums."""
    steps = np.arange(HASHES, dtype=np.uint64)[None, :]
    with np.errstate(over="ignore"):
        return (hi.view(np.uint64)[:, None] // np.uint64(BUCKETS) + steps * (lo.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(n)


def _filters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, n, bits) of digests that come sorted by bucket."""

    def made(bucket: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        hi, lo = (np.concatenate([p[c].to_numpy(np.int64) for p in parts]) for c in ("hi", "lo"))
        n = max(64, 8 * -(-len(hi) * BITS // 8))
        bits = np.zeros(n, np.uint8)
        bits[_places(hi, lo, n).ravel()] = 1
        return pd.DataFrame({"bucket": [bucket], "n": [n], "bits": [np.packbits(bits).tobytes()]})

    now, held = None, []
    for batch in batches:
        for bucket, part in batch.groupby("bucket", sort=False):
            if bucket != now and held:
                yield made(now, held)
                held = []
            now = bucket
            held.append(part)
    if held:
        yield made(now, held)


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digests that any of their bucket's filters knows; rows come sorted by bucket, its filters (n > 0) before its digests."""
    now, filters = None, []
    for batch in batches:
        for bucket, part in batch.groupby("bucket", sort=False):
            if bucket != now:
                now, filters = bucket, []
            own = part["n"].to_numpy() > 0
            filters += [(n, np.frombuffer(bits, np.uint8)) for n, bits in zip(part["n"][own], part["bits"][own], strict=True)]
            rows = part.loc[~own, ["bucket", "hi", "lo"]]
            hi, lo, keep = rows["hi"].to_numpy(np.int64), rows["lo"].to_numpy(np.int64), np.zeros(len(rows), bool)
            for n, data in filters:
                places = _places(hi, lo, int(n)).astype(np.int64)
                keep |= ((data[places >> 3] >> (7 - (places & 7))) & 1).all(1)
            yield rows[keep]


class DigestStore:
    """Digests of all rows that were let through, in a versioned table of a folder; each run adds one version.

    Filters of a bucket are as many as runs since they were put together; :func:`compact` makes one of them.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.digests, self.filters = VersionedTable(spark, f"{path}/digests"), VersionedTable(spark, f"{path}/filters")
        #: Buckets that the last call has read, for reports and tests.
        self.buckets_read: list[int] = []

    def unseen(self, df: DataFrame, columns: list[str], run: int) -> DataFrame:
        """The rows of ``df`` whose digest of ``columns`` no earlier run had, one of each; they are then known to the store.

        ``run`` numbers the calls: one that is repeated gives rows of the same digests and adds nothing. The rows that stay
        are written before they are noted, so a stop between leaves them unseen. Of rows that share a digest any one stays.
        """
        if set(df.columns) == set(columns) and {kind for _, kind in df.dtypes} <= _PLAIN:
            # equal rows have equal digests and others don't, so repeats go before any digest is made
            fresh = digested(df.distinct(), columns)
        else:
            fresh = digested(df, columns).dropDuplicates(["__hi", "__lo"])
        known = self._known(fresh.select(F.col("__bucket").alias("bucket"), F.col("__hi").alias("hi"), F.col("__lo").alias("lo")), run)
        if known is not None:
            fresh = fresh.join(known, (F.col("__hi") == known.hi) & (F.col("__lo") == known.lo), "left_anti")
        path = scratch(self.spark, "unseen")
        fresh.write.parquet(path)
        kept = self.spark.read.schema(fresh.schema).parquet(path)
        new = kept.select(F.col("__bucket").alias("bucket"), F.col("__hi").alias("hi"), F.col("__lo").alias("lo"), F.lit(run).alias("run"))
        self.digests.append(new.repartition("bucket").sortWithinPartitions("bucket"), batch=("runs", run))
        by_bucket = new.drop("run").repartition("bucket").sortWithinPartitions("bucket")
        self.filters.append(by_bucket.mapInPandas(_filters, "bucket int, n long, bits binary"), batch=("runs", run))
        return kept.drop("__hi", "__lo", "__bucket")

    def _known(self, asked: DataFrame, run: int) -> DataFrame | None:
        """Of the digests asked for, those that runs before ``run`` have noted."""
        self.buckets_read = []
        if self.filters.version() is None or self.digests.version() is None:
            return None
        # filters come once for each bucket, before the digests that ask, and not beside every one of them
        held = self.filters.read().select("bucket", F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"), "n", "bits")
        both = held.unionByName(asked.withColumns({"n": F.lit(0).cast("long"), "bits": F.lit(None).cast("binary")}))
        path = scratch(self.spark, "asked")
        dealt = both.repartition("bucket").sortWithinPartitions("bucket", F.desc("n"))
        dealt.mapInPandas(_asked, _DIGEST).write.parquet(path)
        maybe = self.spark.read.schema(_DIGEST).parquet(path)
        # as many rows as there are buckets, and literals, so that the scan of the store passes over the others
        self.buckets_read = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())
        store = self.digests.read().where(F.col("bucket").isin(self.buckets_read) & (F.col("run") < run))
        return maybe.join(store, ["bucket", "hi", "lo"], "left_semi").select("hi", "lo")

    def compact(self) -> None:
        """One filter for each bucket, and files put together."""
        rows = self.digests.read().select("bucket", "hi", "lo").repartition("bucket").sortWithinPartitions("bucket")
        self.filters.replace(rows.mapInPandas(_filters, "bucket int, n long, bits binary"), floor=0)

