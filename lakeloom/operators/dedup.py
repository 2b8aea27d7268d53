"""Keeping one row, or one batch, of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Give an order without ties, with nulls placed explicitly.

    Spark limits the rows of a key before the shuffle too, so each task passes on one of them.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest(df: DataFrame, keys: list[str], *recency: str) -> DataFrame:
    """The newest row of each key by ``recency`` columns, nulls oldest."""
    return first_row(df, keys, [F.col(c).desc_nulls_last() for c in recency])


def latest_by_state(df: DataFrame, keys: list[str], *recency: str) -> DataFrame:
    """Like :func:`latest`, as one aggregation: map-side combined, so a hot key needs no task of its own.

    Rows that tie on all of ``recency`` are told apart by their other columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in recency]
    newest = F.max(F.struct(*recency, *rest)).alias("__newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "__newest.*").select(*df.columns)


def latest_batch(df: DataFrame, batch: str, keys: list[str] | None = None) -> DataFrame:
    """All rows of the newest batch (of each key)."""
    if not keys:
        newest = df.agg(F.max(batch).alias("__newest"))
        return df.join(F.broadcast(newest), F.col(batch) == F.col("__newest"), "left_semi")
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(batch).desc_nulls_last()))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def tied_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first rows of each key, all that tie."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def distinct_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key; null is a value of its own, rows without any of the key columns pass."""
    present = [k for k in keys if k in df.columns]
    return df.dropDuplicates(present) if len(present) == len(keys) else df
