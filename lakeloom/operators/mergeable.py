"""Aggregates that are kept by day and united later: exact distinct counts as bitmaps, quantiles as sketches.

Both are combined within each task before the shuffle, and what is kept is small: a bitmap of 4 KB for each range of 32,768 ids that
occurs, a sketch of a few KB. A report over any span unites what is kept and doesn't read the events again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, by: list[str], id_: str) -> DataFrame:
    """(by, bucket, bits): which ids (whole numbers) each group has. Null ids count for nothing."""
    ids = df.where(F.col(id_).isNotNull())
    return ids.groupBy(*by, F.bitmap_bucket_number(id_).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits"))


def united(kept: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return kept.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(kept: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    """The exact number of distinct ids of each group; groups may be coarser than those kept."""
    return united(kept, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))


def in_spans(kept: DataFrame, at: str, days: int) -> DataFrame:
    """What is kept by day as spans of ``days`` that end on each day that there is: (until, ...). Each row goes to as many spans as it has days."""
    ends = F.explode(F.sequence(F.col(at), F.date_add(F.col(at), days - 1)))
    until = kept.select(F.col(at).alias("until")).distinct()
    return kept.withColumn("until", ends).join(F.broadcast(until), "until", "left_semi")


#: The accuracy parameter of sketches, and what ranks may be wrong by, as a share of the rows, with a chance of 99 percent.
K, RANK_ERROR = 400, 0.01


def sketches(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(by, sketch): a quantile sketch of a column of doubles for each group. Nulls count for nothing."""
    return df.where(F.col(column).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), K).alias("sketch"))


def merged(kept: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return kept.groupBy(*by).agg(F.kll_merge_agg_double("sketch", K).alias("sketch"))


def quantile(sketch: str, share: float) -> Column:
    """The value that about this share of the rows is not above, within RANK_ERROR of the rows."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def ranks(df: DataFrame, by: list[str], column: str, bound: str) -> DataFrame:
    """(by, below, up_to): the shares of rows whose value is below, and not above, the group's ``bound``."""
    n = F.count(column)
    facts = [F.count_if(F.col(column) < F.col(bound)), F.count_if(F.col(column) <= F.col(bound))]
    return df.groupBy(*by).agg(*[(c / n).alias(name) for c, name in zip(facts, ("below", "up_to"), strict=True)])

