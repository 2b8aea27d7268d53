"""Data-quality checks and relation diffs. A check returns the rows that fail; an empty result passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nulls(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.where(F.col(column).isNull())


def not_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values, or combinations of them, that occur more than once, with how often."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose value is in no row of ``parent``; nulls pass."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("__key")), F.col(column) == F.col("__key"), "left_anti")


def not_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def not_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(~F.coalesce(F.expr(expression), F.lit(False)))


def stale(df: DataFrame, column: str, now: Column, interval: str) -> DataFrame:
    """One row if the newest value is older than the interval, or there is none."""
    newest = df.agg(F.max(column).alias("newest"))
    return newest.where(F.col("newest").isNull() | (F.col("newest") < now - F.expr(f"interval {interval}")))


def row_counts_differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with both counts if they differ."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(a, "n_a").join(F.broadcast(count(b, "n_b"))).where("n_a <> n_b")


def in_both_columns(df: DataFrame, first: str, second: str) -> DataFrame:
    """Values that occur in two columns that exclude each other."""
    tagged = df.select(F.col(first).alias("value"), F.lit(1).alias("side")).union(df.select(second, F.lit(2)))
    return tagged.where("value is not null").groupBy("value").agg(F.count_distinct("side").alias("sides")).where("sides > 1").select("value")


def severity(failing: DataFrame, warn_over: int = 0, error_over: int = 10) -> str:
    """pass, warn or error by the number of failing rows, of which no more are counted than needed."""
    n = failing.limit(error_over + 1).count()
    return "error" if n > error_over else "warn" if n > warn_over else "pass"


@dataclass
class Difference:
    """What two relations differ in."""

    only_left: list[str]
    only_right: list[str]
    retyped: list[str]
    columns: DataFrame
    rows: DataFrame

    def verdict(self) -> str:
        if self.only_left or self.only_right or self.retyped:
            return "schema_divergence"
        return "match" if self.rows.isEmpty() else "mismatch"


def _hashed(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """With ``__key`` and ``__row``, 64-bit hashes of the keys and of all common columns; nulls are values of their own."""
    hashed = lambda names: F.xxhash64(*[part for c in names for part in (F.col(c), F.col(c).isNull())])
    return df.withColumn("__key", hashed(keys)).withColumn("__row", hashed(columns))


def _digests(df: DataFrame, ranges: int) -> DataFrame:
    """(range, n, digest): of each range of key hashes, how many rows it has and the sum of their hashes."""
    return df.groupBy(F.pmod("__key", F.lit(ranges)).alias("range")).agg(F.count("*").alias("n"), F.sum(F.col("__row").cast("decimal(38, 0)")).alias("digest"))


def unlike_ranges(left: DataFrame, right: DataFrame, ranges: int) -> DataFrame:
    """(range): the ranges whose digests are unlike. One row a task and range is shuffled."""
    x = _digests(left, ranges).select("range", F.struct("n", "digest").alias("x"))
    y = _digests(right, ranges).select("range", F.struct("n", "digest").alias("y"))
    return x.join(y, "range", "full").where(~F.col("x").eqNullSafe(F.col("y"))).select("range")


#: Ranges of key hashes at the two levels of a comparison.
RANGES = (256, 1 << 16)


def difference(left: DataFrame, right: DataFrame, keys: list[str], ranges: tuple[int, ...] = RANGES) -> Difference:
    """Columns on one side or of unlike types; rows on one side or unlike (``change``); how often each column differs.

    Null keys equal each other. Rows that repeat a key are put in the order of their hashes, those that both sides have first, and
    compared one by one, so of a key with more rows on one side the rest is removed or added.

    Rows are compared by digests of ranges of key hashes first, at each level of ``ranges`` within the unlike ranges of the level
    before, and only rows of ranges that stay unlike are joined: equal relations shuffle digests and no rows. Hashes have 64 bits, so
    a difference is overlooked with a chance of about 2^-64 for each.
    """
    a, b = dict(left.dtypes), dict(right.dtypes)
    common = [c for c in left.columns if c in b]
    values = [c for c in common if c not in keys]
    retyped = [c for c in common if a[c] != b[c]]
    x, y = _hashed(left, keys, common), _hashed(right, keys, common)
    for n in ranges:
        # as many rows at most as there are ranges
        unlike = F.broadcast(unlike_ranges(x, y, n).select(F.col("range").alias("__range")))
        x, y = (side.join(unlike, F.pmod("__key", F.lit(n)) == F.col("__range"), "left_semi") for side in (x, y))
    # rows alike on both sides cancel out, repeats counted
    side = lambda df, k, v: df.select(*[F.col(c).alias(f"__{k}{i}") for i, c in enumerate(keys)], F.col("__row").alias(f"__row{k}"), F.struct(F.lit(1).alias("__"), *values).alias(v))
    x, y = side(x, "k", "__x"), side(y, "l", "__y")
    named = lambda k: [f"__{k}{i}" for i in range(len(keys))]
    nth = lambda k: F.row_number().over(Window.partitionBy(*named(k), f"__row{k}").orderBy(F.lit(1)))
    x, y = x.withColumn("__nthk", nth("k")), y.withColumn("__nthl", nth("l"))
    equal = reduce(lambda p, q: p & q, [F.col(p).eqNullSafe(F.col(q)) for p, q in zip([*named("k"), "__rowk", "__nthk"], [*named("l"), "__rowl", "__nthl"], strict=True)])
    order = lambda k: F.row_number().over(Window.partitionBy(*named(k)).orderBy(f"__row{k}", f"__nth{k}"))
    only_x = x.join(y, equal, "left_anti").select(*named("k"), "__x", order("k").alias("__i"))
    only_y = y.join(x, equal, "left_anti").select(*named("l"), "__y", order("l").alias("__j"))
    same = reduce(lambda p, q: p & q, [F.col(f"__k{i}").eqNullSafe(F.col(f"__l{i}")) for i in range(len(keys))], F.col("__i") == F.col("__j"))
    both = only_x.join(only_y, same, "full")
    ids = [F.when(F.col("__x").isNotNull(), F.col(f"__k{i}")).otherwise(F.col(f"__l{i}")).alias(k) for i, k in enumerate(keys)]
    change = F.when(F.col("__y").isNull(), "removed").when(F.col("__x").isNull(), "added").otherwise("changed")
    rows = both.select(*ids, change.alias("change"))
    matched = both.where("__x is not null and __y is not null")
    counted = matched.agg(*[F.count_if(~F.col(f"__x.{c}").eqNullSafe(F.col(f"__y.{c}"))).alias(c) for c in values], F.count("*").alias("__n"))
    columns = counted.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in values]), F.array(*values))).alias("column", "n_differing")) if values else None
    return Difference([c for c in a if c not in b], [c for c in b if c not in a], retyped, columns, rows)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, repeats counted, that only one side has, with ``side``."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
