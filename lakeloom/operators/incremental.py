"""Incremental batches: high-water marks, delete-and-insert, slowly changing dimensions.

Targets are DataFrames; :mod:`lakeloom.sources.sinks` writes them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_insert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of the keys in ``new`` replaced by those of ``new``; missing columns are null. Null keys match each other."""
    gone = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return target.join(gone, same, "left_anti").unionByName(new, allowMissingColumns=True)


#: Groups whose marks become part of the filter; with more, the marks are joined.
MOST_MARKS = 64


def after_watermark(source: DataFrame, target: DataFrame, column: str, inclusive: bool = False, by: list[str] | None = None, look_back: str | None = None, undated: str | None = None) -> DataFrame:
    """Rows of ``source`` newer than the newest in ``target`` (of each ``by`` group); all of them where it has none.

    ``look_back`` is an interval such as "7 days": rows whose ``undated`` column is null are taken again
    if they are at most so much older than the mark. The marks are aggregated first and become literals of the filter, which
    the scan of ``source`` can use to pass over what is old; only marks of more than MOST_MARKS groups are joined.
    """
    by = by or []
    kinds = dict(source.dtypes)
    marks = target.groupBy(*by).agg(F.max(column).alias("__mark"))

    def newer(mark: Column) -> Column:
        found = (F.col(column) >= mark) if inclusive else (F.col(column) > mark)
        if look_back:
            found = found | (F.col(undated).isNull() & (F.col(column) > mark - F.expr(f"interval {look_back}")))
        return found

    # text and back, so that a time keeps its kind whatever the session's zone
    known = marks.select(*[F.col(c).cast("string") for c in [*by, "__mark"]]).take(MOST_MARKS + 1)
    if len(known) > MOST_MARKS:
        named = marks.select(*[F.col(k).alias(f"__{k}") for k in by], "__mark")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by])
        return source.join(named, same, "left").where(F.col("__mark").isNull() | newer(F.col("__mark"))).select(*source.columns)
    known = [r for r in known if r["__mark"] is not None]
    if not known:
        return source
    tests, unknown = [], []
    for r in known:
        mark = newer(F.lit(r["__mark"]).cast(kinds[column]))
        here = [F.col(k).isNull() if r[k] is None else F.col(k) == F.lit(r[k]).cast(kinds[k]) for k in by]
        # the opposite without a negated null, in terms that a scan understands
        elsewhere = [F.col(k).isNotNull() if r[k] is None else F.col(k).isNull() | (F.col(k) != F.lit(r[k]).cast(kinds[k])) for k in by]
        tests.append(reduce(lambda a, b: a & b, here, mark))
        unknown += [reduce(lambda a, b: a | b, elsewhere)] if by else []
    if by:
        tests.append(reduce(lambda a, b: a & b, unknown))
    return source.where(reduce(lambda a, b: a | b, tests))


def whole_groups_after(source: DataFrame, target: DataFrame, group: str, column: str) -> DataFrame:
    """All rows of the groups that have any row newer than the newest in ``target``."""
    fresh = after_watermark(source, target, column).select(group).distinct()
    return source.join(fresh, group, "left_semi")


def scd2(current: DataFrame, existing: DataFrame, keys: list[str], attributes: list[str], now: Column) -> DataFrame:
    """The rows that a slowly changing dimension gains: new versions, and expired ones with their end.

    ``existing`` has ``effective_date``, ``end_date`` and ``is_current`` besides. A version is new where no
    current row has its key with equal attributes (null equals null); the current row of such a key expires.
    Delete-and-insert on key and effective_date puts the result into the table.
    """
    live = existing.where("is_current")
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*keys, *attributes]])
    known = live.select(*[F.col(c).alias(f"__{c}") for c in [*keys, *attributes]])
    changed = current.select(*keys, *attributes).join(known, equal, "left_anti")
    new = changed.select("*", now.alias("effective_date"), F.lit(None).cast("timestamp_ntz").alias("end_date"), F.lit(True).alias("is_current"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    renewed = changed.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    expired = live.join(renewed, same_key, "left_semi").select(*keys, *attributes, "effective_date", now.alias("end_date"), F.lit(False).alias("is_current"))
    return new.unionByName(expired)
