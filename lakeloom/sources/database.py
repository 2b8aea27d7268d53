"""Loads of a source's tables into versioned tables: by cursor and key, or whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_database
from .versioned import Version, VersionedTable


def newest(held: VersionedTable, cursor: str):
    """The greatest value of the cursor column in the table, one row of an aggregate; None for a new table or one without values."""
    if held.version() is None:
        return None
    rows = held.read()
    return rows.agg(F.max(cursor)).first()[0] if cursor in rows.columns else None


def due(rows: DataFrame, cursor: str, since) -> DataFrame:
    """Rows at the mark or after it, and those without a mark; all if there is none yet.

    The mark itself is asked for again: rows that share it may have come since. It is a literal, so the source filters by it.
    """
    return rows if since is None else rows.where((F.col(cursor) >= F.lit(since)) | F.col(cursor).isNull())


def load(rows: DataFrame, held: VersionedTable, keys: Sequence[str] = (), cursor: str | None = None, floor: float = 0.5) -> Version:
    """Bring a table up to a source. With a cursor, rows that are due are merged by key; without one, the source takes the table's place.

    Of rows of one key the newest by the cursor stays, without a mark the oldest. Keys that left the source stay in a table that is
    merged, and go from one that is replaced; fewer rows than ``floor`` of the table's are an error then, and the table stays.
    Columns that the source has gained are added; a column of another type is an error. Two runs over the same source
    leave the same rows.
    """
    if not cursor:
        return held.replace(rows, floor)
    if not keys:
        raise ValueError("a load by cursor needs the key that it merges by")
    return held.upsert(due(rows, cursor, newest(held, cursor)), list(keys), (cursor,))


def load_database(spark: SparkSession, held: VersionedTable, url: str, name: str, keys: Sequence[str] = (), cursor: str | None = None, excluded: Sequence[str] = (), floor: float = 0.5, **options) -> Version:
    """:func:`load` of a table by JDBC; ``options`` are those of :func:`read_database`. ``excluded`` columns are never asked for."""
    return load(read_database(spark, url, name, excluded=excluded, **options), held, keys, cursor, floor)
