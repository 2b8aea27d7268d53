"""Keys derived from values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: what stands for null in a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 of the values as text, joined by hyphens; nulls count as a fixed word."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def hash_id(text: Column | str) -> Column:
    """Lower-case hex SHA-256."""
    return F.sha2((F.col(text) if isinstance(text, str) else text).cast("binary"), 256)


def row_hash(*columns: str) -> Column:
    """SHA-256 of all values run together, nulls as empty."""
    return F.sha2(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("binary"), 256)


def null_safe_digest(*columns: str) -> Column:
    """A digest that tells null from the empty string."""
    parts = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in columns]
    return F.md5(F.concat(*parts).cast("binary"))


def slugify(text: Column | str) -> Column:
    """Lower case; runs of anything but a-z and 0-9 become one underscore, none at the ends."""
    text = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "_"), "^_+|_+$", "")
