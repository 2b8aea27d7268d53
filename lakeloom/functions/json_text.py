"""JSON kept as text: scalars, arrays and maps out of it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_string(text: Column | str, path: str) -> Column:
    """What ``path`` names, unquoted; objects and arrays as JSON text. JSON null, like no match, is null."""
    return F.get_json_object(_c(text), path)


def json_scalar(text: Column | str, path: str) -> Column:
    """Like :func:`json_string`, but null for objects and arrays."""
    found = F.get_json_object(_c(text), path)
    return F.when(~found.rlike(r"^\s*[\[{]"), found)


def with_quoted_keys(path: str) -> str:
    """A path with keys in quotes, such as ``$.a."b-c"``, in the form with brackets that Spark reads."""
    return re.sub(r'\.?"([^"]*)"', r"['\1']", path)


def json_typed(text: Column | str, path: str, kind: str) -> Column:
    """What ``path`` names as a value of a type such as ``bigint``; null where it is none."""
    return json_scalar(text, with_quoted_keys(path)).try_cast(kind)


def json_wildcard(text: Column | str, path: str) -> Column:
    """All matches of a path such as ``$[*].value`` or ``$.items[*].value``, always in an array, as JSON text; [] if there are none.

    Null if what stands before the wildcard is no array.
    """
    before, _, after = with_quoted_keys(path).partition("[*]")
    whole = _c(text) if before == "$" else F.get_json_object(_c(text), before)
    items = F.from_json(whole, "array<variant>")
    matches = F.transform(items, lambda v: F.try_variant_get(v, f"${after}", "variant")) if after else items
    return F.to_json(F.filter(matches, lambda v: v.isNotNull() & ~F.is_variant_null(v)))


def repaired(text: Column | str) -> Column:
    """An object that was put into a string, perhaps with its quotes escaped, as an object; other text as it is.

    Outer quotes go, escaped quotes and backslashes lose a level, until it parses; text that never does stays.
    """
    text = _c(text)
    out = text
    for _ in range(2):
        bare = F.regexp_replace(out, r'^\s*"\s*(\{[\s\S]*\})\s*"\s*$', "$1")
        plain = F.regexp_replace(bare, r'\\(["\\])', "$1")
        out = F.when(is_json_object(out), out).when(is_json_object(bare), bare).otherwise(plain)
    return F.when(is_json_object(out), out).otherwise(text)


def json_string_array(text: Column | str, path: str = "$") -> Column:
    """The array at ``path`` as strings; null if there is none."""
    return F.from_json(F.get_json_object(_c(text), path), "array<string>")


def json_map(text: Column | str) -> Column:
    """The object's keys with their values as text."""
    return F.from_json(_c(text), "map<string,string>")


def is_json_object(text: Column | str) -> Column:
    """Whether the text is a JSON object."""
    return F.try_parse_json(_c(text)).isNotNull() & F.coalesce(F.ltrim(_c(text)).startswith("{"), F.lit(False))


def unnested_map(df, text: str, key: str = "key", value: str = "value"):
    """One row for each entry of the JSON object; text that is none gives no rows."""
    return df.select("*", F.explode(json_map(text)).alias(key, value))


def unnested_array(df, text: str, element: str = "element", ordinal: str | None = None):
    """One row for each element of the JSON array, as text, with its 1-based ``ordinal`` if named."""
    parsed = F.from_json(F.col(text), "array<string>")
    if ordinal is None:
        return df.select("*", F.explode(parsed).alias(element))
    return df.select("*", F.posexplode(parsed).alias(ordinal, element)).withColumn(ordinal, F.col(ordinal) + 1)
