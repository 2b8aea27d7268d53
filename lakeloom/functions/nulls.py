"""Functions whose treatment of nulls and bounds is fixed here, whatever the engine's default."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def greatest_known(*columns: Column | str) -> Column:
    """The greatest value; null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in columns]), F.greatest(*map(_c, columns)))


def least_known(*columns: Column | str) -> Column:
    """The least value; null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in columns]), F.least(*map(_c, columns)))


def whole_quotient(a: Column | str, b: Column | str) -> Column:
    """Integer division towards zero; null for a divisor of 0."""
    return F.call_function("div", _c(a), F.nullif(_c(b), F.lit(0)))


def at(array: Column | str, place: int) -> Column:
    """The element at a 1-based place; null beyond the end."""
    return F.try_element_at(_c(array), F.lit(place))


def part(text: Column | str, separator: str, place: int) -> Column:
    """The part at a 1-based place, separators taken literally; null beyond the end."""
    return F.nullif(F.split_part(_c(text), F.lit(separator), F.lit(place)), F.lit(""))


def joined_known(array: Column | str, separator: str, instead: str | None = None) -> Column:
    """Elements by ``separator``; nulls are left out or replaced."""
    return F.array_join(_c(array), separator) if instead is None else F.array_join(_c(array), separator, instead)


def unless_known_false(condition: Column) -> Column:
    """The condition, true where it is unknown."""
    return F.coalesce(condition, F.lit(True))


def no_doubles() -> Column:
    """A null of type array of doubles, for columns that another system fills."""
    return F.lit(None).cast("array<double>")


def fixed(number: Column | str, digits: int = 2) -> Column:
    """A number as text with so many decimals; null stays null."""
    return F.when(_c(number).isNotNull(), F.format_string(f"%.{digits}f", _c(number).cast("double")))


def capitalised(text: Column | str) -> Column:
    """Each word with its first letter in upper case and the rest in lower case; other characters stay."""
    words = F.regexp_extract_all(_c(text), F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1_000_000)))), "")
