"""Times as ISO-8601 text, the form in which models keep them, and the integer keys of calendar dimensions.

Naive values are UTC. Text that does not parse gives null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^\d{4}-\d{2}-\d{2}$"
_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso8601(text: Column | str) -> Column:
    """A timestamp: a bare date is midnight UTC, a time without a zone is UTC."""
    text = F.trim(_c(text))
    zoned = F.when(text.rlike(_DAY), F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(_ZONE), text).otherwise(F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def to_iso8601(moment: Column | str) -> Column:
    """A timestamp as text, in milliseconds: 2024-05-01T12:00:00.000Z."""
    return F.concat(F.date_format(_c(moment), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def day_to_iso8601(day: Column | str) -> Column:
    return F.date_format(_c(day), "yyyy-MM-dd")


def safe_iso8601_date(text: Column | str) -> Column:
    """Of 19 characters or more the first 19, of 10 the date; anything else is null. The result is a timestamp without zone."""
    text = _c(text)
    shown = F.when(F.length(text) >= 19, F.replace(F.left(text, F.lit(19)), F.lit("T"), F.lit(" "))).when(F.length(text) == 10, F.concat(text, F.lit(" 00:00:00")))
    return F.try_to_timestamp(shown, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def date_key(text: Column | str) -> Column:
    """YYYYMMDD as an integer; null unless the text has 10 characters or at least 19."""
    text = _c(text)
    digits = F.replace(F.left(text, F.lit(10)), F.lit("-"), F.lit(""))
    return F.when((F.length(text) == 10) | (F.length(text) >= 19), digits.try_cast("int"))


def time_key(text: Column | str) -> Column:
    """HHMM as an integer; null for fewer than 16 characters."""
    text = _c(text)
    return F.when(F.length(text) >= 16, F.concat(F.substring(text, 12, 2), F.substring(text, 15, 2)).try_cast("int"))


def parsed_with(text: Column | str, pattern: str) -> Column:
    """Parse with a MySQL-style pattern such as ``%Y-%m-%dT%H:%i:%s``; null where it does not fit."""
    return F.try_to_timestamp(_c(text), F.lit(java_pattern(pattern)))


def shown_with(moment: Column | str, pattern: str) -> Column:
    """A date or time as text by a MySQL-style pattern such as ``%Y%m%d``."""
    return F.date_format(_c(moment), java_pattern(pattern))


def java_pattern(pattern: str) -> str:
    """A MySQL-style date pattern in Java's letters; other letters are quoted."""
    # The codes that models use.
    codes = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%e": "d", "%H": "HH", "%h": "hh", "%i": "mm", "%s": "ss", "%S": "ss", "%f": "SSSSSS", "%p": "a", "%M": "MMMM", "%b": "MMM", "%a": "EEE", "%W": "EEEE", "%j": "DDD"}
    out, i = "", 0
    while i < len(pattern):
        if pattern[i] == "%" and pattern[i : i + 2] in codes:
            out, i = out + codes[pattern[i : i + 2]], i + 2
        else:
            out, i = out + (f"'{pattern[i]}'" if pattern[i].isalpha() else pattern[i]), i + 1
    return out.replace("''", "")


def seconds_between(earlier: Column | str, later: Column | str) -> Column:
    """Whole seconds from ``earlier`` to ``later``, truncated."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later))


def is_current(start: Column | str, end: Column | str, today: Column) -> Column:
    """Whether ``start`` has come and ``end`` has not passed; an open end never passes. ``today`` is given, so runs repeat."""
    return F.coalesce((_c(start) <= today) & (_c(end).isNull() | (today <= _c(end))), F.lit(False))
