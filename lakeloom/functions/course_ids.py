"""Course identifiers: ``course-v1:org+course+run`` and ``org/course/run``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json_text import json_string

# Fixed: a course key in either notation, within a longer text.
_V1 = r"(course-v1:[^/+\s\"?&]+\+[^/+\s\"?&]+\+[^/+\s\"?&@]+)"
_SLASH = r"courses/([^/+\s]+/[^/+\s]+/[^/+\s?&]+)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def found(text: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none."""
    return F.nullif(F.regexp_extract(_c(text), pattern, group), F.lit(""))


def course_in(text: Column | str) -> Column:
    return F.coalesce(found(text, _V1), found(text, _SLASH))


def course_of_event(context: Column | str, event_type: Column | str, page: Column | str) -> Column:
    """Which course a tracking event is about: the context's course, its path, the event type, then the page."""
    named = F.nullif(json_string(context, "$.course_id"), F.lit(""))
    return F.coalesce(named, course_in(json_string(context, "$.path")), course_in(event_type), course_in(page))


def to_slashes(course: Column | str) -> Column:
    """``course-v1:a+b+c`` as ``a/b/c``."""
    return F.replace(F.replace(_c(course), F.lit("course-v1:"), F.lit("")), F.lit("+"), F.lit("/"))


def to_v1(course: Column | str) -> Column:
    """``a/b/c`` as ``course-v1:a+b+c``; a key in that form stays."""
    course = _c(course)
    return F.when(course.startswith("course-v1:"), course).otherwise(F.concat(F.lit("course-v1:"), F.replace(course, F.lit("/"), F.lit("+"))))


def without_run(course: Column | str) -> Column:
    """The course of a course run, in the notation that it has."""
    return F.regexp_replace(_c(course), r"^(course-v1:[^+]+\+[^+]+|[^/]+/[^/]+)[+/].*$", "$1")


def run_tag(course: Column | str) -> Column:
    """The last part of a course run's key."""
    return F.element_at(F.split(_c(course), "[+/]"), -1)


def platform_of(course: Column | str, platforms: dict[str, str], other: str | None = None) -> Column:
    """The platform whose prefix the key starts with, in the order given; null, or ``other``, if there is none."""
    out = None
    for prefix, name in platforms.items():
        test = _c(course).startswith(prefix)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


def acronym(title: Column | str) -> Column:
    """The first letters of the words of a title, upper-case."""
    words = F.filter(F.split(F.trim(_c(title)), r"\s+"), lambda w: w != "")
    return F.upper(F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ""))


def program_id(number: Column | str, title: Column | str, tracked: int = 4, fixed: dict[int, str] | None = None) -> Column:
    """A readable program id: for ``tracked`` what the title has in parentheses, for some a fixed word, else the acronym."""
    out = F.when(_c(number) == tracked, found(title, r"\(([^)]*)\)"))
    for k, word in (fixed or {5: "FIN"}).items():
        out = out.when(_c(number) == k, F.lit(word))
    return out.otherwise(acronym(title))
