"""Facts put together from several systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_text
from ..functions.keys import slugify, surrogate_key
from .dedup import first_row


def staged(raw: DataFrame, columns: dict[str, str], trimmed: tuple[str, ...] = (), timestamps: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """A staging projection: ``columns`` maps raw names to new ones, in order; what is not named, such as a password, is never read.

    ``trimmed`` raw columns lose outer blanks and inner runs of them, and blank ones become null;
    ``timestamps`` become ISO-8601 text, ``flags`` booleans.
    """
    from ..functions import iso8601

    out = []
    for old, new in columns.items():
        c = F.col(old)
        if old in trimmed:
            c = F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
        elif old in timestamps:
            c = iso8601.to_iso8601(c)
        elif old in flags:
            c = F.lower(c.cast("string")).isin("t", "true", "1", "yes")
        out.append(c.alias(new))
    return raw.select(*out)


def with_dimension(fact: DataFrame, dimension: DataFrame, on: dict[str, str], key: str, name: str) -> DataFrame:
    """``fact`` with the dimension's ``key`` as ``name``, null where it has no match.

    ``dimension`` keys need not be unique: each fact row stays one row, with the smallest key.
    """
    look_up = dimension.groupBy(*[F.col(d).alias(f"__{d}") for d in on.values()]).agg(F.min(key).alias(name))
    same = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__{d}") for f, d in on.items()])
    return fact.join(look_up, same, "left").drop(*[f"__{d}" for d in on.values()])


def across_sources(rows: DataFrame, keys: list[str], otherwise: str, source: str, preferred: list[str], recency: str, tie: str) -> DataFrame:
    """One row for what several sources report: by ``keys`` if all of them are known, else by the row's own id.

    The source named first wins, then the newest row.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    identity = F.when(known, F.concat_ws("|", F.lit("k"), *[F.col(k).cast("string") for k in keys])).otherwise(F.concat_ws("|", F.lit("i"), F.col(source), F.col(otherwise).cast("string")))
    rank = reduce(lambda c, n: c.when(F.col(source) == n[1], n[0]), enumerate(preferred[1:], 1), F.when(F.col(source) == preferred[0], 0)).otherwise(len(preferred))
    order = [rank, F.col(recency).desc_nulls_last(), F.col(tie)]
    return first_row(rows.withColumn("__identity", identity), ["__identity"], order).drop("__identity")


def attempts(history: DataFrame, keys: list[str], state: str, at: str, tie: str) -> DataFrame:
    """The latest state of each attempt, from a history of JSON states ``{"attempts": n, ...}`` with grades.

    States without an attempt go; an attempt is correct if its grade is the largest possible.
    """
    number = json_text.json_scalar(state, "$.attempts").try_cast("int")
    rows = history.withColumn("attempt", number).where("attempt is not null")
    newest = first_row(rows, [*keys, "attempt"], [F.col(at).desc_nulls_last(), F.col(tie).desc()])
    return newest.withColumn("is_correct", F.coalesce(F.col("grade") == F.col("max_grade"), F.lit(False)))


def flattened_messages(threads: DataFrame, thread: str, messages: str) -> DataFrame:
    """(thread, message_number, role, content): the messages of a JSON array, repeated ones only once, numbered anew."""
    parsed = F.from_json(messages, "array<struct<role:string,content:string>>")
    rows = threads.select(thread, F.posexplode(parsed).alias("place", "message")).select(thread, "place", "message.*")
    first = rows.groupBy(thread, "role", "content").agg(F.min("place").alias("place"))
    number = F.row_number().over(Window.partitionBy(thread).orderBy("place"))
    return first.withColumn("message_number", number).select(thread, "message_number", "role", "content")


def named_members(items: DataFrame, item: str, members: str, people: DataFrame, person: str, name: str) -> DataFrame:
    """(item, names): the names of the people whose ids an array column has, in order, comma-joined; unknown ids are left out."""
    rows = items.select(item, F.explode(members).alias("__person"))
    found = rows.join(people.select(F.col(person).alias("__person"), F.col(name).alias("__name")), "__person")
    return found.groupBy(item).agg(F.array_join(F.array_sort(F.collect_set("__name")), ", ").alias("names"))


def custom_fields(items: DataFrame, item: str, fields: str, titles: DataFrame, field: str, title: str) -> DataFrame:
    """(item, fields): a JSON array of {id, value} as one JSON object of titles and values; fields without value or title go."""
    rows = items.select(item, F.explode(F.from_json(fields, "array<struct<id:bigint,value:string>>")).alias("f")).where("f.value is not null")
    named = rows.join(titles.select(F.col(field).alias("__id"), F.col(title).alias("__title")), F.col("f.id") == F.col("__id"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("__title").alias("key"), F.col("f.value").alias("value"))))
    return named.groupBy(item).agg(F.to_json(F.map_from_entries(pairs)).alias("fields"))


def suffix_match(left: DataFrame, right: DataFrame, whole: str, part: str, separator: str = "/") -> DataFrame:
    """``left`` and ``right`` where ``part`` is ``whole`` or what follows a separator in it: its suffixes are spelled out, so the join is by equality."""
    words = F.split(whole, separator)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), separator))
    return left.withColumn("__suffix", F.explode(suffixes)).join(right, F.col("__suffix") == F.col(part)).drop("__suffix")


def cohort_sums(df: DataFrame, keys: list[str], person: str, sums: dict[str, Column]) -> DataFrame:
    """Sums, each beside the number of people that contribute to it, so that small cohorts can be withheld."""
    people = df.groupBy(*keys, person).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return people.groupBy(*keys).agg(*[e for n in sums for e in (F.sum(n).alias(n), F.count_if(F.col(n) > 0).alias(f"{n}_people"))])


def problem_events(logs: DataFrame, history: DataFrame, who: list[str], attempt: str, kind: str, check: str, at: str, tie: str) -> DataFrame:
    """Logged events and module states of the same submissions, put together.

    ``history`` has a row for each submission; its latest one of each person, problem and attempt counts as a
    ``check``, so that few rows are ranked. Of all events of an attempt, a check stays if it is the earliest; others stay always.
    """
    keys = [*who, attempt]
    states = first_row(history, keys, [F.col(at).desc_nulls_last(), F.col(tie).desc()]).withColumn(kind, F.lit(check))
    rows = logs.unionByName(states, allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(at).asc_nulls_first(), F.col(tie)))
    return rows.withColumn("__rank", rank).where((F.col("__rank") == 1) | (F.col(kind) != check)).drop("__rank")


def certificates(rows: DataFrame, person: list[str], identifier: str, platform: str, scope: str, preferred: list[str], updated: str, created: str) -> DataFrame:
    """Certificates of several platforms with a key, one of each.

    First, one of what several platforms report of the same person, by platform in order of preference; then, as no platform is
    sure to report an identifier once, the latest row of each key. Times are the last change, or else the creation.
    """
    moved = rows.withColumn("__at", F.coalesce(updated, created))
    one = across_sources(moved, person, identifier, platform, preferred, "__at", identifier)
    keyed = one.withColumn("certificate_key", surrogate_key(identifier, platform, scope))
    rest = [F.col(c).desc_nulls_last() for c in person]
    return first_row(keyed, ["certificate_key"], [F.col("__at").desc_nulls_last(), *rest]).drop("__at")


def onboarding_list(people: DataFrame, email: str, where: Column) -> DataFrame:
    """(email): the addresses of the people admitted, lower-cased, each once, in order."""
    address = F.nullif(F.lower(F.trim(F.col(email))), F.lit(""))
    return people.where(where).select(address.alias("email")).where("email is not null").distinct().orderBy("email")


def module_history(modules: DataFrame, history: DataFrame) -> DataFrame:
    """The states of learners' modules with whom and what they are of: (person, course, block, at, attempt, grade, max_grade, is_correct).

    ``modules`` (module, person, course, block) has a row for each learner and block, ``history`` (module, state, grade,
    max_grade, at) one for each submission. States without an attempt go, and so do those of unknown modules.
    """
    number = json_text.json_scalar("state", "$.attempts").try_cast("int")
    rows = history.withColumn("attempt", number).where("attempt is not null").join(modules, "module")
    correct = F.coalesce(F.col("grade") == F.col("max_grade"), F.lit(False))
    return rows.select("person", "course", "block", "at", "attempt", "grade", "max_grade", correct.alias("is_correct"))


def newest_retrieval(blocks: DataFrame, course: str, retrieved: str) -> DataFrame:
    """``blocks`` with ``is_latest``: whether they are of their course's newest retrieval, found by one aggregation."""
    newest = blocks.groupBy(F.col(course).alias("__course")).agg(F.max(retrieved).alias("__newest"))
    rows = blocks.join(newest, F.col(course).eqNullSafe(F.col("__course")))
    return rows.withColumn("is_latest", F.coalesce(F.col(retrieved) == F.col("__newest"), F.lit(False))).drop("__course", "__newest")


def tag_dimension(tags: DataFrame, tag: str) -> DataFrame:
    """(tag_key, slug, tag, n): one row for each slug of the tags, by its most frequent spelling, the least among equals."""
    spelled = tags.where(F.col(tag).isNotNull()).groupBy(slugify(tag).alias("slug"), F.col(tag).alias("tag")).agg(F.count("*").alias("n")).where("slug <> ''")
    best = F.min(F.struct((-F.col("n")).alias("order"), "tag")).alias("best")
    return spelled.groupBy("slug").agg(best, F.sum("n").alias("n")).select(surrogate_key("slug").alias("tag_key"), "slug", "best.tag", "n")
