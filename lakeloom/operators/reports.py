"""Aggregations that reports share: gaps between events, rates, scores, ladders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, digits: int = 1) -> Column:
    """Per cent, rounded; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def with_gaps(events: DataFrame, keys: list[str], at: str, tie: str, limit_seconds: int | None = None) -> DataFrame:
    """``events`` with ``gap_seconds`` since the previous one of their keys; null for the first and beyond the limit."""
    previous = F.lag(at).over(Window.partitionBy(*keys).orderBy(at, tie))
    gap = F.timestamp_diff("SECOND", previous, F.col(at))
    return events.withColumn("gap_seconds", gap if limit_seconds is None else F.when(gap <= limit_seconds, gap))


def gap_percentiles(events: DataFrame, keys: list[str], gap: str = "gap_seconds") -> DataFrame:
    """Exact 10th, 50th and 90th percentiles of the gaps of each key.

    Gaps are whole seconds up to a limit, so the state of a key is bounded by it.
    """
    shares = F.percentile(gap, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    rows = events.groupBy(*keys).agg(shares.alias("__p"), F.count(gap).alias("n_gaps"))
    return rows.select(*keys, "n_gaps", *[F.col("__p")[i].alias(n) for i, n in enumerate(("p10", "p50", "p90"))])


def forward_filled(events: DataFrame, keys: list[str], order: list[str], column: str) -> DataFrame:
    """``column`` from the next event of the keys where it is null."""
    following = F.lead(column).over(Window.partitionBy(*keys).orderBy(*order))
    return events.withColumn(column, F.coalesce(column, following))


def daily_activity(streams: dict[str, DataFrame], keys: list[str], day: str) -> DataFrame:
    """Counts of each stream by keys and day, 0 where it has none; the streams are put under one another, so one shuffle."""
    names = list(streams)
    rows = None
    for name, df in streams.items():
        part = df.select(*keys, day, *[F.lit(1 if n == name else 0).alias(f"n_{n}") for n in names])
        rows = part if rows is None else rows.unionByName(part)
    sums = rows.groupBy(*keys, day).agg(*[F.sum(f"n_{n}").alias(f"n_{n}") for n in names])
    total = sum((F.col(f"n_{n}") for n in names[1:]), F.col(f"n_{names[0]}"))
    return sums.withColumn("is_active", total > 0)


def health(used: Column, seats: Column, completed: Column, ladder: list[tuple[float, float, str]], last: str) -> Column:
    """The first step of the ladder whose least seat use and completion (per cent) are both met."""
    seat_use, completion = rate(used, seats), rate(completed, used)
    out = F.when(F.coalesce(seats, F.lit(0)) == 0, F.lit("no seats"))
    for use, done, name in ladder:
        out = out.when((F.coalesce(seat_use, F.lit(0)) >= use) & (F.coalesce(completion, F.lit(0)) >= done), F.lit(name))
    return out.otherwise(F.lit(last))


def robust_scores(df: DataFrame, weights: dict[str, float], bias: float, limit: float = 1000.0) -> DataFrame:
    """``df`` with ``score``: a logistic of weighted columns, each less its median over its interquartile range.

    A range of 0 counts as 1; the weighted sum is clipped. Quartiles are exact, in one row that is joined back.
    """
    facts = None
    for c in weights:
        row = quantiles(df, [], c, {"a": 0.25, "b": 0.5, "c": 0.75}).select(F.array("a", "b", "c").alias(f"__{c}"))
        facts = row if facts is None else facts.join(F.broadcast(row))
    z = F.lit(bias)
    for c, w in weights.items():
        spread = F.col(f"__{c}")[2] - F.col(f"__{c}")[0]
        z = z + F.lit(w) * (F.col(c) - F.col(f"__{c}")[1]) / F.when(spread == 0, 1.0).otherwise(spread)
    z = F.greatest(F.lit(-limit), F.least(F.lit(limit), z))
    return df.join(F.broadcast(facts)).withColumn("score", 1 / (1 + F.exp(-z))).drop(*[f"__{c}" for c in weights])


def packed(df: DataFrame, keys: list[str], order: list[str], fields: list[str], separator: str = "|", between: str = ";") -> DataFrame:
    """The rows of each key as one string: fields by ``separator``, rows in order by ``between``."""
    record = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    rows = F.array_sort(F.collect_list(F.struct(*order, record.alias("__record"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda r: r["__record"]), between).alias("packed"))


def visible_to(df: DataFrame, memberships: DataFrame, key: str, user_column: str, user: str) -> DataFrame:
    """Row-level security: the rows whose ``key`` the user is a member of."""
    return df.join(memberships.where(F.col(user_column) == user).select(key), key, "left_semi")


def quantiles(df: DataFrame, keys: list[str], column: str, shares: dict[str, float], ranges: int = 64) -> DataFrame:
    """Exact interpolated quantiles of each key, whatever the number of rows or values: (keys, names of ``shares``).

    Values are counted first. Approximate quantiles cut each key's values into ``ranges``, whose sizes tell in which of
    them a rank lies; only those are put in order. So no buffer holds a key's values, and no task sorts more than a
    few ranges of it. A key without values has nulls.
    """
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))
    values = df.groupBy(*keys, F.col(column).alias("__v")).agg(F.count("*").alias("__n")).where("__v is not null")
    edges = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = df.groupBy(*keys).agg(F.percentile_approx(column, edges, 1000).alias("__cuts"))
    dealt = values.alias("a").join(cuts.alias("b"), same("a", "b")).select("a.*", F.size(F.filter("__cuts", lambda c: c < F.col("__v"))).alias("__range"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    sizes = dealt.groupBy(*keys, "__range").agg(F.sum("__n").alias("__size"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0))).withColumn("__all", F.sum("__size").over(whole))
    ranks = [r for p in shares.values() for at in [(F.col("__all") - 1) * F.lit(p)] for r in (F.floor(at), F.ceil(at))]
    asked = sizes.withColumn("__asked", F.filter(F.array_distinct(F.array(*ranks)), lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__size")))).where("size(__asked) > 0")
    rows = dealt.alias("a").join(asked.alias("b"), same("a", "b") & (F.col("a.__range") == F.col("b.__range"))).select("a.*", "__before", "__all", "__asked")
    along = Window.partitionBy(*keys, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__first", F.col("__before") + F.coalesce(F.sum("__n").over(along), F.lit(0)))
    held = rows.withColumn("__rank", F.explode(F.filter("__asked", lambda r: (r >= F.col("__first")) & (r < F.col("__first") + F.col("__n")))))
    found = held.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("__rank", F.col("__v").cast("double")))).alias("__at"), F.max("__all").alias("__all"))

    def between(p: float) -> Column:
        at = (F.col("__all") - 1) * F.lit(p)
        low, high = (F.try_element_at("__at", f(at)) for f in (F.floor, F.ceil))
        return low + (at - F.floor(at)) * (high - low)

    every = df.select(*keys).distinct() if keys else None
    out = found.select(*keys, *[between(p).alias(n) for n, p in shares.items()])
    if every is None:
        return out
    return every.alias("a").join(out.alias("b"), same("a", "b"), "left").select("a.*", *[f"b.{n}" for n in shares])


def _titled(title: Column, *words: str) -> Column:
    return reduce(lambda a, b: a & b, [~F.upper(title).contains(w[1:]) if w[0] == "-" else F.upper(title).contains(w) for w in words])


def answer_report(attempts: DataFrame, enrolments: DataFrame, content: DataFrame, limit_seconds: int = 600) -> DataFrame:
    """How fast verified learners answer, problem by problem, beside what they do in homework and exams.

    ``attempts`` (event_id, platform, user_id, course, block, at, grade, max_grade, attempt), ``enrolments`` (user_id,
    course, mode, grade), ``content`` (course, block_id, parent_id, chapter_id, sequential_id, title, metadata, is_latest).
    A problem's time runs from the learner's previous event in the same unit; the shortest below ``limit_seconds`` counts. Titles
    of unit and chapter tell exams, metadata of problem, unit and sequential homework; what is not known to be neither
    counts as both. A learner's exam flags are problems answered faster than by nine of ten.
    """
    verified = enrolments.groupBy("user_id", "course").agg(F.max("grade").alias("course_grade"), F.bool_or(F.col("mode") == "verified").alias("__paid")).where("__paid").drop("__paid")
    latest = content.where("is_latest")
    node = lambda name: latest.select(F.col("course").alias(f"__{name}_course"), F.col("block_id").alias(f"__{name}"), F.col("title").alias(f"{name}_name"), F.col("metadata").alias(f"__{name}_meta"))
    own = latest.select(F.col("course").alias("__c"), F.col("block_id").alias("__b"), "parent_id", "chapter_id", "sequential_id", F.col("metadata").alias("__meta"))
    rows = attempts.join(verified, ["user_id", "course"]).join(own, (F.col("course") == F.col("__c")) & (F.col("block") == F.col("__b")), "left")
    for name, column in (("unit", "parent_id"), ("chapter", "chapter_id"), ("sequential", "sequential_id")):
        rows = rows.join(node(name), (F.col("course") == F.col(f"__{name}_course")) & (F.col(column) == F.col(f"__{name}")), "left")
    rows = with_gaps(rows, ["platform", "user_id", "course", "parent_id"], "at", "event_id")
    unit, chapter = F.col("unit_name"), F.col("chapter_name")
    exam = [_titled(t, "EXAM", "-EXAMPLE", "-EXAMINING", "-PRACTICE") for t in (unit, chapter)] + [_titled(t, "EXAM ") for t in (unit, chapter)]
    homework = [F.col(c).contains('"format":"Homework"') for c in ("__meta", "__unit_meta", "__sequential_meta")]
    any_of = lambda tests: reduce(lambda a, b: a | b, tests)
    rows = rows.withColumns({
        "is_final": F.coalesce(any_of([_titled(t, "FINAL EXAM") for t in (unit, chapter)]), F.lit(False)),
        "is_exam": F.coalesce(any_of(exam), F.lit(True)),
        "is_homework": F.coalesce(any_of(homework), F.lit(True)),
    })
    learner = ["platform", "course", "user_id"]
    problems = rows.groupBy(*learner, "block", "unit_name", "chapter_name", "sequential_name", "is_exam", "is_homework", "is_final").agg(
        F.max("max_grade").alias("possible"),
        F.max("attempt").alias("attempts"),
        F.max("grade").alias("best"),
        F.array_join(F.array_sort(F.collect_list(F.col("grade").cast("string"))), ",").alias("grades"),
        F.min(F.when(F.col("gap_seconds") < limit_seconds, F.col("gap_seconds"))).alias("seconds"),
        F.min("gap_seconds").alias("seconds_unlimited"),
        F.max("course_grade").alias("course_grade"),
    )
    # whole seconds below the limit: the state of an exact percentile is bounded by it
    fast = problems.groupBy("platform", "course", "block").agg(F.percentile("seconds", 0.1).alias("__fast"))
    timed = problems.join(fast, ["platform", "course", "block"])
    when = lambda kind, column: F.when(F.col(kind), F.col(column))
    grade = F.col("best").cast("decimal(12,2)")
    learners = timed.groupBy(*learner).agg(
        F.avg(F.when(F.col("is_homework"), grade)).cast("double").alias("homework_grade"),
        F.percentile(when("is_homework", "seconds"), 0.5).alias("homework_seconds"),
        F.sum(when("is_homework", "attempts")).alias("homework_attempts"),
        F.avg(F.when(F.col("is_exam"), grade)).cast("double").alias("exam_grade"),
        F.percentile(when("is_exam", "seconds"), 0.5).alias("exam_seconds"),
        F.sum(F.when(F.col("is_exam"), F.coalesce(F.col("seconds") < F.col("__fast"), F.lit(False)).cast("long"))).alias("exam_flags"),
        F.count_distinct(F.when(~F.col("is_exam"), F.col("block"))).alias("n_other"),
        F.bool_or("is_final").alias("took_final"),
    )
    return problems.join(learners, learner).withColumn("n_other", F.nullif("n_other", F.lit(0))).drop("is_final")


def engagement(streams: dict[str, tuple[DataFrame, dict[str, Column]]], content: DataFrame, who: list[str], block: str, levels: list[str]) -> DataFrame:
    """Measures of several streams side by side, for each person and the titles of the ``levels`` above a block.

    ``content`` (block, titles of ``levels``) is joined once, to the streams put under one another, and one grouping
    stitches them, where full outer joins would shuffle for each stream. A measure is null where its stream has no row.
    """
    parts = [df.select(*who, block, *[c.alias(n) for n, c in measures.items()]) for df, measures in streams.values()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [n for _, measures in streams.values() for n in measures]
    sums = rows.groupBy(*who, block).agg(*[F.sum(n).alias(n) for n in names])
    return sums.join(content.select(block, *levels), block, "left").groupBy(*who, *levels).agg(*[F.sum(n).alias(n) for n in names])
