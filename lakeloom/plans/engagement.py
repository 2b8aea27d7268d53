"""Events of learners: watermarks, gaps, engagement, risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy, incremental, reports
from .catalog import query
from .tables import table

_SPLIT = "timestamp_ntz'2024-01-20 00:00:00'"


@query("""
    with old as (select * from events where ts <= timestamp '2024-01-20'), mark as (select max(ts) as m from old)
    select event_id from events, mark where ts > m
""")
def watermark_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows newer than all of the target."""
    events = table(spark, sf_dir, "events")
    return incremental.after_watermark(events, events.where(f"ts <= {_SPLIT}"), "ts").select("event_id")


@query("""
    with marks as (select event_type, max(ts) as m from events where ts <= timestamp '2024-01-20' and event_type <> 'signup' group by event_type),
        s as (select event_id, event_type, ts, case when event_id % 4 <> 0 then ts end as updated from events)
    select event_id from s left join marks using (event_type) where m is null or ts >= m or (updated is null and ts > m - interval 7 day)
""")
def watermark_with_look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks by type, inclusive; rows without an update time are taken again for seven days; types unknown to the target whole."""
    events = table(spark, sf_dir, "events").withColumn("updated", F.when(F.col("event_id") % 4 != 0, F.col("ts")))
    target = events.where(f"ts <= {_SPLIT} and event_type <> 'signup'")
    return incremental.after_watermark(events, target, "ts", inclusive=True, by=["event_type"], look_back="7 days", undated="updated").select("event_id")


@query("""
    select event_id from events where user_id in (select user_id from events where ts > (select max(ts) from events where ts <= timestamp '2024-01-30 20:00:00'))
""")
def whole_conversations_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of users that have any newer than the target's."""
    events = table(spark, sf_dir, "events")
    return incremental.whole_groups_after(events, events.where("ts <= timestamp_ntz'2024-01-30 20:00:00'"), "user_id", "ts").select("event_id")


@query("""
    with g as (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id)) as us from events),
        h as (select *, case when us // 1000000 <= 14400 then us // 1000000 end as gap from g)
    select user_id, count(gap) as n_gaps, round(quantile_cont(gap, 0.1), 4) as p10, round(quantile_cont(gap, 0.5), 4) as p50, round(quantile_cont(gap, 0.9), 4) as p90 from h group by user_id
""")
def gaps_between_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the time since a learner's previous event, long breaks left out."""
    gaps = reports.with_gaps(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id", 14400)
    return reports.gap_percentiles(gaps, ["user_id"]).select("user_id", "n_gaps", *[F.round(p, 4).alias(p) for p in ("p10", "p50", "p90")])


@query("""
    with g as (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id)) as us from events),
        h as (select *, case when us // 1000000 <= 14400 then us // 1000000 end as gap from g),
        p as (select event_type, quantile_cont(gap, 0.1) as fast from h group by event_type)
    select user_id, count(*) as n_events, count(*) filter (where gap < fast) as n_fast, round(100.0 * count(*) filter (where gap < fast) / nullif(count(gap), 0), 1) as pct_fast, count(*) filter (where event_type = 'error' and value > 50) as n_flagged
    from h join p using (event_type) group by user_id
""")
def answer_speed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each learner is faster than the fastest tenth of all on the same kind of item."""
    gaps = reports.with_gaps(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id", 14400)
    fast = reports.quantiles(gaps, ["event_type"], "gap_seconds", {"fast": 0.1})
    n_fast = F.count_if(F.col("gap_seconds") < F.col("fast"))
    return gaps.join(fast, "event_type").groupBy("user_id").agg(
        F.count("*").alias("n_events"),
        n_fast.alias("n_fast"),
        reports.rate(n_fast, F.count("gap_seconds")).alias("pct_fast"),
        F.count_if((F.col("event_type") == "error") & (F.col("value") > 50)).alias("n_flagged"),
    )


@query("""
    select event_id, user_id, coalesce(v, lead(v) over (partition by user_id order by ts, event_id)) as v from (select *, case when event_id % 3 <> 0 then value end as v from events)
""")
def next_value_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return reports.forward_filled(rows, ["user_id"], ["ts", "event_id"], "v").select("event_id", "user_id", "v")


@query("""
    with b as (select *, case when event_id % 20 = 0 then 'chapter' when event_id % 5 = 0 then 'sequential' else 'problem' end as kind, event_id % 7 as course from events),
        c as (select *, last_value(case when kind = 'chapter' then event_id end ignore nulls) over w as chapter_id, last_value(case when kind = 'sequential' then event_id end ignore nulls) over w as s
            from b window w as (partition by course order by event_id rows between unbounded preceding and current row))
    select event_id, course, chapter_id, case when chapter_id is null or chapter_id <= s then s end as sequential_id from c
""")
def hierarchy_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block's chapter and sequential, carried along the depth-first order."""
    kind = F.when(F.col("event_id") % 20 == 0, "chapter").when(F.col("event_id") % 5 == 0, "sequential").otherwise("problem")
    blocks = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 7).alias("course"), kind.alias("kind"))
    return hierarchy.filled(blocks, ["course"], "event_id", "kind", "event_id", ["chapter", "sequential"]).select("event_id", "course", "chapter_id", "sequential_id")


@query("""
    with b as (select event_id as id, case when event_id > 0 then event_id // 8 end as parent from events)
    select b.id, b.parent as parent_1, p1.parent as parent_2, p2.parent as parent_3 from b left join b p1 on b.parent = p1.id left join b p2 on p1.parent = p2.id
""")
def parents_by_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.expr("if(event_id > 0, event_id div 8, null)").alias("parent"))
    return hierarchy.climbed(blocks, "id", "parent", 3).select("id", "parent_1", "parent_2", "parent_3")


@query("""
    select user_id, strftime(ts, '%Y-%m-%d') as day, count(*) filter (where event_type = 'click') as n_clicks, count(*) filter (where event_type = 'view') as n_views, count(*) filter (where event_type = 'error') as n_errors, true as is_active
    from events where event_type in ('click', 'view', 'error') group by all
""")
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of several streams by user and day."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    of = lambda kind: events.where(F.col("event_type") == kind)
    return reports.daily_activity({"clicks": of("click"), "views": of("view"), "errors": of("error")}, ["user_id"], "day")


@query("""
    select user_id, user_id % 11 as block, count(*) as n_events, count(distinct event_type) as n_types, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_at, round(max(value), 2) as best,
        count(*) filter (where event_type = 'purchase') as attempts, round(sum(case when event_type = 'purchase' then value else 0 end), 2) as points
    from events group by user_id
""")
def block_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, attempts and last activity of each user and block."""
    bought = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").groupBy("user_id", (F.col("user_id") % 11).alias("block")).agg(
        F.count("*").alias("n_events"),
        F.count_distinct("event_type").alias("n_types"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_at"),
        F.round(F.max("value"), 2).alias("best"),
        F.count_if(bought).alias("attempts"),
        F.round(F.sum(F.when(bought, F.col("value")).otherwise(0)), 2).alias("points"),
    )


@query("""
    with attempts as (select user_id, event_type, floor(value / 10)::bigint as problem, event_id, ts from events)
    select event_id, user_id, event_type, problem from attempts where event_type <> 'click'
    union all select event_id, user_id, event_type, problem from (select * from attempts where event_type = 'click' qualify row_number() over (partition by user_id, problem order by ts, event_id) = 1)
""")
def problem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of checks (here: clicks) the earliest of each user and problem, of other types all."""
    from ..operators import dedup

    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.floor(F.col("value") / 10).alias("problem"), "event_id", "ts")
    checks = dedup.first_row(rows.where("event_type = 'click'"), ["user_id", "problem"], [F.col("ts").asc_nulls_last(), F.col("event_id")])
    return rows.where("event_type <> 'click'").unionByName(checks).select("event_id", "user_id", "event_type", "problem")


@query("""
    with u as (select user_id, count(*)::double as n, avg(value) as v from events group by user_id),
        q as (select quantile_cont(n, 0.25) as n1, quantile_cont(n, 0.5) as n2, quantile_cont(n, 0.75) as n3, quantile_cont(v, 0.25) as v1, quantile_cont(v, 0.5) as v2, quantile_cont(v, 0.75) as v3 from u)
    select user_id, round(1 / (1 + exp(-greatest(-1000, least(1000, 0.5 - 1.2 * (n - n2) / (case when n3 = n1 then 1 else n3 - n1 end) + 0.7 * (v - v2) / (case when v3 = v1 then 1 else v3 - v1 end))))), 6) as score
    from u, q
""")
def risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic of robustly scaled activity."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").cast("double").alias("n"), F.avg("value").alias("v"))
    return reports.robust_scores(users, {"n": -1.2, "v": 0.7}, 0.5).select("user_id", F.round("score", 6).alias("score"))


@query("""
    select strftime(date_trunc('week', ts), '%Y-%m-%d') as week, event_type, count(*) as n, count(distinct user_id) as users, sum(value::decimal(18, 2))::double as total, sum(value::decimal(18, 2))::double / count(*) as mean from events group by all
""")
def chart_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregates that charts use, at week grain."""
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    # sums of decimals are exact, whatever the order of the rows
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return table(spark, sf_dir, "events").groupBy(week.alias("week"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), total.alias("total"), (total / F.count("*")).alias("mean"))
