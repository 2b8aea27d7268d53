"""Facts from several systems, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, facts
from .catalog import query
from .tables import table


@query("""
    select c_custkey as user_id, nullif(trim(regexp_replace(c_name, '\\s+', ' ', 'g')), '') as user_name, c_acctbal > 0 as user_is_active from customer
""")
def staging_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").withColumn("active", (F.col("c_acctbal") > 0).cast("string")).withColumn("c_name", F.concat(F.lit(" "), "c_name", F.lit("  ")))
    return facts.staged(raw, {"c_custkey": "user_id", "c_name": "user_name", "active": "user_is_active"}, trimmed=("c_name",), flags=("active",))


@query("""
    with e as (
        select 'orders' as platform, o_custkey as user_id, o_orderkey % 40 as run, o_orderdate as moment, o_orderkey as id from orders
        union all select 'events', user_id, event_id % 40, ts, event_id from events where event_type = 'signup'
    )
    select platform, e.user_id, run, id, c_custkey as user_fk, n_nationkey as run_fk from e left join customer on c_custkey = e.user_id left join nation on n_nationkey = run
    qualify row_number() over (partition by platform, e.user_id, run order by moment desc nulls last, id desc) = 1
""")
def enrollment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolments of several platforms, the newest of each person and run, with the keys of dimensions."""
    orders = table(spark, sf_dir, "orders").select(F.lit("orders").alias("platform"), F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") % 40).alias("run"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"))
    signups = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.lit("events").alias("platform"), "user_id", (F.col("event_id") % 40).alias("run"), F.col("ts").alias("at"), F.col("event_id").alias("id"))
    newest = dedup.latest(orders.unionByName(signups), ["platform", "user_id", "run"], "at", "id")
    rows = facts.with_dimension(newest, table(spark, sf_dir, "customer"), {"user_id": "c_custkey"}, "c_custkey", "user_fk")
    rows = facts.with_dimension(rows, table(spark, sf_dir, "nation"), {"run": "n_nationkey"}, "n_nationkey", "run_fk")
    return rows.select("platform", "user_id", "run", "id", "user_fk", "run_fk")


@query("""
    with c as (
        select 'campus' as source, event_id as id, case when event_id % 9 <> 0 then user_id end as who, event_id % 13 as run, ts from events where event_type = 'purchase'
        union all select 'partner', event_id, case when event_id % 7 <> 0 then user_id end, event_id % 13, ts from events where event_type = 'click'
    )
    select source, id, who, run from c
    qualify row_number() over (partition by case when who is not null then 'k|' || who || '|' || run else 'i|' || source || '|' || id end order by case source when 'campus' then 0 else 1 end, ts desc nulls last, id) = 1
""")
def certificates_across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One certificate for each person and run, from the preferred source; those of unknown people by their own id."""
    events = table(spark, sf_dir, "events")

    def of(kind: str, source: str, known: int) -> DataFrame:
        who = F.when(F.col("event_id") % known != 0, F.col("user_id"))
        return events.where(F.col("event_type") == kind).select(F.lit(source).alias("source"), F.col("event_id").alias("id"), who.alias("who"), (F.col("event_id") % 13).alias("run"), "ts")

    rows = of("purchase", "campus", 9).unionByName(of("click", "partner", 7))
    return facts.across_sources(rows, ["who", "run"], "id", "source", ["campus", "partner"], "ts", "id").select("source", "id", "who", "run")


@query("""
    with h as (select event_id, user_id, (floor(value / 25))::integer as attempt, value, ts from events where event_id % 5 <> 0)
    select user_id, attempt, event_id, value > 90 as is_correct from h qualify row_number() over (partition by user_id, attempt order by ts desc, event_id desc) = 1
""")
def module_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state of each attempt in a history of JSON states."""
    state = F.when(F.col("event_id") % 5 != 0, F.to_json(F.struct(F.floor(F.col("value") / 25).alias("attempts")))).otherwise(F.lit('{"attempts": null}'))
    history = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", state.alias("state"), F.when(F.col("value") > 90, 1.0).otherwise(0.5).alias("grade"), F.lit(1.0).alias("max_grade"))
    return facts.attempts(history, ["user_id"], "state", "ts", "event_id").select("user_id", "attempt", "event_id", "is_correct")


@query("""
    with m as (select conv_id, turn, role, text as content, row_number() over (partition by conv_id order by turn nulls first, role, text) as place from conversations where text is not null and role is not null),
        f as (select conv_id, role, content, min(place) as place from m group by all)
    select conv_id, (row_number() over (partition by conv_id order by place))::integer as message_number, role, content from f
""")
def flattened_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages out of a JSON array, repeats once, numbered anew."""
    parts = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    as_json = F.to_json(F.transform(parts, lambda p: F.struct(p["role"].alias("role"), p["content"].alias("content"))))
    threads = table(spark, sf_dir, "conversations").where("text is not null and role is not null").groupBy("conv_id").agg(as_json.alias("messages"))
    return facts.flattened_messages(threads, "conv_id", "messages")


@query("""
    with twice as (select * from conversations union all select * from conversations),
        m as (select conv_id, role, text as content, row_number() over (partition by conv_id order by turn nulls first, role, text) as place from twice where text is not null and role is not null),
        f as (select conv_id, role, content, min(place) as place from m group by all)
    select conv_id, (row_number() over (partition by conv_id order by place))::integer as message_number, role, content from f
""")
def flattened_transcripts_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole messages out of a JSON array (here: each there twice), repeats once, numbered anew."""
    rows = table(spark, sf_dir, "conversations").where("text is not null and role is not null")
    parts = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    as_json = F.to_json(F.transform(parts, lambda p: F.struct(p["role"].alias("role"), p["content"].alias("content"))))
    threads = rows.unionByName(rows).groupBy("conv_id").agg(as_json.alias("messages"))
    return facts.flattened_messages(threads, "conv_id", "messages")


@query("""
    with t as (select o_orderkey, unnest([o_custkey % 7, o_custkey % 11, 9999]) as s from orders),
        f as (select o_orderkey, '{' || case when o_orderstatus <> 'O' then '"NATION_2":"' || o_orderstatus || '",' else '' end || '"NATION_3":"' || o_orderpriority || '"}' as fields from orders)
    select o_orderkey, string_agg(distinct s_name, ', ' order by s_name) as names, any_value(fields) as fields from t join supplier on s = s_suppkey join f using (o_orderkey) group by o_orderkey
""")
def ticket_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of followers, and custom fields by their titles."""
    orders = table(spark, sf_dir, "orders")
    followers = F.array(F.col("o_custkey") % 7, F.col("o_custkey") % 11, F.lit(9999))
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    fields = F.to_json(F.array(F.struct(F.lit(3).alias("id"), F.col("o_orderpriority").alias("value")), F.struct(F.lit(2).alias("id"), status.alias("value")), F.struct(F.lit(99).alias("id"), F.lit("x").alias("value"))))
    tickets = orders.select("o_orderkey", followers.alias("followers"), fields.alias("fields"))
    names = facts.named_members(tickets, "o_orderkey", "followers", table(spark, sf_dir, "supplier"), "s_suppkey", "s_name")
    return names.join(facts.custom_fields(tickets, "o_orderkey", "fields", table(spark, sf_dir, "nation"), "n_nationkey", "n_name"), "o_orderkey")


@query("""
    select p_partkey, n_nationkey from (select p_partkey, 'x/' || (p_size % 30) || '/NATION_' || (p_size % 30) as path from part) join nation on path = n_name or path like '%/' || n_name
""")
def suffix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that end in a name, by equality of spelled-out suffixes."""
    size = (F.col("p_size") % 30).cast("string")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("x/"), size, F.lit("/NATION_"), size).alias("path"))
    return facts.suffix_match(parts, table(spark, sf_dir, "nation"), "path", "n_name").select("p_partkey", "n_nationkey")


@query("""
    select c_nationkey, round(sum(o_totalprice), 2) as spent, count(distinct o_custkey) as spent_people, count(*) filter (where o_orderstatus = 'F') as finished,
        count(distinct case when o_orderstatus = 'F' then o_custkey end) as finished_people
    from orders join customer on o_custkey = c_custkey group by c_nationkey
""")
def cohort_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums beside how many people each is made of."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = facts.cohort_sums(rows, ["c_nationkey"], "o_custkey", {"spent": F.col("o_totalprice"), "finished": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("long")})
    return out.withColumn("spent", F.round("spent", 2))
