"""Orders, attribution, contracts and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import identity, incremental, joins, reports
from .catalog import query
from .tables import table


@query("""
    with c as (
        select o_orderkey, l_suppkey, 1 as priority, l_shipdate as shipped, l_linenumber as tie, l_partkey from orders join lineitem on o_orderkey = l_orderkey where l_quantity >= 30
        union all
        select o_orderkey, l_suppkey, 2, l_shipdate, l_linenumber, l_partkey from orders join lineitem on o_orderkey = l_orderkey where l_quantity < 30
    )
    select o_orderkey, l_suppkey, priority from c qualify row_number() over (partition by o_orderkey order by priority, shipped desc nulls last, tie, l_suppkey, l_partkey) = 1
""")
def order_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's supplier: large lines first, then the latest shipment."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    ranked = lines.withColumn("priority", F.when(F.col("l_quantity") >= 30, 1).otherwise(2))
    order = [F.col("l_shipdate").desc_nulls_last(), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")]
    return identity.attributed(ranked, ["o_orderkey"], "priority", order).select("o_orderkey", "l_suppkey", "priority")


@query("""
    with use as (select c_nationkey as k, count(distinct c_custkey) as seats, count(distinct o_custkey) as used, count(distinct case when o_orderstatus = 'F' then o_custkey end) as done
        from customer left join orders on o_custkey = c_custkey and o_totalprice > 200000 group by c_nationkey)
    select n_name, seats, used, done, round(100.0 * used / nullif(seats, 0), 1) as seat_use, round(100.0 * done / nullif(used, 0), 1) as completion,
        case when coalesce(seats, 0) = 0 then 'no seats' when coalesce(round(100.0 * used / nullif(seats, 0), 1), 0) >= 80 and coalesce(round(100.0 * done / nullif(used, 0), 1), 0) >= 75 then 'healthy'
            when coalesce(round(100.0 * used / nullif(seats, 0), 1), 0) >= 50 then 'watch' else 'at risk' end as status
    from use join nation on k = n_nationkey
""")
def contract_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seat use, completion and a status ladder for each organisation (here: nation)."""
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 200000").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("final"))
    seats = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    use = seats.groupBy("c_nationkey").agg(F.count("*").alias("seats"), F.count("o_custkey").alias("used"), F.count_if(F.col("final")).alias("done"))
    seats, used, done = F.col("seats"), F.col("used"), F.col("done")
    return use.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", "seats", "used", "done", reports.rate(used, seats).alias("seat_use"), reports.rate(done, used).alias("completion"), reports.health(used, seats, done, [(80, 75, "healthy"), (50, 0, "watch")], "at risk").alias("status")
    )


@query("""
    with bridge as (select distinct c_nationkey as org, l_partkey % 50 as program, o_custkey, o_orderstatus from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey)
    select org, program, count(distinct o_custkey) as enrolled, count(distinct case when o_orderstatus in ('F', 'P') then o_custkey end) as active, count(distinct case when o_orderstatus = 'F' then o_custkey end) as certified
    from bridge group by org, program
""")
def program_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People at each step, by organisation and program. Statuses are folded by person first, so no count needs distinct values."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 50).alias("program")).distinct()
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    people = rows.groupBy(F.col("c_nationkey").alias("org"), "program", "o_custkey").agg(F.bool_or(F.col("o_orderstatus").isin("F", "P")).alias("a"), F.bool_or(F.col("o_orderstatus") == "F").alias("f"))
    return people.groupBy("org", "program").agg(F.count("*").alias("enrolled"), F.count_if("a").alias("active"), F.count_if("f").alias("certified"))


@query("""
    select strftime(date_trunc('month', o_orderdate), '%Y-%m') as month, c_nationkey, count(*) as n_orders, count(distinct o_custkey) as contributors
    from orders join customer on o_custkey = c_custkey group by all
""")
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and contributors of each organisation and month."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "c_nationkey").agg(F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("contributors"))


@query("""
    with e as (select c_nationkey, strftime(date_trunc('year', o_orderdate), '%Y') as year, o_custkey, o_totalprice from orders join customer on o_custkey = c_custkey)
    select year, c_nationkey::varchar as org, count(distinct o_custkey) as people, round(sum(o_totalprice), 2) as total from e group by year, c_nationkey
    union all select year, 'all', count(distinct o_custkey), round(sum(o_totalprice), 2) from e group by year
""")
def totals_beside_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A total with its own distinct key beside the groups; both come from one fold by person."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    people = rows.groupBy(F.date_format("o_orderdate", "yyyy").alias("year"), "c_nationkey", "o_custkey").agg(F.sum("o_totalprice").alias("s"))
    # a person belongs to one organisation, so the people of a year add up
    groups = people.groupBy("year", "c_nationkey").agg(F.count("*").alias("people"), F.sum("s").alias("total"))
    total = groups.groupBy("year").agg(F.sum("people").alias("people"), F.sum("total").alias("total")).withColumn("org", F.lit("all"))
    return groups.withColumn("org", F.col("c_nationkey").cast("string")).drop("c_nationkey").unionByName(total).select("year", "org", "people", F.round("total", 2).alias("total"))


@query("""
    select o_orderkey, case when c_mktsegment = 'BUILDING' then 'staff' when s_suppkey is not null then 'named company' when o_totalprice > 250000 or c_acctbal > 5000 then 'B2B' else 'B2C' end as kind
    from orders join customer on o_custkey = c_custkey left join (select s_suppkey from supplier where s_acctbal > 0) on s_suppkey = c_custkey
""")
def order_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(companies, F.col("s_suppkey") == F.col("c_custkey"), "left")
    large = (F.col("o_totalprice") > 250000) | (F.col("c_acctbal") > 5000)
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "staff").when(F.col("s_suppkey").isNotNull(), "named company").when(large, "B2B").otherwise("B2C")
    return rows.select("o_orderkey", kind.alias("kind"))


@query("""
    with sets as (select l_orderkey, list_sort(list(distinct l_suppkey % 5)) as ids from lineitem group by l_orderkey)
    select array_to_string(ids, ',') as ids, max(l_orderkey) as newest, count(*) as n from sets group by ids
""")
def array_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted id arrays as keys, and the newest row that has each."""
    sets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_suppkey") % 5)).alias("ids"))
    return sets.groupBy("ids").agg(F.max("l_orderkey").alias("newest"), F.count("*").alias("n")).withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


@query("""
    select c_custkey, c_mktsegment, round(c_acctbal, 2) as c_acctbal from customer where c_custkey % 3 <> 0
    union all select c_custkey, 'CHANGED', round(c_acctbal + 1, 2) from customer where c_custkey % 3 = 0 and c_custkey % 2 = 0
    union all select c_custkey, c_mktsegment, round(c_acctbal, 2) from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0
""")
def delete_and_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch replaces the rows of its keys."""
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    batch = target.where("c_custkey % 6 = 0").withColumns({"c_mktsegment": F.lit("CHANGED"), "c_acctbal": F.round(F.col("c_acctbal") + 1, 2)})
    return incremental.delete_insert(target, batch, ["c_custkey"])


@query("""
    with live as (select c_custkey, c_mktsegment, c_nationkey from customer where c_custkey % 5 <> 0),
        now as (select c_custkey, case when c_custkey % 7 = 0 then null else c_mktsegment end as c_mktsegment, c_nationkey from customer),
        new as (select * from now where not exists (select 1 from live where live.c_custkey = now.c_custkey and live.c_mktsegment is not distinct from now.c_mktsegment and live.c_nationkey = now.c_nationkey))
    select c_custkey, c_mktsegment, c_nationkey, '2024-02-01' as effective, null as ended, true as is_current from new
    union all select c_custkey, c_mktsegment, c_nationkey, '2024-01-01', '2024-02-01', false from live where c_custkey in (select c_custkey from new)
""")
def slowly_changing_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and changed members of a dimension, and the versions that they end."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    live = rows.where("c_custkey % 5 <> 0").select("*", F.expr("timestamp_ntz'2024-01-01'").alias("effective_date"), F.lit(None).cast("timestamp_ntz").alias("end_date"), F.lit(True).alias("is_current"))
    now = rows.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")))
    out = incremental.scd2(now, live, ["c_custkey"], ["c_mktsegment", "c_nationkey"], F.expr("timestamp_ntz'2024-02-01'"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return out.select("c_custkey", "c_mktsegment", "c_nationkey", day("effective_date").alias("effective"), day("end_date").alias("ended"), "is_current")


@query("""
    with nodes as (select p_partkey as id, case when p_partkey < 10 then lpad(p_partkey::varchar, 20, '0') when p_partkey < 100 then lpad((p_partkey % 10)::varchar, 20, '0') || lpad(p_partkey::varchar, 20, '0')
            else lpad((p_partkey % 10)::varchar, 20, '0') || lpad((p_partkey % 100)::varchar, 20, '0') || lpad(p_partkey::varchar, 20, '0') end as path from part)
    select c.id, p.id as ancestor_id from nodes c join nodes p on starts_with(c.path, p.path) and length(p.path) < length(c.path)
""")
def path_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ancestors in a tree of materialised paths, by equality of prefixes."""
    step = lambda c: F.lpad(c.cast("string"), 20, "0")
    k = F.col("p_partkey")
    path = F.when(k < 10, step(k)).when(k < 100, F.concat(step(k % 10), step(k))).otherwise(F.concat(step(k % 10), step(k % 100), step(k)))
    nodes = table(spark, sf_dir, "part").select(k.alias("id"), path.alias("path"))
    return joins.ancestors(nodes, "path", "id", 20).select("id", "ancestor_id")


@query("""
    with nodes as (select p_partkey as id, array_to_string([lpad(right(p_partkey::varchar, i), 20, '0') for i in range(1, length(p_partkey::varchar) + 1)], '') as path from part)
    select c.id, p.id as ancestor_id from nodes c join nodes p on starts_with(c.path, p.path) and length(p.path) < length(c.path)
""")
def path_ancestors_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ancestors of all parts: as many steps as a key has digits, each wide enough for any 64-bit key."""
    steps = F.expr("transform(sequence(1, length(cast(p_partkey as string))), i -> lpad(right(cast(p_partkey as string), i), 20, '0'))")
    nodes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array_join(steps, "").alias("path"))
    return joins.ancestors(nodes, "path", "id", 20).select("id", "ancestor_id")


@query("""
    select c_custkey, c_name from customer where c_nationkey in (select s_nationkey from supplier where s_suppkey = 3)
""")
def row_level_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user (here: a supplier) may see: the rows of the organisations that they are a member of."""
    members = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").cast("string").alias("user"))
    return reports.visible_to(table(spark, sf_dir, "customer"), members, "c_nationkey", "user", "3").select("c_custkey", "c_name")
