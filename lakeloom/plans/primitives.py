"""Relational primitives: scans, predicates, joins, aggregates, windows, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import dedup, joins, reports
from .catalog import query
from .tables import table


@query("""
    select user_id, event_type, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((microsecond(ts) // 1000 % 1000)::varchar, 3, '0') || 'Z' as occurred_at,
        json_extract_string(props, '$.k')::bigint as k
    from events qualify row_number() over (partition by user_id, event_type order by ts desc nulls last, event_id desc) = 1
""")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user and type, as an aggregation."""
    newest = dedup.latest_by_state(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id")
    moment = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return newest.select("user_id", "event_type", "event_id", moment.alias("occurred_at"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""
    select o_orderkey, o_custkey, o_totalprice from orders
    where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01' and o_orderstatus in ('F', 'P')
        and o_totalprice between 1000 and 200000 and o_orderpriority like '%URGENT%'
""")
def pushed_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates and columns reach the scan."""
    rows = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'1997-01-01' and o_orderdate < timestamp_ntz'1998-01-01'")
    rows = rows.where(F.col("o_orderstatus").isin("F", "P") & F.col("o_totalprice").between(1000, 200000) & F.col("o_orderpriority").like("%URGENT%"))
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
    select c_custkey, case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'low' else 'high' end as band,
        case c_mktsegment when 'BUILDING' then 'B' when 'MACHINERY' then 'M' else '?' end as segment_code,
        coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as other_segment, try_cast(right(c_name, 3) as integer) as suffix,
        try_cast(c_name as integer) as not_a_number
    from customer
""")
def case_and_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("band"),
        F.when(segment == "BUILDING", "B").when(segment == "MACHINERY", "M").otherwise("?").alias("segment_code"),
        F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("none")).alias("other_segment"),
        F.right("c_name", F.lit(3)).try_cast("int").alias("suffix"),
        F.col("c_name").try_cast("int").alias("not_a_number"),
    )


@query("""
    select r_name, n_name, count(*) as n_orders, round(sum(o_totalprice), 2) as revenue
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    group by r_name, n_name
""")
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are added up by customer before they meet the dimensions, so what moves is a row for each customer."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    rows = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.sum("n").alias("n_orders"), F.round(F.sum("s"), 2).alias("revenue"))


@query("""
    select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and o_orderpriority = '1-URGENT' and o_totalprice > 300000
""")
def left_join_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A left join with literal conjuncts, which go to the scan of the right side."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 300000").select("o_custkey", "o_orderkey")
    return table(spark, sf_dir, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("""
    with a as (select user_id, count(*) as n from events where event_type = 'click' group by user_id),
        b as (select user_id, count(*) as n, round(sum(value), 2) as spent from events where event_type = 'purchase' group by user_id),
        c as (select o_custkey as user_id, count(*) as n from orders group by o_custkey)
    select coalesce(a.user_id, b.user_id, c.user_id) as user_id, a.n as clicks_n, b.n as purchases_n, b.spent as purchases_spent, c.n as orders_n
    from a full join b on a.user_id = b.user_id full join c on coalesce(a.user_id, b.user_id) = c.user_id
""")
def full_outer_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").groupBy("user_id").agg(F.count("*").alias("n"))
    purchases = events.where("event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("spent"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n"))
    return joins.stitched({"clicks": clicks, "purchases": purchases, "orders": orders}, ["user_id"])


@query("""
    select c_custkey, c_name, s_suppkey from customer join supplier on c_custkey = s_suppkey or c_nationkey = s_nationkey
""")
def disjunctive_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An OR of two equalities as two equi-joins; the 25 nations come in blocks."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = ("c_nationkey", "s_nationkey")
    found = joins.disjunctive(customers, suppliers, [("c_custkey", "s_suppkey"), nations], coarse=[nations])
    return found.select("c_custkey", "c_name", "s_suppkey")


@query("""
    with clicks as (select user_id, ts, event_id, value from events where event_type = 'click'),
        errors as (select user_id, ts, max(event_id) as error_id from events where event_type = 'error' group by user_id, ts)
    select clicks.user_id, clicks.event_id, errors.error_id from clicks asof left join errors on clicks.user_id = errors.user_id and clicks.ts >= errors.ts
""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each click, the last error of its user at or before it."""
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    errors = events.where("event_type = 'error'").groupBy("user_id", "ts").agg(F.max("event_id").alias("error_id")).withColumnRenamed("ts", "error_at")
    return joins.as_of(clicks, errors, ["user_id"], "ts", "error_at", ["error_id"]).select("user_id", "event_id", "error_id")


@query("""
    with m as (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month)) as month_end),
        g as (select distinct o_orderpriority from orders where o_orderdate < timestamp '2001-12-01')
    select g.o_orderpriority, strftime(m.month_end, '%Y-%m-%d') as month_end, count(o_orderkey) as n_orders, round(coalesce(sum(o_totalprice), 0), 2) as revenue
    from g cross join m left join orders o on o.o_orderpriority = g.o_orderpriority and o.o_orderdate < m.month_end
    group by all
""")
def cumulative_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything ordered before each month's start, by priority: running sums instead of an inequality join."""
    spine = spark.sql("select explode(sequence(timestamp_ntz'1995-01-01', timestamp_ntz'2001-12-01', interval 1 month)) as month_end")
    sums = joins.cumulative(table(spark, sf_dir, "orders"), spine, "o_orderdate", "month_end", ["o_orderpriority"], {"n_orders": F.lit(1).cast("long"), "revenue": F.col("o_totalprice")})
    return sums.select("o_orderpriority", F.date_format("month_end", "yyyy-MM-dd").alias("month_end"), "n_orders", F.round("revenue", 2).alias("revenue"))


@query("""
    with clicks as (select user_id, ts, event_id, value from events where event_type = 'click'),
        errors as (select user_id, ts, max(event_id) as error_id from events where event_type = 'error' group by user_id, ts)
    select clicks.user_id, clicks.event_id, errors.error_id from clicks asof left join errors on clicks.user_id = errors.user_id and clicks.ts >= errors.ts
""")
def as_of_join_by_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with windows of a day, for keys that hold a large share of all rows."""
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    errors = events.where("event_type = 'error'").groupBy("user_id", "ts").agg(F.max("event_id").alias("error_id")).withColumnRenamed("ts", "error_at")
    return joins.as_of(clicks, errors, ["user_id"], "ts", "error_at", ["error_id"], spans="day").select("user_id", "event_id", "error_id")


@query("""
    select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 250000)
""")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where("o_totalprice > 250000")
    return table(spark, sf_dir, "customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""
    select s_suppkey from supplier where s_nationkey not in (select case when n_regionkey > 1 then n_nationkey end from nation where n_regionkey > 1)
""")
def null_aware_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN over a list that could hold nulls."""
    listed = table(spark, sf_dir, "nation").where("n_regionkey > 1").select("n_nationkey")
    return joins.nulls_first_anti(table(spark, sf_dir, "supplier"), listed, "s_nationkey", "n_nationkey").select("s_suppkey")


@query("""
    with a as (select n_nationkey, nullif(n_regionkey, 0) as k from nation), b as (select r_name, nullif(r_regionkey, 0) as k from region)
    select n_nationkey, r_name from a join b on a.k is not distinct from b.k
""")
def null_safe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "nation").select("n_nationkey", F.nullif("n_regionkey", F.lit(0)).alias("k"))
    b = table(spark, sf_dir, "region").select("r_name", F.nullif("r_regionkey", F.lit(0)).alias("j"))
    return a.join(b, F.col("k").eqNullSafe(F.col("j"))).select("n_nationkey", "r_name")


@query("""
    select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 4) as sum_disc_price,
        round(avg(l_discount), 6) as avg_disc, count(*) as n, count(distinct l_suppkey) as n_suppliers, count(distinct case when l_discount > 0.05 then l_partkey end) as n_discounted_parts,
        count(*) filter (where l_quantity > 25) as n_large, min(l_shipdate)::date::varchar as first_ship, bool_or(l_tax > 0.079) as any_high_tax,
        sum(l_quantity) filter (where l_tax = 0) as untaxed_qty, round(100.0 * count(*) filter (where l_quantity > 25) / nullif(count(*), 0), 1) as pct_large
    from lineitem group by l_returnflag, l_linestatus
""")
def conditional_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.count_if(F.col("l_quantity") > 25)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count("*").alias("n"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
        F.count_distinct(F.when(F.col("l_discount") > 0.05, F.col("l_partkey"))).alias("n_discounted_parts"),
        large.alias("n_large"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_ship"),
        F.bool_or(F.col("l_tax") > 0.079).alias("any_high_tax"),
        F.sum(F.when(F.col("l_tax") == 0, F.col("l_quantity"))).alias("untaxed_qty"),
        reports.rate(large, F.count("*")).alias("pct_large"),
    )


@query("""
    select o_custkey, array_to_string(list(o_orderkey order by o_orderdate, o_orderkey), ',') as order_keys,
        array_to_string(list_sort(list(distinct o_orderstatus)), ',') as statuses
    from orders group by o_custkey
""")
def ordered_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.array_join(F.transform(rows, lambda r: r["o_orderkey"].cast("string")), ",").alias("order_keys"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"),
    )


@query("""
    select event_type, round(quantile_cont(value, 0.1), 6) as p10, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.9), 6) as p90 from events group by event_type
""")
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of groups of any size: only the ranges of values that hold a rank asked for are put in order."""
    shares = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    found = reports.quantiles(table(spark, sf_dir, "events"), ["event_type"], "value", shares)
    return found.select("event_type", *[F.round(n, 6).alias(n) for n in shares])


@query()
def approximate_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate form, which keeps a bounded state; engines differ in what they return."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.percentile_approx("value", F.array(F.lit(0.1), F.lit(0.5)), 10_000).alias("p"))


@query("""
    select event_type, true as p10_holds, true as p50_holds from events group by event_type
""")
def approximate_percentile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the ranks of the approximate percentiles are as near as promised: off by one in 10,000 rows at most."""
    events = table(spark, sf_dir, "events")
    shares = {"p10": 0.1, "p50": 0.5}
    marks = events.groupBy("event_type").agg(*[F.percentile_approx("value", p, 10_000).alias(n) for n, p in shares.items()])
    counts = events.join(marks, "event_type").groupBy("event_type").agg(
        F.count("*").alias("n"), *[c for p in shares for c in (F.count_if(F.col("value") < F.col(p)).alias(f"{p}_below"), F.count_if(F.col("value") <= F.col(p)).alias(f"{p}_upto"))]
    )
    slack = F.col("n") / 10_000 + 1
    holds = lambda p: (F.col(f"{p}_below") <= F.lit(shares[p]) * F.col("n") + slack) & (F.col(f"{p}_upto") >= F.lit(shares[p]) * F.col("n") - slack)
    return counts.select("event_type", *[holds(p).alias(f"{p}_holds") for p in shares])


@query("""
    select r_name as name, 'region' as kind from region union all select n_name, 'nation' from nation
    union all select distinct c_mktsegment, 'segment' from customer
""")
def union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("region").alias("kind"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("kind"))
    segment = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name")).distinct().withColumn("kind", F.lit("segment"))
    return region.unionByName(nation).unionByName(segment)


@query("select c_nationkey as nationkey from customer union select s_nationkey from supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side is made distinct first, so that little moves."""
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")).distinct()
    return a.union(table(spark, sf_dir, "supplier").select("s_nationkey").distinct()).distinct()


@query("""
    select o_custkey, o_orderkey, o_totalprice from orders qualify rank() over (partition by o_custkey order by o_orderdate desc nulls last) = 1
""")
def ties_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of each customer's last day of ordering."""
    return dedup.tied_first(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last()]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("select o_orderkey, o_custkey from orders qualify dense_rank() over (order by o_orderdate desc) = 1")
def newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the newest date, by one aggregation."""
    return dedup.latest_batch(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "o_custkey")


@query("""
    select o_custkey, o_orderkey, first_value(o_orderkey) over w as elected, lead(o_orderkey) over w as next_key,
        last_value(case when o_orderstatus = 'F' then o_orderkey end ignore nulls) over (w rows between unbounded preceding and current row) as last_final,
        row_number() over w as n
    from orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)
""")
def window_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Election, look-ahead and fill over one sort."""
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.first("o_orderkey").over(upto).alias("elected"),
        F.lead("o_orderkey").over(w).alias("next_key"),
        F.last(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), ignorenulls=True).over(upto).alias("last_final"),
        F.row_number().over(w).cast("long").alias("n"),
    )


@query("""
    select o_custkey, strftime(o_orderdate, '%Y-%m-%d') as day, round(sum(sum(o_totalprice)) over (partition by o_custkey order by o_orderdate rows between 2 preceding and current row), 2) as rolling
    from orders group by o_custkey, o_orderdate
""")
def rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sum over the last three days of ordering: a window over a grouped query."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate").rowsBetween(-2, 0)
    daily = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderdate").agg(F.sum("o_totalprice").alias("s"))
    return daily.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.round(F.sum("s").over(w), 2).alias("rolling"))
