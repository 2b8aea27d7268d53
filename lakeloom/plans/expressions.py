"""Scalar functions: strings, numbers, arrays, maps, JSON made of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso8601, json_text, nulls
from ..operators import dedup, joins, spines
from .catalog import query
from .tables import table


@query("""
    select c_custkey, upper(c_name) as up, lower(c_mktsegment) as low, trim('  ' || c_name || ' ') as trimmed, replace(c_name, '#', '-') as replaced, substring(c_name, 10, 4) as middle,
        split_part(c_name, '#', 2) as part_2, nullif(split_part(c_name, '#', 3), '') as part_3, instr(c_name, '#')::integer as place, strpos(c_mktsegment, 'zzz')::integer as nowhere,
        regexp_replace(c_name, '([A-Za-z]+)#0*([0-9]+)', '\\2 \\1') as swapped, nullif(regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1), '') as digits,
        concat_ws(', ', c_mktsegment, nullif(c_mktsegment, 'BUILDING'), c_nationkey::varchar) as listed, c_mktsegment || nullif(c_mktsegment, 'BUILDING') as null_propagates,
        length(c_name)::integer as n, lpad(c_nationkey::varchar, 3, '0') as padded, reverse(c_mktsegment) as backwards, regexp_matches(c_name, '#0+1') as matches, starts_with(c_mktsegment, 'B') as starts
    from customer
""")
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    unknown = F.nullif(segment, F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.upper(name).alias("up"),
        F.lower(segment).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("replaced"),
        F.substring(name, 10, 4).alias("middle"),
        nulls.part(name, "#", 2).alias("part_2"),
        nulls.part(name, "#", 3).alias("part_3"),
        F.instr(name, "#").alias("place"),
        F.instr(segment, "zzz").alias("nowhere"),
        F.regexp_replace(name, "([A-Za-z]+)#0*([0-9]+)", "$2 $1").alias("swapped"),
        F.nullif(F.regexp_extract(name, "#0*([1-9][0-9]*)$", 1), F.lit("")).alias("digits"),
        F.concat_ws(", ", segment, unknown, F.col("c_nationkey").cast("string")).alias("listed"),
        F.concat(segment, unknown).alias("null_propagates"),
        F.length(name).alias("n"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("padded"),
        F.reverse(segment).alias("backwards"),
        name.rlike("#0+1").alias("matches"),
        segment.startswith("B").alias("starts"),
    )


@query("""
    select p_partkey, round(p_retailprice / 7, 2) as rounded, floor(p_retailprice / 7)::bigint as down, ceil(p_retailprice / 7)::bigint as up, (p_partkey % 7) as rest, p_size // 7 as whole,
        case when p_size % 5 <> 0 then p_partkey // (p_size % 5) end as guarded, greatest(p_partkey, 100 * p_size) as larger, case when p_size % 3 <> 0 then least(p_size, 7) end as smaller_known,
        abs(p_size - 25) as away, try_cast(p_brand as integer) as unparsed
    from part
""")
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = F.col("p_retailprice") / 7
    known = F.when(F.col("p_size") % 3 != 0, F.col("p_size"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(seventh, 2).alias("rounded"),
        F.floor(seventh).alias("down"),
        F.ceil(seventh).alias("up"),
        (F.col("p_partkey") % 7).alias("rest"),
        nulls.whole_quotient("p_size", F.lit(7)).cast("int").alias("whole"),
        nulls.whole_quotient("p_partkey", F.col("p_size") % 5).alias("guarded"),
        nulls.greatest_known("p_partkey", (100 * F.col("p_size")).cast("long")).alias("larger"),
        nulls.least_known(known, F.lit(7)).alias("smaller_known"),
        F.abs(F.col("p_size") - 25).alias("away"),
        F.col("p_brand").try_cast("int").alias("unparsed"),
    )


@query("""
    with a as (select p_partkey, [p_size, p_size % 5, p_size % 5, null] as x from part)
    select p_partkey, array_to_string(list_sort(list_distinct(x)), ',') as distinct_sorted, x[1] as first, x[9] as beyond, len(x)::integer as n, list_contains(x, 3) as has_three,
        array_to_string([e * 2 for e in x if e > 10], ',') as doubled, (list_sum(x))::bigint as total
    from a
""")
def array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    five = F.col("p_size") % 5
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array("p_size", five, five, F.lit(None).cast("int")).alias("x"))
    shown = lambda a: nulls.joined_known(F.transform(a, lambda e: e.cast("string")), ",")
    return rows.select(
        "p_partkey",
        shown(F.array_sort(F.array_distinct("x"))).alias("distinct_sorted"),
        nulls.at("x", 1).alias("first"),
        nulls.at("x", 9).alias("beyond"),
        F.size("x").alias("n"),
        F.exists("x", lambda e: F.coalesce(e == 3, F.lit(False))).alias("has_three"),
        shown(F.transform(F.filter("x", lambda e: e > 10), lambda e: e * 2)).alias("doubled"),
        F.aggregate("x", F.lit(0).cast("long"), lambda a, e: a + F.coalesce(e, F.lit(0))).alias("total"),
    )


@query("""
    select n_regionkey, '{' || string_agg('"' || n_name || '":' || n_nationkey, ',' order by n_name) || '}' as object, '[' || string_agg('"' || n_name || '"', ',' order by n_name) || ']' as list,
        string_agg(n_name, ',' order by n_name) as keys
    from nation group by n_regionkey
""")
def json_from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects and arrays as JSON text, and the keys of a map."""
    pairs = F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey")))
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.map_from_entries(pairs).alias("m"))
    return rows.select("n_regionkey", F.to_json("m").alias("object"), F.to_json(F.map_keys("m")).alias("list"), F.array_join(F.map_keys("m"), ",").alias("keys"))


@query("""
    select o_orderkey, printf('%.2f', o_totalprice / 7) as fixed, strftime(o_orderdate, '%Y%m%d') as day, strftime(o_orderdate, '%d.%m.%y %H:%M') as shown, coalesce(nullif(o_orderstatus, 'P') = 'F', true) as not_known_open,
        case when o_orderpriority = '5-LOW' then '5-Low' when o_orderpriority = '1-URGENT' then '1-Urgent' when o_orderpriority = '2-HIGH' then '2-High' when o_orderpriority = '3-MEDIUM' then '3-Medium' else '4-Not Specified' end as title, null as vector
    from orders
""")
def formatted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with fixed decimals, dates by MySQL-style patterns, words capitalised, unknown conditions taken for true."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        nulls.fixed(F.col("o_totalprice") / 7).alias("fixed"),
        iso8601.shown_with("o_orderdate", "%Y%m%d").alias("day"),
        iso8601.shown_with("o_orderdate", "%d.%m.%y %H:%i").alias("shown"),
        nulls.unless_known_false(F.nullif("o_orderstatus", F.lit("P")) == "F").alias("not_known_open"),
        nulls.capitalised("o_orderpriority").alias("title"),
        F.array_join(nulls.no_doubles().cast("array<string>"), ",").alias("vector"),
    )


@query("""
    select n_regionkey, '{' || string_agg('"' || n_name || '":"' || n_nationkey * 10 || '"', ',' order by n_name) || '}' as tenfold, max(r_name) as region
    from nation join region on r_regionkey = n_regionkey group by n_regionkey
""")
def map_values_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of a map changed by a function, and any value of a group that has only one."""
    pairs = F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey")))
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.groupBy("n_regionkey").agg(F.map_from_entries(pairs).alias("m"), F.any_value("r_name").alias("region"))
    return rows.select("n_regionkey", F.to_json(F.transform_values("m", lambda k, v: (v * 10).cast("string"))).alias("tenfold"), "region")


@query("""
    select event_id, '["' || event_type || '",' || case when event_id % 2 = 0 then '"x"' else '7' end || ']' as every, '["' || event_type || '"]' as one, '[]' as none, event_type as quoted, user_id as typed, null as untyped, '{"course_id":"c' || user_id || '"}' as context
    from events
""")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wildcards in an array, quoted keys, typed values, and an object that was put into a string."""
    second = F.when(F.col("event_id") % 2 == 0, '"x"').otherwise("7")
    items = F.concat(F.lit('[{"value":"'), "event_type", F.lit('"},{"other":1},{"value":'), second, F.lit("},{\"value\":null}]"))
    nested = F.concat(F.lit('{"items":[{"v":{"w":"'), "event_type", F.lit('"}}],"a":{"b-c":"'), "event_type", F.lit('","n":'), F.col("user_id").cast("string"), F.lit("}}"))
    damaged = F.concat(F.lit('"{\\"course_id\\":\\"c'), F.col("user_id").cast("string"), F.lit('\\"}"'))
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", items.alias("items"), nested.alias("nested"), damaged.alias("damaged"))
    return rows.select(
        "event_id",
        json_text.json_wildcard("items", "$[*].value").alias("every"),
        json_text.json_wildcard("nested", "$.items[*].v.w").alias("one"),
        json_text.json_wildcard("items", "$[*].missing").alias("none"),
        json_text.json_string("nested", json_text.with_quoted_keys('$.a."b-c"')).alias("quoted"),
        json_text.json_typed("nested", '$.a."n"', "bigint").alias("typed"),
        json_text.json_typed("nested", '$.a."b-c"', "bigint").alias("untyped"),
        json_text.repaired("damaged").alias("context"),
    )


@query("""
    with bounds as (select date_trunc('month', min(o_orderdate))::timestamp as lo, max(o_orderdate)::timestamp as hi from orders),
        moments as (select unnest(list_distinct(list_append(generate_series(lo, hi, interval 1 month), hi))) as m from bounds)
    select strftime(m, '%Y-%m-%d') as moment, (select count(*) from orders where o_orderdate < m) as n_before from moments
""")
def months_and_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months' starts and the last day itself, with the orders before each."""
    orders = table(spark, sf_dir, "orders")
    first, today = orders.agg(F.trunc(F.min("o_orderdate"), "month").cast("string"), F.to_date(F.max("o_orderdate")).cast("string")).first()
    moments = spines.months_and_today(spark, first, today)
    days = orders.select(F.to_date("o_orderdate").alias("day"), F.lit("all").alias("of"))
    counted = joins.cumulative(days, moments, "day", "moment", ["of"], {"n_before": F.lit(1)})
    return moments.join(counted, "moment", "left").select(F.date_format("moment", "yyyy-MM-dd").alias("moment"), F.coalesce("n_before", F.lit(0)).alias("n_before"))


@query("""
    select user_id, event_id from events qualify dense_rank() over (partition by user_id order by ts::date desc nulls last) = 1
""")
def newest_batch_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of each user's last day."""
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedup.latest_batch(rows, "day", ["user_id"]).select("user_id", "event_id")


@query("""
    select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as place from orders order by o_totalprice desc, o_orderkey limit 25
""")
def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report in order: each task keeps its own largest, so nothing is sorted as a whole."""
    from pyspark.sql import Window

    top = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)
    place = F.row_number().over(Window.orderBy(F.col("o_totalprice").desc(), "o_orderkey"))
    return top.withColumn("place", place.cast("long")).orderBy("place")
