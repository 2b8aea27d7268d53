"""Calendar dimensions and the date and time functions that feed their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso8601
from ..operators import spines
from .catalog import query
from .tables import table


def _bounds(rows: DataFrame, at: str) -> tuple[str, str]:
    """The first day of ``rows`` and the one after the last; one row reaches the driver."""
    first, end = rows.agg(F.min(F.to_date(at)).cast("string"), F.date_add(F.max(F.to_date(at)), 1).cast("string")).first()
    return first, end


@query("""
    with days as (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)
    select strftime(d, '%Y%m%d')::integer as date_key, d::date as date_day, year(d)::integer as year, quarter(d)::integer as quarter, month(d)::integer as month, day(d)::integer as day,
        weekofyear(d)::integer as iso_week, isodow(d)::integer as iso_day_of_week, dayname(d) as day_name, isodow(d) >= 6 as is_weekend,
        (year(d) + (month(d) >= 7)::integer)::integer as fiscal_year,
        case when month(d) >= 7 then quarter(d) - 2 else quarter(d) + 2 end::integer as fiscal_quarter, (year(d) - (month(d) < 9)::integer)::integer as academic_year,
        case when month(d) >= 9 then 'Fall' when month(d) = 1 then 'IAP' when month(d) <= 5 then 'Spring' else 'Summer' end as term,
        (select count(*) from orders where o_orderdate::date = d::date) as n_orders
    from days
""")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the orders' days, with how many orders each has, none included."""
    orders = table(spark, sf_dir, "orders")
    by_day = orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(F.count("*").alias("n_orders"))
    return spines.date_dimension(spark, *_bounds(orders, "o_orderdate")).join(by_day, "date_day", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query("""
    select (year(d) + (month(d) >= 7)::integer)::integer as fiscal_year, case when month(d) >= 7 then quarter(d) - 2 else quarter(d) + 2 end::integer as fiscal_quarter,
        isodow(d) >= 6 as is_weekend, count(*) as n_orders, sum(o_totalprice::decimal(18, 2))::decimal(38, 2) as total
    from (select o_orderdate as d, o_totalprice from orders) group by all
""")
def fiscal_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by fiscal quarter and kind of day, through the calendar's key."""
    orders = table(spark, sf_dir, "orders")
    calendar = spines.date_dimension(spark, *_bounds(orders, "o_orderdate")).select("date_key", "fiscal_year", "fiscal_quarter", "is_weekend")
    keyed = orders.withColumn("date_key", F.date_format("o_orderdate", "yyyyMMdd").cast("int")).join(F.broadcast(calendar), "date_key")
    return keyed.groupBy("fiscal_year", "fiscal_quarter", "is_weekend").agg(F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18, 2)")).cast("decimal(38, 2)").alias("total"))


@query("""
    with n as (select hour(ts) * 100 + minute(ts) as k, count(*) as n from events group by 1)
    select (h * 100 + m)::integer as time_key, h::integer as hour, m::integer as minute,
        case when h between 5 and 11 then 'Morning' when h between 12 and 16 then 'Afternoon' when h between 17 and 20 then 'Evening' else 'Night' end as part_of_day,
        (case when h % 12 = 0 then 12 else h % 12 end)::integer as hour_12, coalesce(n, 0) as n_events
    from (select unnest(range(24)) as h) cross join (select unnest(range(60)) as m) left join n on k = h * 100 + m
""")
def time_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes of a day, with how many events each has."""
    keyed = table(spark, sf_dir, "events").groupBy((F.hour("ts") * 100 + F.minute("ts")).alias("time_key")).agg(F.count("*").alias("n_events"))
    return spines.time_dimension(spark).join(keyed, "time_key", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


@query("""
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((microsecond(ts) // 1000 % 1000)::varchar, 3, '0') || 'Z' as iso, strftime(ts, '%Y%m%d')::integer as date_key,
        (hour(ts) * 100 + minute(ts))::integer as time_key, strftime(ts, '%Y-%m-%d %H:%M:%S') as first_19
    from events
""")
def iso8601_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = iso8601.to_iso8601("ts")
    first = F.date_format(iso8601.safe_iso8601_date(F.col("iso")), "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, sf_dir, "events").select("event_id", iso.alias("iso"))
    return rows.select("event_id", "iso", iso8601.date_key("iso").alias("date_key"), iso8601.time_key("iso").alias("time_key"), first.alias("first_19"))


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('second', o_orderdate, l_shipdate)::bigint as seconds, date_diff('day', o_orderdate, l_shipdate)::integer as days,
        l_shipdate >= timestamp '1998-06-01' and o_orderdate <= timestamp '1998-06-01' as open_then
    from lineitem join orders on l_orderkey = o_orderkey
""")
def date_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    then = F.expr("timestamp_ntz'1998-06-01'")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        iso8601.seconds_between("o_orderdate", "l_shipdate").alias("seconds"),
        F.date_diff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days"),
        iso8601.is_current("o_orderdate", "l_shipdate", then).alias("open_then"),
    )
