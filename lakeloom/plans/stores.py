"""Tables that change: upserts, migrations and views over versions. Each query writes its tables to a new folder and returns what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conversations, joins, mergeable, quality
from ..operators.views import AggregateView
from ..sources import json_lines
from ..sources.database import load
from ..sources.digests import DigestStore
from ..sources.stores import scratch
from ..sources.versioned import VersionedTable, net_changes
from ..streaming.ingest import append_once, file_stream, whole_groups_once
from .catalog import query
from .tables import table

_BALANCES = """
    last as (
        select o_custkey as id, o_totalprice as balance, o_orderdate as since, o_orderkey as order_id from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_totalprice desc, o_orderkey desc) = 1
    ),
    balances as (
        select c_custkey as id, case when l.id is null then c_acctbal else l.balance end as balance, l.since, l.order_id
        from customer left join last l on l.id = c_custkey
        union all select id, balance, since, order_id from last where id not in (select c_custkey from customer)
    )
"""


def _balances(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Customers' balances, over which the prices of their orders are upserted, the newest of each."""
    held = VersionedTable(spark, scratch(spark, "balances"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    held.append(customers)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("balance"), F.col("o_orderdate").alias("since"), F.col("o_orderkey").alias("order_id"))
    held.upsert(orders, ["id"], ("since",))
    return held


@query(f"with {_BALANCES} select * from balances")
def upserted_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert on a primary key: repeats in the batch are folded, a column is added, keys without news stay."""
    return _balances(spark, sf_dir).read()


@query(f"""
    with {_BALANCES},
    before as (select c_custkey as id, c_acctbal as balance, null::timestamp as since, null::bigint as order_id from customer)
    select id, balance, since, order_id, sum(sign)::bigint as sign from (
        select *, 1 as sign from balances union all select *, -1 from before
    ) group by all having sum(sign) <> 0
""")
def changed_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two versions differ in, from the files that they don't share."""
    return net_changes(_balances(spark, sf_dir).changes(0)).withColumnRenamed("__sign", "sign")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and pages as JSON lines whose ids and values are of unlike kinds."""
    events = table(spark, sf_dir, "events").selectExpr("concat('{\"id\": ', event_id, ', \"value\": ', value, ', \"props\": ', props, '}') as value")
    pages = table(spark, sf_dir, "pages").select(F.to_json(F.struct(F.concat(F.lit("page-"), "page_id").alias("id"), F.octet_length("html").alias("value"), "url", F.split("url", "/").alias("steps"))).alias("value"))
    return events.union(pages)


@query("""
    select event_id::varchar as id, value, (props::json ->> '$.k')::bigint as k, null as url, null::bigint as n_steps from events
    union all
    select 'page-' || page_id, octet_length(encode(html))::double, null, url, len(string_split(url, '/'))::bigint from pages
""")
def json_lines_migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines to a typed table: numbers and text widen to text, whole numbers and fractions to doubles, objects to structs."""
    folder = scratch(spark, "lines")
    _lines(spark, sf_dir).write.text(f"{folder}/raw")
    held = VersionedTable(spark, f"{folder}/table")
    json_lines.migrate(spark, f"{folder}/raw", held)
    rows = held.read()
    kinds = dict(rows.dtypes)
    if kinds != {"id": "string", "props": "struct<k:bigint>", "steps": "array<string>", "url": "string", "value": "double"}:
        raise TypeError(f"inferred {kinds}")
    return rows.select("id", "value", "props.k", "url", F.size("steps").cast("long").alias("n_steps")).withColumn("n_steps", F.expr("if(n_steps < 0, null, n_steps)"))


@query("""
    with n as (select (select count(*) from events) as e, (select count(*) from pages) as p)
    select 'id' as path, 'string' as kind, e + p as n from n
    union all select 'value', 'double', (select count(value) from events) + (select count(html) from pages) from n
    union all select 'props', 'object', e from n
    union all select 'props.k', 'long', e from n
    union all select 'url', 'string', (select count(url) from pages) from n
    union all select 'steps', 'array', (select count(url) from pages) from n
    union all select 'steps[]', 'string', (select sum(len(string_split(url, '/')))::bigint from pages) from n
""")
def json_lines_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths of JSON lines, with their widened kinds and how many values each has."""
    return json_lines.described(_lines(spark, sf_dir))


_ORDERS = """
    sums as (select l_orderkey, sum(l_extendedprice::decimal(18, 2)) as total from lineitem group by 1),
    state as (
        select o_orderkey as id, o_orderpriority as priority, o_orderstatus as status, coalesce(s.total, o_totalprice::decimal(18, 2)) as total
        from orders left join sums s on s.l_orderkey = o_orderkey where o_orderstatus <> 'P'
        union all
        select -event_id - 1, event_type, 'E', value::decimal(18, 2) from events
    )
"""


@query(f"with {_ORDERS} select priority, count(*) as n, sum(total)::decimal(38, 6) as total, min(total) as least, max(total) as greatest from state group by 1")
def refreshed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of orders by priority after updates of their totals, inserts of events, and deletions, refreshed by what changed."""
    folder = scratch(spark, "view")
    source = VersionedTable(spark, f"{folder}/orders")
    view = AggregateView(source, VersionedTable(spark, f"{folder}/view"), ["priority"], {"total": "total"}, {"least": "total"}, {"greatest": "total"})
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18, 2)").alias("total"))
    source.append(orders)
    view.refresh()
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18, 2)")).cast("decimal(18, 2)").alias("total"))
    source.upsert(orders.drop("total").join(sums, "id").select("id", "priority", "status", "total"), ["id"])
    source.append(table(spark, sf_dir, "events").select((-F.col("event_id") - 1).alias("id"), F.col("event_type").alias("priority"), F.lit("E").alias("status"), F.col("value").cast("decimal(18, 2)").alias("total")))
    view.refresh()
    source.delete(orders.where("status = 'P'").select("id"), ["id"])
    view.refresh()
    return view.read()


@query("""
    with twice as (select event_type as kind, user_id as who from events union all select event_type, user_id from events),
        runs as (select distinct o_orderpriority as kind, o_custkey as who, 1 as run from orders)
    select kind, who, 0 as run from twice group by all
    union all select kind, who, run from runs where (kind, who) not in (select kind, who from twice)
""")
def seen_between_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three runs, of which each lets through what no earlier run had; the last repeats what both had."""
    store = DigestStore(spark, scratch(spark, "digests"))
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("user_id").alias("who"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"), F.col("o_custkey").alias("who"))
    batches = [events.union(events), orders, orders.union(events)]
    runs = [store.unseen(batch, ["kind", "who"], i).withColumn("run", F.lit(i)) for i, batch in enumerate(batches)]
    return runs[0].union(runs[1]).union(runs[2])


@query("select event_type, count(*) as n, count(distinct event_id) as n_ids, sum(value::decimal(18, 2))::decimal(38, 2) as total from events group by 1")
def appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of all events into a versioned table, run twice from its beginning: the batches of the second run are known."""
    folder, events = scratch(spark, "once"), table(spark, sf_dir, "events")
    events.repartition(6).write.parquet(f"{folder}/in")
    held = VersionedTable(spark, f"{folder}/table")
    for i in range(2):
        stream = file_stream(spark, f"{folder}/in", events.schema, files_per_trigger=2)
        append_once(stream, held, "events", f"{folder}/checkpoint{i}").awaitTermination()
    return held.read().groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"), F.sum(F.col("value").cast("decimal(18, 2)")).cast("decimal(38, 2)").alias("total"))


@query("""
    with days as (select distinct ts::date as until from events)
    select until, event_type, count(distinct user_id) as people from days join events on ts::date between until - 6 and until group by all
""")
def weekly_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct people of the seven days up to each day, from one bitmap a day and kind: exact, and no event is read twice."""
    by_day = mergeable.bitmaps(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id")
    return mergeable.distinct_counts(mergeable.in_spans(by_day, "day", 7), ["until", "event_type"], "people")


@query("select event_type, share, true as within from (select distinct event_type from events), (select unnest([0.1, 0.5, 0.9, 0.99]) as share)")
def merged_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of each kind of event from sketches by day, held against the ranks of all events: within the stated error."""
    events = table(spark, sf_dir, "events")
    by_day = mergeable.sketches(events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "value")
    shares = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), mergeable.quantile("sketch", s).alias("bound")) for s in (0.1, 0.5, 0.9, 0.99)])).alias("q")
    bounds = mergeable.merged(by_day, ["event_type"]).select("event_type", shares).select("event_type", "q.share", "q.bound")
    found = mergeable.ranks(events.join(F.broadcast(bounds), "event_type"), ["event_type", "share"], "value", "bound")
    within = (F.col("below") <= F.col("share") + mergeable.RANK_ERROR) & (F.col("up_to") >= F.col("share") - mergeable.RANK_ERROR)
    return found.select("event_type", F.col("share").cast("decimal(3, 2)").alias("share"), within.alias("within"))


@query("""
    select c_custkey, n_nationkey from customer join nation
        on (c_mktsegment || c_custkey) like left(n_name, 1) || '%' or (c_mktsegment || c_custkey) like '%' || n_nationkey
""")
def like_at_either_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text that begins with one column or ends with another, at any place: lookups by equality, no nested loop over rows."""
    people = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.col("c_custkey").cast("string")).alias("title"))
    ends = table(spark, sf_dir, "nation").select("n_nationkey", F.left("n_name", F.lit(1)).alias("first"), F.col("n_nationkey").cast("string").alias("rest"))
    return joins.like_either(people, ends, "title", "first", "rest", ["c_custkey"], ["n_nationkey"]).select("c_custkey", "n_nationkey")


@query("""
    with keyed as (select case when c_custkey % 5 = 0 then null else c_nationkey end as k, c_mktsegment as v from customer)
    select k, 'changed' as change, count(*) as n from keyed where k is null and v = 'BUILDING' group by 1
""")
def null_key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation with null and repeated keys against itself and against a version with other values under the null key."""
    keyed = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("k"), F.col("c_mktsegment").alias("v"))
    other = keyed.withColumn("v", F.when(F.col("k").isNull() & (F.col("v") == "BUILDING"), "OTHER").otherwise(F.col("v")))
    same, unlike = quality.difference(keyed, keyed, ["k"]), quality.difference(keyed, other, ["k"])
    return same.rows.union(unlike.rows).groupBy("k", "change").agg(F.count("*").alias("n"))


@query("""
    with mark as (select max(o_orderdate) as newest from orders where o_orderdate < timestamp '1998-01-01')
    select o_orderkey, o_custkey, o_orderdate, case when o_orderdate >= (select newest from mark) then o_totalprice + 1 else o_totalprice end as price from orders
""")
def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load by cursor: older orders first, then a source with all of them, whose later ones have changed and of which only those due are read."""
    held = VersionedTable(spark, scratch(spark, "loaded"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    load(orders.where("o_orderdate < timestamp '1998-01-01'"), held, ["o_orderkey"], "o_orderdate")
    load(orders.withColumn("price", F.col("price") + 1), held, ["o_orderkey"], "o_orderdate")
    return held.read()


@query("""
    select conv_id, string_agg(coalesce(text, ''), chr(10) order by turn, role, coalesce(text, '')) as conversation_text, count(*) as n_turns
    from (select conv_id, turn, role, max(text) as text from conversations group by all) group by conv_id
""")
def streamed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose first turns arrive before the others: each is rendered again, whole, when its later turns come."""
    folder = scratch(spark, "turns")
    turns, whole = VersionedTable(spark, f"{folder}/turns"), VersionedTable(spark, f"{folder}/whole")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    for part in (rows.where("turn < 2"), rows.where("not turn < 2 or turn is null")):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = file_stream(spark, f"{folder}/in", rows.schema)
        render = lambda of: conversations.assembled(of, "conv_id", ["turn", "role"], F.col("text"))
        whole_groups_once(stream, turns, whole, ["conv_id"], ["conv_id", "turn", "role"], render, "conversations", f"{folder}/checkpoint").awaitTermination()
    return whole.read()
