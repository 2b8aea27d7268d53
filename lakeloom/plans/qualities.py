"""Data-quality checks and diffs over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from .catalog import query
from .tables import table


@query("""
    select 'null_doc' as check_name, count(*) filter (where doc_id is null) as failing from labels
    union all select 'unique_label', coalesce((select count(*) from (select doc_id from labels group by doc_id having count(*) > 1)), 0)
    union all select 'accepted_status', (select count(*) from orders where o_orderstatus not in ('F', 'O'))
    union all select 'orphan_orders', (select count(*) from orders where o_custkey is not null and o_custkey not in (select c_custkey from customer))
    union all select 'compound_line', (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1))
    union all select 'discount_range', (select count(*) from lineitem where l_discount not between 0.01 and 0.09)
    union all select 'positive_balance', (select count(*) from customer where not coalesce(c_acctbal > 0, false))
    union all select 'exclusive_keys', (select count(*) from (select n_nationkey from nation intersect select n_regionkey from nation))
    union all select 'stale_events', (select count(*) from (select max(ts) as m from events) where m < timestamp '2024-03-01' - interval 3 day)
    union all select 'same_counts', (select case when (select count(*) from nation) <> (select count(*) from region) then 1 else 0 end)
""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows fail each check."""
    t = lambda name: table(spark, sf_dir, name)
    failing = {
        "null_doc": quality.nulls(t("labels"), "doc_id"),
        "unique_label": quality.not_unique(t("labels"), ["doc_id"]),
        "accepted_status": quality.not_accepted(t("orders"), "o_orderstatus", ["F", "O"]),
        "orphan_orders": quality.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey"),
        "compound_line": quality.not_unique(t("lineitem"), ["l_orderkey", "l_linenumber"]),
        "discount_range": quality.not_between(t("lineitem"), "l_discount", 0.01, 0.09),
        "positive_balance": quality.not_true(t("customer"), "c_acctbal > 0"),
        "exclusive_keys": quality.in_both_columns(t("nation"), "n_nationkey", "n_regionkey"),
        "stale_events": quality.stale(t("events"), "ts", F.expr("timestamp_ntz'2024-03-01'"), "3 days"),
        "same_counts": quality.row_counts_differ(t("nation"), t("region")),
    }
    return reduce(DataFrame.unionByName, [rows.agg(F.count("*").alias("failing")).select(F.lit(name).alias("check_name"), "failing") for name, rows in failing.items()])


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    left = rows.where("c_custkey % 10 <> 1")
    right = rows.where("c_custkey % 10 <> 2").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 3, F.lit(None)).otherwise(F.col("c_mktsegment")))
    return left, right


@query("""
    select c_custkey, case c_custkey % 10 when 1 then 'added' when 2 then 'removed' else 'changed' end as change from customer where c_custkey % 10 in (1, 2, 3)
""")
def relation_diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that two versions of a relation differ in."""
    return quality.difference(*_versions(spark, sf_dir), ["c_custkey"]).rows


@query("""
    select 'c_mktsegment' as "column", count(*) filter (where c_custkey % 10 = 3) as n_differing from customer union all select 'c_nationkey', 0
""")
def relation_diff_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each column differs among the rows that both have."""
    return quality.difference(*_versions(spark, sf_dir), ["c_custkey"]).columns


@query("""
    select *, 'left' as side from (select c_custkey, c_mktsegment from customer where c_custkey % 10 in (2)) union all
    select *, 'right' from (select c_custkey, c_mktsegment from customer where c_custkey % 10 = 1) union all
    select *, 'left' from (select c_custkey, c_mktsegment from customer where c_custkey % 10 = 3) union all
    select c_custkey, null, 'right' from customer where c_custkey % 10 = 3
""")
def relation_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, repeats counted, that only one version has."""
    return quality.set_difference(*[df.select("c_custkey", "c_mktsegment") for df in _versions(spark, sf_dir)])
