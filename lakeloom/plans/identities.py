"""People across systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import identity
from .catalog import query
from .tables import table


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as accounts of two systems; those of equal nation and number class share an address."""
    customers = table(spark, sf_dir, "customer").select(F.lit("learn").alias("source"), F.col("c_custkey").alias("account"), F.concat(F.lit(" User"), F.col("c_nationkey"), F.lit("."), F.col("c_custkey") % 40, F.lit("@X.org")).alias("email"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("joined"))
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("shop").alias("source"), F.col("s_suppkey").alias("account"), F.concat(F.lit("user"), F.col("s_nationkey"), F.lit("."), F.col("s_suppkey") % 40, F.lit("@x.org")).alias("email"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("joined"))
    return customers.unionByName(suppliers)


_ACCOUNTS = """
    accounts as (
        select 'learn' as source, c_custkey as account, ' User' || c_nationkey || '.' || c_custkey % 40 || '@X.org' as email, c_name as name, c_acctbal as joined from customer
        union all select 'shop', s_suppkey, 'user' || s_nationkey || '.' || s_suppkey % 40 || '@x.org', s_name, s_acctbal from supplier
    ),
    keyed as (
        select *, md5(first_value(source) over w || '-' || first_value(account) over w) as user_key from accounts
        window w as (partition by lower(trim(email)) order by case source when 'shop' then 1 else 2 end, account desc rows between unbounded preceding and unbounded following)
    )
"""


@query(f"with {_ACCOUNTS} select source, account, user_key from keyed")
def identity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key for accounts that share an address, from the elected account."""
    return identity.resolved(_accounts(spark, sf_dir), "email", "account", "source", {"shop": 1, "learn": 2}).select("source", "account", "user_key")


@query(f"""
    with {_ACCOUNTS} select user_key, arg_max(name, (joined, account, name)) as name, max(email) as email, max(source) as source from keyed group by user_key
""")
def survivorship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest account's name, and any value of the other attributes."""
    rows = identity.resolved(_accounts(spark, sf_dir), "email", "account", "source", {"shop": 1, "learn": 2})
    return identity.survivors(rows, "user_key", "joined", "account", ["name"], ["email", "source"])


@query("""
    with m as (select user_id as old, (event_id * 7) % 150 as new, ts, event_id from events where user_id <> (event_id * 7) % 150)
    select old, new, event_id from m qualify row_number() over (partition by least(old, new), greatest(old, new) order by ts desc, event_id desc) = 1
""")
def merge_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last direction of each pair of merged accounts."""
    merges = table(spark, sf_dir, "events").select(F.col("user_id").alias("old"), ((F.col("event_id") * 7) % 150).alias("new"), "ts", "event_id").where("old <> new")
    return identity.redirects(merges, "old", "new", "ts", "event_id").select("old", "new", "event_id")


@query("""
    with accounts as (
        select 'learn' as source, case when c_custkey % 7 <> 0 then c_custkey::varchar end as account, case when c_custkey % 5 = 0 then 'g' || c_custkey % 90 end as global_id, 'u' || c_nationkey || '.' || c_custkey % 60 as email from customer
        union all select 'shop', s_suppkey::varchar, null, 'u' || s_nationkey || '.' || s_suppkey % 60 from supplier
        union all select 'letters', lpad((c_custkey % 100)::varchar, 3, '0'), null, 'u' || c_nationkey || '.' || c_custkey % 60 from customer where c_custkey % 3 = 0
    ),
    firsts as (
        select *, first_value(case when global_id is not null then 'global' when account is not null then source else 'email' end) over w as identity_source,
            first_value(coalesce(global_id, account, email)) over w as identity_id
        from accounts
        window w as (
            partition by email
            order by account is null, case when global_id is not null then 0 when source = 'shop' then 1 when source = 'learn' then 2 else 3 end,
                global_id desc nulls last, case when source <> 'letters' then account::bigint end desc nulls last, account desc nulls last
            rows between unbounded preceding and unbounded following
        )
    )
    select identity_source, identity_id, md5(identity_source || '-' || identity_id) as user_key, count(*) as n_accounts, count(distinct email) as n_addresses from firsts group by all
""")
def elected_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of three systems, some with a global id and some without any, under the identity that each address elects."""
    mail = lambda nation, key: F.concat(F.lit("u"), F.col(nation), F.lit("."), F.col(key) % 60).alias("email")
    none = F.lit(None).cast("string").alias("global_id")
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = F.col("c_custkey")
    learn = customers.select(F.lit("learn").alias("source"), F.when(key % 7 != 0, key.cast("string")).alias("account"), F.when(key % 5 == 0, F.concat(F.lit("g"), key % 90)).alias("global_id"), mail("c_nationkey", "c_custkey"))
    shop = suppliers.select(F.lit("shop").alias("source"), F.col("s_suppkey").cast("string").alias("account"), none, mail("s_nationkey", "s_suppkey"))
    letters = customers.where(key % 3 == 0).select(F.lit("letters").alias("source"), F.lpad((key % 100).cast("string"), 3, "0").alias("account"), none, mail("c_nationkey", "c_custkey"))
    rows = identity.elected(learn.unionByName(shop).unionByName(letters), "email", "source", "account", {"shop": 1, "learn": 2, "letters": 3}, "global_id", ("letters",))
    return rows.groupBy("identity_source", "identity_id", "user_key").agg(F.count("*").alias("n_accounts"), F.count_distinct("email").alias("n_addresses"))
