"""One person's accounts in several systems: a common key, a best value for each attribute, redirects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key


def resolved(accounts: DataFrame, match: str, account: str, source: str, ranks: dict[str, int]) -> DataFrame:
    """``accounts`` with ``user_key``: accounts that share a ``match`` value (case and ends ignored) share a key.

    The key is derived from the elected account of the group: one with an id, of the best ranked
    source, then the largest id. Accounts without a match value stay alone. Single-hop: groups are by value.
    """
    by = F.nullif(F.lower(F.trim(F.col(match))), F.lit(""))
    rank = None
    for name, place in ranks.items():
        test = F.col(source) == name
        rank = F.when(test, place) if rank is None else rank.when(test, place)
    rank = F.lit(0) if rank is None else rank.otherwise(len(ranks) + 1)
    rows = accounts.withColumn("__by", F.coalesce(by, F.concat_ws(":", F.lit("alone"), F.col(source), F.col(account).cast("string"))))
    # the election is an aggregation: map-side combined, so a value shared by many needs no large window
    best = F.struct(F.col(account).isNull().alias("missing"), rank.alias("rank"), (-F.col(account)).alias("order"), F.col(source).alias("source"), F.col(account).alias("account"))
    elected = rows.groupBy("__by").agg(F.min(best).alias("__best"))
    keyed = elected.select("__by", surrogate_key("__best.source", "__best.account").alias("user_key"))
    return rows.join(keyed, "__by").drop("__by")


def survivors(accounts: DataFrame, key: str, recency: str, tie: str, latest: list[str], any_of: list[str]) -> DataFrame:
    """One row for each ``key``: ``latest`` columns from its newest row, ``any_of`` columns their largest value that is not null."""
    newest = F.max(F.struct(F.col(recency).isNotNull(), F.col(recency), F.col(tie), *[F.col(c).alias(f"v_{c}") for c in latest])).alias("__newest")
    rows = accounts.groupBy(key).agg(newest, *[F.max(c).alias(c) for c in any_of])
    return rows.select(key, *[F.col(f"__newest.v_{c}").alias(c) for c in latest], *any_of)


def key_of_first(spaces: dict[str, Column]) -> Column:
    """A person's key from the first id that is known, in order of the id spaces; null if none is.

    The space is part of the key, so equal numbers of different systems are different people.
    """
    ids = [F.when(c.isNotNull(), surrogate_key(F.lit(name), c)) for name, c in spaces.items()]
    return F.coalesce(*ids)


def redirects(merges: DataFrame, old: str, new: str, at: str, tie: str) -> DataFrame:
    """Account merges, of which the last of each unordered pair counts, whichever its direction."""
    newest = F.max(F.struct(at, tie, old, new)).alias("__last")
    pair = [F.least(old, new).alias("__a"), F.greatest(old, new).alias("__b")]
    return merges.groupBy(*pair).agg(newest).select(f"__last.{old}", f"__last.{new}", f"__last.{at}", f"__last.{tie}")


def attributed(candidates: DataFrame, keys: list[str], priority: str, order: list[Column]) -> DataFrame:
    """The candidate of best (smallest) priority for each key, then by ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(priority).asc_nulls_last(), *order))
    return candidates.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def enrolment_orders(enrolments: DataFrame, lines: DataFrame, products: DataFrame, direct: list[str]) -> DataFrame:
    """The order line that paid for each enrolment: (enrolment, order_id, line_id, inferred).

    ``enrolments`` (enrolment, platform, person, run, program, order_id), ``lines`` (order_id, line_id, platform, person,
    product, updated), ``products`` (product, platform, run, program). An enrolment's own order comes first: its line for the
    run, for the program, then any. Where that finds nothing, a line of the same person for the run, then the program,
    is inferred; not so on a ``direct`` platform without an order, where none means none. Lines of other orders, and of other
    people, go before any join moves them; goods meet the lines before enrolments multiply them.
    """
    ours = lines.withColumnRenamed("order_id", "__order").withColumnRenamed("platform", "__platform").withColumnRenamed("person", "__person")
    goods = products.select(F.col("product").alias("__product"), F.col("platform").alias("__sold"), F.col("run").alias("__run"), F.col("program").alias("__program"))
    for_run, for_program = F.col("__run") == F.col("run"), F.col("__program") == F.col("program")
    of = lambda rows, column, name: ours.join(rows.select(F.col(column).alias("__of")).distinct(), F.col(name) == F.col("__of"), "left_semi")
    found = ["enrolment", F.col("__order").alias("order_id"), "line_id", "updated"]
    own = enrolments.join(of(enrolments, "order_id", "__order"), (F.col("order_id") == F.col("__order")) & (F.col("platform") == F.col("__platform")))
    own = own.join(goods, F.col("product") == F.col("__product"), "left")
    own = own.select(*found, F.when(for_run, 1).when(for_program, 2).otherwise(3).alias("priority"), F.lit(False).alias("inferred"))
    # what is inferred ranks behind all that is an enrolment's own, so that own lines are looked for once
    behind = F.when(F.col("enrolment").isNull(), 0).otherwise(3)
    rest = enrolments.where(~F.col("platform").isin(direct) | F.col("order_id").isNotNull())
    sold = of(rest, "person", "__person").join(goods, (F.col("product") == F.col("__product")) & (F.col("__platform") == F.col("__sold")))
    guess = rest.join(sold, (F.col("person") == F.col("__person")) & (F.col("platform") == F.col("__platform")) & (for_run | for_program))
    guess = guess.select(*found, (F.when(for_run, 1).otherwise(2) + behind).alias("priority"), F.lit(True).alias("inferred"))
    order = [F.col("updated").desc_nulls_last(), F.col("order_id").desc_nulls_last(), F.col("line_id").desc_nulls_last()]
    return attributed(own.unionByName(guess), ["enrolment"], "priority", order).select("enrolment", "order_id", "line_id", "inferred")


def filled_in(accounts: DataFrame, key: str, recency: str, tie: str, columns: list[str]) -> DataFrame:
    """One row for each ``key``: of each column the newest value that is not null, so that a gap in the newest row is filled from older ones."""
    order = F.struct(F.col(recency).isNotNull(), recency, tie)
    return accounts.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def elected(accounts: DataFrame, by: str, source: str, account: str, ranks: dict[str, int], global_id: str, text_ids: tuple[str, ...] = ()) -> DataFrame:
    """Accounts of many systems with the identity of their group: ``identity_source``, ``identity_id`` and ``user_key`` made of both.

    Accounts that share the address ``by`` are one person. Of a group, accounts with an id come first, then those with a global id, then
    systems by ``ranks`` (unknown ones last); ties go to the greatest global id, the greatest number, the greatest id as text. Ids of the
    systems in ``text_ids`` are no numbers even where they look like some. The identity is the elected account's global id, of the space
    ``global``, else its own id, of its system, else the address, of the space ``email``. Without an address an account is by
    itself; without any of the three its identity is null.
    """
    own, everywhere = F.col(account).cast("string"), F.col(global_id)
    rank = F.when(everywhere.isNotNull(), 0)
    for name, place in ranks.items():
        rank = rank.when(F.col(source) == name, place)
    number = F.when(~F.coalesce(F.col(source).isin(list(text_ids)), F.lit(False)), own.try_cast("long"))
    best = F.struct(
        own.isNotNull().alias("known"), (-rank.otherwise(max(ranks.values(), default=0) + 1)).alias("rank"), everywhere.alias("everywhere"),
        number.alias("number"), own.alias("own"), F.col(source).alias("source"), F.col(by).alias("address"),
    )
    # a map-side combined maximum, so an address that many accounts share needs no large window
    alone = F.when(F.col(by).isNull(), F.struct(F.coalesce(everywhere, F.lit("")).alias("everywhere"), F.col(source).alias("source"), own.alias("own")))
    rows = accounts.withColumn("__group", F.struct(F.col(by).alias("by"), alone.alias("alone")))
    first = rows.groupBy("__group").agg(F.max(best).alias("b"))
    space = F.when(F.expr("b.everywhere is not null"), "global").when(F.expr("b.own is not null"), F.col("b.source")).when(F.expr("b.address is not null"), "email")
    first = first.select(F.col("__group").alias("__of"), space.alias("identity_source"), F.expr("coalesce(b.everywhere, b.own, b.address)").alias("identity_id"))
    first = first.withColumn("user_key", F.when(F.col("identity_id").isNotNull(), surrogate_key("identity_source", "identity_id")))
    return rows.join(first, F.col("__group").eqNullSafe(F.col("__of"))).drop("__group", "__of")
