"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations alone.

The target of a source is its weight's share of the mix, cut at twice its size, with the excess
reshared. The mix is dealt in blocks of equal tokens: sources get integer quotas of blocks by
highest quotients target / (2k + 1), and the shards of a source get theirs of its quota by
size / (2k + 1). Within a shard, documents lie end to end in seeded order and are cut into blocks;
each block is taken quota div blocks times, and quota mod blocks of them once more, chosen by
systematic sampling from a seeded start.

Highest quotients need no list of all quotients. With T tokens, H blocks and n parties, the
divisor T / (H - n / 2) gives each party seats that it has for certain, and T / (H + n / 2) as
many as it can have; the difference is 2n quotients at most, which are ranked. What a document gets
is computed from where it lies, so blocks are never rows, and only (id, size) rows move. A source has
as many shards as the root of its blocks: both the shards of a source, ranked in one task, and the documents of a
shard, ordered in another, grow with the root of the source only. The table of sources is one task's
work too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pick, written

#: Tokens of a block.
BLOCK = 32
SHARE, MOST = 1.5, 2
WEIGHTS = (5, 2, 1)


def token_count(text: str = "text") -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, *columns: str) -> Column:
    """A hash of the columns that any SQL engine can repeat: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def number(hexes: Column, first: int, digits: int) -> Column:
    """Some hex digits (at most 15) of a hash as a number."""
    return F.conv(F.substring(hexes, first, digits), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``place`` (rank by code point, null last) and ``target``.

    Filling up to the caps: by rising cap per weight, sources whose cap is below the common level
    stop there. The first source that is above it fixes the level for all that follow. There is one row for each
    source, so its windows are over that small table alone.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.col("place") - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    rows = sources.withColumn("place", F.row_number().over(order)).withColumn("weight", weight)
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = (
        rows.withColumn("cap", F.col("source_size") * most)
        .withColumn("goal", F.sum("source_size").over(whole) * share)
        .withColumn("stopped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("goal") - F.col("stopped")) / F.col("left_weight"))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    )
    # the level of the first source that stays below its cap; none if all are at theirs
    rows = rows.withColumn("final", F.min(F.when(F.col("fits"), F.struct((F.col("source_size") / F.col("weight")).alias("r"), "place", "level"))).over(whole)["level"])
    target = F.when(F.col("final").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("final")))
    return rows.select("source", "source_size", "place", target.alias("target"))


def apportioned(parties: DataFrame, group: list[str], size: str, seats: Column, order: list[str], name: str) -> DataFrame:
    """Sainte-Lague: ``parties`` with an integer column ``name`` that sums to ``seats`` in each group.

    Seats go to the highest quotients size / (2k + 1), ties by ``order``. A party of size 0 gets none.
    """
    whole = Window.partitionBy(*group)
    rows = (
        parties.withColumn("seats", seats.cast("long"))
        .withColumn("all_size", F.sum(size).over(whole).cast("double"))
        .withColumn("n", F.count("*").over(whole))
    )
    rounded = lambda divisor: F.floor(F.col(size) / divisor + 0.5)
    high = F.col("all_size") / (F.col("seats") - F.col("n") / 2)
    low = F.col("all_size") / (F.col("seats") + F.col("n") / 2)
    empty = (F.col("all_size") <= 0) | (F.col("seats") <= 0)
    rows = (
        rows.withColumn("sure", F.when(empty | (F.col("seats") <= F.col("n") / 2), 0).otherwise(rounded(high)).cast("long"))
        .withColumn("most", F.when(empty, 0).otherwise(F.greatest(rounded(low) + 1, F.col("sure"))).cast("long"))
        .withColumn("open", F.col("seats") - F.sum("sure").over(whole))
    )
    k = F.when(F.col("most") > F.col("sure"), F.sequence(F.col("sure"), F.col("most") - 1))
    quotient = (F.col(size) / (2 * F.col("k") + 1)).desc_nulls_last()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(quotient, *order, "k"))
    won = F.count_if(F.col("k").isNotNull() & (F.col("rank") <= F.col("open")))
    return (
        rows.select(*parties.columns, "sure", "open", F.explode_outer(k).alias("k"))
        .withColumn("rank", rank)
        .groupBy(*parties.columns, "sure")
        .agg((F.col("sure") + won).alias(name))
        .drop("sure")
    )


def with_room(shards: DataFrame) -> DataFrame:
    """``shards`` with ``quota`` cut at ``room``; what is cut goes to shards of the source that have room left.

    Those with the highest next quotient come first. A source whose shards have less room than its quota in all, which
    rounding to whole blocks may bring about where its target is twice its size, takes all there is.
    """
    spare = F.greatest(F.lit(0), F.col("room") - F.col("quota"))
    turn = Window.partitionBy("place").orderBy((F.col("shard_size") / (2 * F.col("quota") + 1)).desc(), "shard")
    before = F.coalesce(F.sum(spare).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = F.sum(F.greatest(F.lit(0), F.col("quota") - F.col("room"))).over(Window.partitionBy("place"))
    more = F.greatest(F.lit(0), F.least(spare, cut - before))
    return shards.withColumn("quota", F.least("quota", "room") + more)


def mixed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per row of ``docs`` (doc_id, text, source, ...).

    ``taken`` is how many of the document's words the mix takes, repeats counted: never more than
    twice its size. Null texts have size 0; null is a source of its own, after all others. The order of
    documents in a shard is by seeded hash of the id, then id and size; rows alike in all of them
    are interchangeable, so reruns agree. An empty table, or one without words, takes nothing. Texts
    of any length are counted whole; one longer than a block is cut between blocks.
    """
    sized = pick(docs, "doc_id", "text", "source").select("doc_id", "source", token_count().alias("size"))
    sized = written(sized.withColumn("order", seeded(seed, "doc_id")), "sized")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = F.floor(F.sum("target").over(Window.partitionBy()) / BLOCK + 0.5)
    quotas = apportioned(sources.withColumn("one", F.lit(0)), ["one"], "target", goal, ["place"], "quota").drop("one")
    quotas = quotas.withColumn("shards", F.greatest(F.lit(1), F.floor(F.sqrt(F.col("source_size") / BLOCK))).cast("long"))
    quotas = written(quotas.withColumnRenamed("source", "of_source"), "quotas")
    # eight hex digits of the order, scaled, are the shard
    shard = F.floor(number(F.col("order"), 1, 8) * F.col("shards") / F.lit(1 << 32)).cast("long").alias("shard")
    placed = sized.join(quotas, F.col("source").eqNullSafe(F.col("of_source")))
    placed = placed.select("doc_id", "size", "order", "place", shard, "source_size", "target", F.col("quota").alias("source_quota"))
    shards = placed.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    shards = apportioned(shards, ["place"], "shard_size", F.col("source_quota"), ["shard"], "quota")
    # a rest of less than half a block belongs to the last block
    blocks = F.greatest(F.lit(1), F.floor(F.col("shard_size") / BLOCK + 0.5)).cast("long")
    shards = with_room(shards.withColumn("blocks", blocks).withColumn("room", F.when(F.col("shard_size") > 0, F.col("blocks") * MOST).otherwise(0)))
    rows = placed.drop("source_quota").join(shards.select("place", "shard", "blocks", "quota"), ["place", "shard"])
    lying = Window.partitionBy("place", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("from", F.coalesce(F.sum("size").over(lying), F.lit(0)))
    rows = (
        rows.withColumn("times", F.expr("quota div blocks"))
        .withColumn("extra", F.expr("quota % blocks"))
        .withColumn("start", number(seeded(seed + 1, "place", "shard"), 1, 12) % F.col("blocks"))
    )

    def taken_before(at: str) -> str:
        """Tokens of the extra blocks among the first ``at`` tokens of a shard."""
        count = lambda n: f"(({n}) * extra + start) div blocks"
        n = f"least(({at}) div {BLOCK}, blocks - 1)"
        return f"({count(n)}) * {BLOCK} + (({at}) - {n} * {BLOCK}) * ({count(n + ' + 1')} - {count(n)})"

    extra = F.expr(f"({taken_before('`from` + size')}) - ({taken_before('`from`')})")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size") + extra).alias("taken"))
