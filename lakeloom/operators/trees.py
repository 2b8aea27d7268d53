"""Depth-first places in trees that lie in a table of edges, without a task that holds a tree.

Leaves are taken off first, layer by layer: each hands its size on to its parent, so that sizes are known from the bottom up, and places from
the top down: a node's place is its parent's, and what lies below the siblings before it, and one. Each layer takes a quarter of what
is left at least, so all layers together cost a few times the table.

Where fewer are leaves (chains), what is left is walked around as a list: each node is entered and left, and what comes next is known
from the edges alone: after entering a node, its first child is entered, or it is left; after leaving one, its next sibling is entered, or
its parent is left. A node's place is how many nodes are entered up to it, which pointer doubling finds: every step of a list learns
what lies twice as far, so the rounds are as many as the logarithm of the longest list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import stores

#: Leaves are taken off while they are one in LAYER of what is left, or more.
LAYER = 4


def _written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    path = stores.scratch(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def depth_first(nodes: DataFrame, children: DataFrame, tree: str = "tree", node: str = "node", child: str = "child", order: str = "place") -> DataFrame:
    """(tree, node, parent, index) for each of ``nodes`` (tree, node, is_root): the place in depth-first order, from 1.

    ``children`` (tree, node, child, place) lists each node's children in order; those that ``nodes`` lacks are passed over, and of
    repeated mentions of a child the first counts, by place and then by parent. Nodes that no root leads to have index 0, those on
    a circle among them. A tree has one root. Nulls in ``node`` or ``child`` are no nodes.
    """
    spark = nodes.sparkSession
    known = nodes.where(F.col(node).isNotNull()).groupBy(F.col(tree).alias("t"), F.col(node).alias("v")).agg(F.max(F.coalesce("is_root", F.lit(False))).alias("root"))
    edges = children.select(F.col(tree).alias("t"), F.col(node).alias("p"), F.col(child).alias("v"), F.col(order).alias("o"))
    edges = edges.join(known.select("t", F.col("v").alias("p")), ["t", "p"], "left_semi").groupBy("t", "v").agg(F.min(F.struct("o", "p")).alias("e"))
    # a root has no parent, whatever mentions it
    both = known.join(edges, ["t", "v"], "left").select("t", "v", "root", F.when(~F.col("root"), F.col("e.p")).alias("p"), F.col("e.o").alias("o"))
    known, known_path = _written(both, "nodes")
    paths, layers = [known_path], []
    # s: the size of what has been taken off below a node, itself included
    rest = known.where("p is not null").select("t", "v", "p", "o", F.lit(1).cast("long").alias("s"))
    left, stalled = rest.count(), False
    while left and not stalled:
        inner = rest.select("t", F.col("p").alias("v")).distinct().withColumn("inner", F.lit(True))
        marked, path = _written(rest.join(inner, ["t", "v"], "left"), "marked")
        layers.append(marked.where("inner is null").drop("inner"))
        below = layers[-1].groupBy("t", F.col("p").alias("v")).agg(F.sum("s").alias("below"))
        rest = marked.where("inner").join(below, ["t", "v"], "left").select("t", "v", "p", "o", (F.col("s") + F.coalesce("below", F.lit(0))).alias("s"))
        rest, rest_path = _written(rest, "rest")
        paths += [path, rest_path]
        before, left = left, rest.count()
        stalled = (before - left) * LAYER < before
    heads = known.where("p is null").select("t", "v", "p", F.when(F.col("root") & F.col("t").isNotNull(), 1).otherwise(0).cast("long").alias("index"))
    placed = [heads]
    rows = reduce(DataFrame.unionByName, [df.withColumn("layer", F.lit(i)) for i, df in enumerate(layers)]) if layers else None
    if left:
        # the list holds all children of the nodes that still have some of those left among them
        inner = rest.select("t", F.col("p").alias("v")).distinct()
        parents = inner.withColumnRenamed("v", "p")
        own = rest.join(inner.withColumn("inner", F.lit(True)), ["t", "v"], "left").withColumn("s", F.when(F.col("inner"), 1).otherwise(F.col("s"))).drop("inner")
        walked = own.unionByName(rows.join(parents, ["t", "p"], "left_semi").drop("layer"))
        rows = rows.join(parents, ["t", "p"], "left_anti")
        placed.append(_toured(walked, heads.join(inner, ["t", "v"], "left_semi")))
    if layers:
        earlier = Window.partitionBy("t", "p").orderBy("o", "v").rowsBetween(Window.unboundedPreceding, -1)
        rows, path = _written(rows.select("t", "v", "p", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"), "layer"), "layers", ("layer",))
        paths.append(path)
    for i in reversed(range(len(layers))):
        above = reduce(DataFrame.unionByName, placed).where("index > 0").select("t", F.col("v").alias("p"), F.col("index").alias("above"))
        here = rows.where(F.col("layer") == i).join(above, ["t", "p"], "left").select("t", "v", "p", F.coalesce(F.expr("above + before + 1"), F.lit(0)).alias("index"))
        placed.append(_written(here, "places")[0])
    placed[0] = _written(heads, "places")[0]
    for path in paths:
        stores.delete(spark, path)
    return reduce(DataFrame.unionByName, placed).select(F.col("t").alias(tree), F.col("v").alias(node), F.col("p").alias("parent"), "index")


def _toured(children: DataFrame, heads: DataFrame) -> DataFrame:
    """(t, v, p, index) of ``children`` (t, v, p, o, s), whose walk begins at ``heads`` (t, v, index), those of roots 1; s counts for a node and what lies below it besides."""
    spark = children.sparkSession
    beside = Window.partitionBy("t", "p").orderBy("o", "v")
    edges, edges_path = _written(children.select("t", "v", "p", "s", F.lead("v").over(beside).alias("sibling"), (F.row_number().over(beside) == 1).alias("first")), "edges")
    known = edges.select("t", "v", "s").unionByName(heads.select("t", "v", F.lit(1).cast("long").alias("s")))
    firsts = edges.where("first").select("t", F.col("p").alias("v"), F.col("v").alias("child"))
    step = lambda v, leaves: F.when(v.isNotNull(), F.struct(v.alias("v"), F.lit(leaves).alias("leaves")))
    entered = known.join(firsts, ["t", "v"], "left").select("t", "v", F.lit(False).alias("leaves"), F.coalesce(step(F.col("child"), False), step(F.col("v"), True)).alias("next"), F.col("s").alias("n"))
    left = known.drop("s").join(edges, ["t", "v"], "left").select("t", "v", F.lit(True).alias("leaves"), F.coalesce(step(F.col("sibling"), False), step(F.col("p"), True)).alias("next"), F.lit(0).cast("long").alias("n"))
    # n: nodes entered from this step on, up to before next; last: the end of what is known
    steps, path = _written(entered.unionByName(left).withColumn("last", F.struct("v", "leaves")), "steps")
    total, rounds = steps.count(), 0
    while (1 << rounds) < total:
        far = steps.select("t", F.struct("v", "leaves").alias("next"), F.col("next").alias("next2"), F.col("n").alias("n2"), F.col("last").alias("last2"))
        open_ = steps.where("next is not null").join(far, ["t", "next"])
        open_ = open_.select("t", "v", "leaves", F.col("next2").alias("next"), (F.col("n") + F.col("n2")).alias("n"), F.col("last2").alias("last"))
        moved, new = _written(steps.where("next is null").select(*open_.columns).unionByName(open_), "steps")
        stores.delete(spark, path)
        steps, path, rounds = moved, new, rounds + 1
        if steps.where("next is not null").isEmpty():
            break
    from_here = steps.where("not leaves and next is null").select("t", "v", "n", F.col("last.v").alias("end"))
    roots = heads.where("index = 1").select("t", "v").join(from_here, ["t", "v"]).select("t", F.col("v").alias("end"), F.col("n").alias("all"))
    index = F.coalesce(F.col("all") - F.col("n") + 1, F.lit(0)).alias("index")
    out, _ = _written(edges.select("t", "v", "p").join(from_here, ["t", "v"], "left").join(roots, ["t", "end"], "left").select("t", "v", "p", index), "places")
    for p in (edges_path, path):
        stores.delete(spark, p)
    return out
