"""SimHash near-duplicates, joined exactly by vantage-point trees.

A document's fingerprint has 64 bits: bit i is set if it is set in over half of the hashes of its word
shingles. Documents whose fingerprints differ in at most ``distance`` bits are linked.

1. Equal fingerprints are one point, by an aggregation that each task begins.
2. A tree of vantage points is fitted to a bounded sample of points. Each inner node has a vantage point and
   a radius: points within the radius are its inner side, the others its outer side. Leaves are shards.
3. Every point is a member of one shard. By the triangle inequality two points of different sides within
   ``distance`` of each other both lie within ``distance`` of the node's radius; so an inner point near the radius also
   visits the outer side, and a visitor goes wherever a partner could be. Each pair within the distance so meets in
   exactly one shard, as members or as member and visitor.
4. A shard is cut further in its task by vantage points of its own, until few members are left, which are compared.
   Shards that one ball fills, so that no radius parts them, are dealt to cells of two blocks.
5. A cell returns no pairs, only what its pairs connect: an edge from each point met to one of its component. So a group of
   any size yields as many rows as it has points.

The sample affects how even the shards are, never which pairs meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, pick, remove, words_of, written

SHINGLE_WORDS = 4
DISTANCE = 4
#: Points that a shard is meant to hold, and those of a block of a shard that can't be cut.
SHARD = 1 << 15
BLOCK = 1 << 16
#: Points that the tree is fitted to, and those that a leaf should have of them at least.
SAMPLE, LEAST = 1 << 14, 8
#: Members that are compared without another cut.
FEW = 512
#: Hashes whose bits are counted at once.
PART = 1 << 14

_SEED = 42


def shingle_hashes(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each run of ``k`` words, joined by blanks; of all words if there are fewer."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([hashed(joined, _SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = ends[: len(words) - k + 1] - np.fromiter(map(len, words[: len(words) - k + 1]), np.int64) - 1
    spans = zip(begins.tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((hashed(joined[a:b], _SEED) for a, b in spans), np.uint64, len(begins))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; 0 without any."""
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), PART):
        part = hashes[lo : lo + PART].astype("<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def _signed(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = [fingerprint(shingle_hashes(t, k)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "point": np.array(points, np.uint64).view(np.int64)})

    return run


@dataclass
class Tree:
    """Inner nodes in arrays: vantage point, radius, and the two children; a child below zero is shard -1 - child."""

    vantage: np.ndarray
    radius: np.ndarray
    inner: list[int]
    outer: list[int]
    shards: int


def best_cut(points: np.ndarray, rnd: np.random.Generator, distance: int) -> tuple[int, int] | None:
    """A vantage point and a radius that part ``points`` with the fewest near the radius; None if nothing parts them."""
    best = None
    for v in points[rnd.integers(0, len(points), 8)]:
        counts = np.bincount(np.bitwise_count(points ^ v), minlength=65)
        below = np.cumsum(counts)
        radius = int(np.searchsorted(below, len(points) / 2))
        # the median itself may be a large tie, and then the distance before it parts better
        for r in {radius, max(radius - 1, 0)}:
            inner = int(below[r])
            if min(inner, len(points) - inner) < len(points) / 8:
                continue
            near = int(counts[max(r - distance + 1, 0) : r + distance + 1].sum())
            if best is None or near < best[0]:
                best = near, int(v), r
    return best and best[1:]


def fitted(points: np.ndarray, depth: int, distance: int = DISTANCE, seed: int = 11) -> Tree:
    """A tree of ``depth`` levels at most over a sample of distinct points."""
    rnd, vantage, radius, inner, outer, shards = np.random.default_rng(seed), [], [], [], [], 0

    def grow(some: np.ndarray, left: int) -> int:
        nonlocal shards
        cut = best_cut(some, rnd, distance) if left and len(some) >= 2 * LEAST else None
        if cut is None:
            shards += 1
            return -shards
        at = len(vantage)
        vantage.append(cut[0])
        radius.append(cut[1])
        inner.append(0)
        outer.append(0)
        near = np.bitwise_count(some ^ np.uint64(cut[0])) <= cut[1]
        inner[at] = grow(some[near], left - 1)
        outer[at] = grow(some[~near], left - 1)
        return at

    grow(np.sort(points), depth)
    return Tree(np.array(vantage, np.uint64), np.array(radius, np.int64), inner, outer, shards)


def parted(points: np.ndarray, members: np.ndarray, visitors: np.ndarray, vantage: np.uint64, radius: int, distance: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(members, visitors) of the inner side and of the outer side of a node, as places in ``points``."""
    own, far = (np.bitwise_count(points[x] ^ vantage).astype(np.int64) for x in (members, visitors))
    inside = own <= radius
    crossing = members[inside & (own > radius - distance)]
    return (members[inside], visitors[far <= radius + distance]), (members[~inside], np.concatenate([visitors[far > radius - distance], crossing]))


def routed(tree: Tree, points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, place, member?) of each point: one shard that it is a member of, and those that it visits."""
    found, nothing = [], np.empty(0, np.int64)
    open_ = [(0 if len(tree.vantage) else -1, np.arange(len(points)), nothing)]
    while open_:
        node, members, visitors = open_.pop()
        if node < 0:
            found += [(-1 - node, members, True), (-1 - node, visitors, False)]
        elif len(members) or len(visitors):
            sides = parted(points, members, visitors, tree.vantage[node], int(tree.radius[node]), distance)
            open_ += [(child, *side) for child, side in zip((tree.inner[node], tree.outer[node]), sides, strict=True)]
    if not found:
        return nothing, nothing, np.empty(0, bool)
    return (
        np.concatenate([np.full(len(x), s) for s, x, _ in found]),
        np.concatenate([x for _, x, _ in found]),
        np.concatenate([np.full(len(x), m) for _, x, m in found]),
    )


class Groups:
    """Components of places; the smaller ones are relabelled as they unite."""

    def __init__(self, n: int) -> None:
        self.label, self.sets = np.arange(n), {}

    def unite(self, places: np.ndarray) -> None:
        names = np.unique(self.label[places]).tolist()
        if len(names) < 2:
            return
        # a label without a set is a place of its own
        sets = {name: self.sets.pop(name, [name]) for name in names}
        kept = max(names, key=lambda name: len(sets[name]))
        for name in names:
            if name != kept:
                self.label[sets[name]] = kept
                sets[kept] += sets[name]
        self.sets[kept] = sets[kept]


def _compared(points: np.ndarray, members: np.ndarray, others: np.ndarray, distance: int, groups: Groups) -> None:
    for lo in range(0, len(others), 4096):
        part = others[lo : lo + 4096]
        near = np.bitwise_count(points[members][:, None] ^ points[part][None, :]) <= distance
        # a member compared with its own part meets itself
        for i in np.flatnonzero(near.sum(1) > (others is members)).tolist():
            found = np.append(part[near[i]], members[i])
            if (groups.label[found] != groups.label[found[0]]).any():
                groups.unite(found)


def joined_in(points: np.ndarray, members: np.ndarray, visitors: np.ndarray, distance: int, groups: Groups, rnd: np.random.Generator) -> None:
    """Unite what pairs of members, and of a member and a visitor, within the distance connect."""
    open_ = [(members, visitors)]
    while open_:
        members, visitors = open_.pop()
        if not len(members):
            continue
        cut = best_cut(points[members], rnd, distance) if len(members) > FEW else None
        if cut:
            sides = parted(points, members, visitors, np.uint64(cut[0]), cut[1], distance)
            if sum(len(m) * (len(m) + len(v)) for m, v in sides) < 0.9 * len(members) * (len(members) + len(visitors)):
                open_ += sides
                continue
        for lo in range(0, len(members), FEW):
            some = members[lo : lo + FEW]
            _compared(points, some, some, distance, groups)
            _compared(points, some, np.concatenate([members[lo + FEW :], visitors]), distance, groups)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, block, member?) of each cell. Rows come sorted by shard and cell; a cell is of two blocks and their visitors."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        rows = pd.concat([*held, batch]) if held else batch
        shard, cell = rows["shard"].to_numpy(), rows["cell"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(cell) != 0)) + 1).tolist(), len(rows)]
        for lo, hi in zip(edges[:-2], edges[1:-1], strict=True):
            yield _columns(rows.iloc[lo:hi])
        held = [rows.iloc[edges[-2] :]]
    for rows in held:
        if len(rows):
            yield _columns(rows)


def _columns(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows["point"].to_numpy().view(np.uint64), rows["block"].to_numpy(), rows["member"].to_numpy().astype(bool)


def _connected(distance: int):
    """(a, b): an edge from each point that a cell connects to one of its component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rnd = np.random.default_rng(3)
        for points, block, member in _cells(batches):
            groups, place = Groups(len(points)), np.arange(len(points))
            first = member & (block == block[member].min()) if member.any() else member
            if (first == member).all():
                joined_in(points, place[member], place[~member], distance, groups, rnd)
            else:
                # two blocks of a shard: pairs within one have a cell of their own
                joined_in(points, place[first], place[member & ~first], distance, groups, rnd)
            linked = np.flatnonzero(groups.label != place)
            if len(linked):
                yield pd.DataFrame({"a": points[groups.label[linked]].view(np.int64), "b": points[linked].view(np.int64)})

    return run


def _sharded(tree: Tree, distance: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["point"].to_numpy()
            shard, place, member = routed(tree, points.view(np.uint64), distance)
            for lo in range(0, len(shard), 100_000):
                hi = lo + 100_000
                yield pd.DataFrame({"shard": shard[lo:hi], "point": points[place[lo:hi]], "member": member[lo:hi]})

    return run


def sharded(points: DataFrame, tree: Tree, distance: int = DISTANCE) -> DataFrame:
    """(shard, point, member) of distinct points: each is a member of one shard and may visit others."""
    return points.select("point").mapInPandas(_sharded(tree, distance), "shard long, point long, member boolean")


def in_cells(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Shards of over ``block`` members are dealt to cells of two blocks, and their visitors to the cells of one block each."""
    sizes = rows.where("member").groupBy("shard").agg(F.count("*").alias("n"))
    blocks = sizes.select("shard", F.ceil(F.col("n") / F.lit(block)).alias("blocks"))
    # as many rows as the tree has leaves, a number bounded by its sample
    placed = rows.join(F.broadcast(blocks), "shard").withColumn("block", F.expr("if(member, pmod(xxhash64(point), blocks), -1L)"))
    cells = F.expr("""case when blocks = 1 then array(0L)
        when member then transform(sequence(0L, blocks - 1), x -> least(block, x) * blocks + greatest(block, x))
        else transform(sequence(0L, blocks - 1), x -> x * blocks + x) end""")
    return placed.select("shard", "point", "member", "block", F.explode(cells).alias("cell"))


def links(points: DataFrame, distance: int = DISTANCE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect the same points as all pairs of distinct ``points`` (point long) within the distance do."""
    n = points.count()
    sample = points.orderBy(F.xxhash64("point", F.lit(7)), "point").limit(SAMPLE).collect()
    depth = math.ceil(math.log2(max(n / shard, 1)))
    tree = fitted(np.array([r["point"] for r in sample], np.int64).view(np.uint64), depth, distance)
    # a number of its own, since few bytes can mean much work
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = in_cells(sharded(points, tree, distance), block)
    return cells.repartition(parts, "shard", "cell").sortWithinPartitions("shard", "cell").mapInPandas(_connected(distance), "a long, b long")


def simhash_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs`` (doc_id, text, ...).

    The fingerprint comes as 16 lowercase hex digits. Null and wordless texts have fingerprint zero and are linked like
    any other. component_id is the smallest doc_id reachable; a row without doc_id connects its neighbours but can't be named,
    and its component_id is null. Rows that repeat a doc_id keep a row each and are linked each by its own text and, as they are
    one document, with each other. Extra columns don't matter, whatever their names. An empty table gives no rows.
    Texts of any length are read whole; a task holds one at a time.
    """
    spark = docs.sparkSession
    signed = written(pick(docs, "doc_id", "text").mapInPandas(_signed(k), "doc_id long, point long"), "fingerprints")
    points = written(signed.groupBy("point").agg(F.min("doc_id").alias("low")), "points")
    repeated = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("point").alias("a"), F.max("point").alias("b"), F.count("*").alias("n"))
    several = signed.join(repeated.where("a <> b and n > 1"), "doc_id").select("a", F.col("point").alias("b")).where("a <> b")
    edges = written(links(points.select("point"), distance).union(several), "near-points")
    labels = connected_components(edges, "simhash")
    placed = points.join(labels.withColumnRenamed("id", "point"), "point", "left").select("point", "low", F.coalesce("component", "point").alias("component"))
    least = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = written(placed.join(least, "component").select("point", "component_id"), "components")
    remove(spark, points, edges, labels)
    digits = F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint")
    return signed.join(named, "point").select("doc_id", digits, F.expr("if(doc_id is null, null, component_id)").alias("component_id"))

