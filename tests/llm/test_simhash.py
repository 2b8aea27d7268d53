"""SimHash components against all pairs, and the vantage-point tree by itself."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from helpers import awkward, documents, prose, with_clashes
from pyspark.sql import functions as F

from lakeloom.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(points, distance=4):
    """The first place that each point is connected with, by all pairs."""
    points = np.array(points, np.uint64)
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= distance).tolist():
            a, b = sorted((root(i), root(i + 1 + j)))
            label[b] = a
    return [root(i) for i in range(len(points))]


def near_points(rnd, groups, each, flips):
    found = []
    for _ in range(groups):
        base = int(rnd.integers(0, 1 << 63)) * 2 + int(rnd.integers(0, 2))
        for _ in range(each):
            x = base
            for b in rnd.integers(0, 64, rnd.integers(0, flips + 1)):
                x ^= 1 << int(b)
            found.append(x)
    return sorted(set(found))


def signed(points):
    return np.array(points, np.uint64).view(np.int64).tolist()


def components_of(edges, points):
    label = {p: p for p in points}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    return {frozenset(p for p in points if root(p) == r) for r in {root(p) for p in points}}


@pytest.mark.parametrize("shard,block,few", [(1 << 15, 1 << 16, 512), (64, 1 << 16, 16), (64, 32, 8)])
def test_links_connect_what_all_pairs_do(spark, monkeypatch, shard, block, few):
    monkeypatch.setattr(simhash, "FEW", few)
    points = near_points(np.random.default_rng(1), 150, 8, 5)
    table = spark.createDataFrame([(p,) for p in signed(points)], "point long").repartition(3)
    edges = [(r["a"], r["b"]) for r in simhash.links(table, 4, shard, block).collect()]
    ids = signed(points)
    expected = plain_components(points)
    groups = {frozenset(i for i, r in zip(ids, expected, strict=True) if r == root) for root in set(expected)}
    assert components_of(edges, ids) == groups


def test_a_ball_of_near_points_yields_a_row_a_point(spark):
    # no radius parts them, so they are dealt to cells of two blocks
    points = near_points(np.random.default_rng(2), 1, 3000, 6)
    table = spark.createDataFrame([(p,) for p in signed(points)], "point long").repartition(3)
    rows = simhash.links(table, 4, 256, 500).collect()
    expected = plain_components(points)
    ids = signed(points)
    groups = {frozenset(i for i, r in zip(ids, expected, strict=True) if r == root) for root in set(expected)}
    assert components_of([(r["a"], r["b"]) for r in rows], ids) == groups
    assert len(rows) <= len(points) * 2 * 7


def test_each_pair_within_the_distance_meets_once():
    rnd = np.random.default_rng(3)
    points = np.array(near_points(rnd, 60, 12, 5), np.uint64)
    tree = simhash.fitted(points, 5)
    assert tree.shards > 8
    shard, place, member = simhash.routed(tree, points, 4)
    assert sorted(place[member].tolist()) == list(range(len(points)))
    met = {}
    for s in set(shard.tolist()):
        here = shard == s
        inside, outside = place[here & member].tolist(), place[here & ~member].tolist()
        for x in inside:
            for y in [z for z in inside if z > x] + outside:
                met[frozenset((x, y))] = met.get(frozenset((x, y)), 0) + 1
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= 4).tolist():
            assert met[frozenset((i, i + 1 + j))] == 1


def test_documents_against_all_pairs(spark):
    import random

    rnd = random.Random(5)
    texts = []
    for _ in range(40):
        words = prose(rnd, rnd.choice([3, 4, 5, 30, 200, 900]), 3000)
        for _ in range(4):
            changed = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                changed[rnd.randrange(len(changed))] = "other"
            texts.append(" ".join(changed))
    texts += ["", None, "  ", "Ä a b c d", "ä a b c d", "A B C D E", "a b\tc\nd e"]
    ids = random.Random(6).sample(range(10_000), len(texts))
    found = {r["doc_id"]: r for r in simhash.simhash_duplicates(documents(spark, list(zip(ids, texts, strict=True)))).collect()}
    points = [plain_fingerprint(t) for t in texts]
    assert [found[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in points]
    roots = plain_components(points)
    least = {r: min(i for i, x in zip(ids, roots, strict=True) if x == r) for r in set(roots)}
    assert [found[i]["component_id"] for i in ids] == [least[r] for r in roots]
    assert found[ids[-1]]["fingerprint"] == found[ids[-2]]["fingerprint"]


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    points = [plain_fingerprint(r["text"]) for r in rows]
    roots = plain_components(points)
    least = {r: min(x["doc_id"] for x, y in zip(rows, roots, strict=True) if y == r) for r in set(roots)}
    expected = {x["doc_id"]: (f"{p:016x}", least[r]) for x, p, r in zip(rows, points, roots, strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_duplicates(docs).collect()} == expected


def test_awkward_rows(spark):
    found = {}
    for r in simhash.simhash_duplicates(with_clashes(awkward(spark))).collect():
        found.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    texts = {r["doc_id"]: r["text"] for r in awkward(spark).collect()}
    assert {i: len(v) for i, v in found.items()} == {i: 2 if i == 6 else 1 for i in texts}
    assert all(x[0] == f"{plain_fingerprint(texts[i]):016x}" for i, v in found.items() for x in v)
    assert found[1] == [("0" * 16, 1)] and found[2] == [("0" * 16, 1)] and found[3] == [("0" * 16, 1)]
    assert found[None][0][1] is None and found[6][0] == found[6][1]
    assert simhash.simhash_duplicates(awkward(spark).limit(0)).collect() == []


def test_rows_of_one_id_are_one_document(spark):
    rows = [(5, "one text of some words that go on"), (5, "quite another text with other words in it"), (3, "one text of some words that go on"), (9, "quite another text with other words in it"), (7, "no part of all that is in here at all")]
    found = simhash.simhash_duplicates(documents(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]


def test_the_sample_is_bounded(spark):
    tree = simhash.fitted(np.random.default_rng(1).integers(0, 1 << 63, simhash.SAMPLE).astype(np.uint64), 40)
    assert tree.shards <= simhash.SAMPLE // 2
    rows = simhash.sharded(spark.range(5000).select(F.xxhash64("id").alias("point")), tree)
    assert rows.where("member").count() == 5000
