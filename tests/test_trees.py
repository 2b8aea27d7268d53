"""Depth-first places against the walker of documents, and aggregates that are united later."""

from __future__ import annotations

import datetime
import random

import pytest

from lakeloom.operators import mergeable, trees
from lakeloom.sources.courses import walked

NODES, CHILDREN = "tree string, node string, is_root boolean", "tree string, node string, child string, place int"


def places(spark, documents):
    """By (tree, node), for documents {tree: (root, {node: [children]})}."""
    nodes = [(t, n, n == root) for t, (root, blocks) in documents.items() for n in blocks]
    children = [(t, n, c, i) for t, (_, blocks) in documents.items() for n, below in blocks.items() for i, c in enumerate(below)]
    found = trees.depth_first(spark.createDataFrame(nodes, NODES), spark.createDataFrame(children, CHILDREN))
    rows = {(r["tree"], r["node"]): r["index"] for r in found.collect()}
    assert len(rows) == len(nodes)
    return rows


def expected(documents):
    out = {}
    for t, (root, blocks) in documents.items():
        order = {n: i for i, n in enumerate(walked({n: {"children": c} for n, c in blocks.items()}, root), 1)}
        out |= {(t, n): order.get(n, 0) for n in blocks}
    return out


def test_random_trees_have_the_walkers_places(spark):
    rnd, documents = random.Random(7), {}
    for t in range(12):
        names = [f"n{i}" for i in range(rnd.choice([1, 2, 5, 40, 150]))]
        blocks = {n: [] for n in names}
        for i, n in enumerate(names[1:], 1):
            # chains, bushes and what lies between
            blocks[names[rnd.randrange(max(0, i - rnd.choice([1, 3, 200])), i)]].append(n)
        for below in blocks.values():
            rnd.shuffle(below)
            if rnd.random() < 0.1:
                below.insert(rnd.randrange(len(below) + 1), "missing")
        documents[f"t{t}"] = (names[0], blocks)
    assert places(spark, documents) == expected(documents)


@pytest.mark.parametrize("blocks", [
    {"r": ["a"], "a": ["b"], "b": [], "stray": ["s2"], "s2": []},
    {"r": ["a"], "a": [], "x": ["y"], "y": ["z"], "z": ["x"]},
    {"r": ["gone", "a", "gone2"], "a": ["gone"]},
    {"r": ["a", "b"], "a": ["r"], "b": []},
    {"a": ["b"], "b": []},
])
def test_strays_circles_and_missing_blocks(spark, blocks):
    root = "r" if "r" in blocks else "no such"
    documents = {"t": (root, blocks), "other": ("q", {"q": ["p"], "p": []})}
    assert places(spark, documents) == expected(documents)


def test_a_child_named_twice_counts_once(spark):
    found = places(spark, {"t": ("r", {"r": ["a", "b", "a"], "a": [], "b": ["c", "a"], "c": []})})
    assert {n: i for (_, n), i in found.items()} == {"r": 1, "a": 2, "b": 3, "c": 4}


def test_a_long_chain(spark):
    blocks = {f"n{i}": [f"n{i + 1}"] if i < 999 else [] for i in range(1000)}
    assert places(spark, {"t": ("n0", blocks)}) == {("t", f"n{i}"): i + 1 for i in range(1000)}


def test_bushes_need_no_walk_and_chains_below_them_do(spark, monkeypatch):
    walks, walk = [], trees._toured
    monkeypatch.setattr(trees, "_toured", lambda *a: walks.append(1) or walk(*a))
    rnd = random.Random(5)
    bush = {"r": [f"c{i}" for i in range(20)]} | {f"c{i}": [f"o{i}-{j}" for j in range(i % 5)] for i in range(20)}
    bush |= {o: [] for below in list(bush.values()) for o in below if o not in bush}
    assert places(spark, {"t": ("r", bush)}) == expected({"t": ("r", bush)}) and not walks
    # chains of bushes, and what lies beside them, before and after
    mixed = {k: list(v) for k, v in bush.items()}
    for i in range(300):
        mixed[f"k{i}"] = [f"k{i + 1}"] if i < 299 else []
        if i % 7 == 0:
            mixed |= {f"k{i}a": [], f"k{i}b": [f"k{i}c"], f"k{i}c": []}
            mixed[f"k{i}"] += [f"k{i}a", f"k{i}b"]
            rnd.shuffle(mixed[f"k{i}"])
    mixed["c3"].insert(1, "k0")
    assert places(spark, {"t": ("r", mixed), "u": ("r", bush)}) == expected({"t": ("r", mixed), "u": ("r", bush)}) and walks


def test_no_nodes(spark):
    assert trees.depth_first(spark.createDataFrame([], NODES), spark.createDataFrame([], CHILDREN)).collect() == []


def test_any_span_of_bitmaps_is_the_distinct_count(spark):
    rnd = random.Random(1)
    day = lambda d: datetime.date(2024, 1, d)
    data = [(day(rnd.choice([1, 2, 3, 8, 9, 20])), rnd.choice(["a", "b", None]), rnd.choice([None, 0, 5, 32767, 32768, 70_000, 2**40 + 3, -7])) for _ in range(300)]
    kept = mergeable.bitmaps(spark.createDataFrame(data, "day date, g string, id long"), ["day", "g"], "id")
    for days in (1, 2, 7, 31):
        found = {(r["until"], r["g"]): r["n"] for r in mergeable.distinct_counts(mergeable.in_spans(kept, "day", days), ["until", "g"]).collect()}
        ends = {d for d, _, i in data if i is not None}
        plain = {(u, g): len({i for d, h, i in data if h == g and i is not None and 0 <= (u - d).days < days}) for u in ends for g in ("a", "b", None)}
        assert found == {k: n for k, n in plain.items() if n}


def test_sketches_united_in_any_order_stay_within_the_error(spark):
    rnd = random.Random(3)
    data = [(i % 30, rnd.choice([rnd.random(), float(rnd.randrange(5)), None])) for i in range(30_000)]
    rows = spark.createDataFrame(data, "day int, v double")
    values = sorted(v for _, v in data if v is not None)
    kept = mergeable.sketches(rows, ["day"], "v")
    for by in (["day % 7"], ["day % 2"], []):
        step = kept.selectExpr(*(f"{b} as d" for b in by), "sketch") if by else kept
        united = mergeable.merged(mergeable.merged(step, ["d"]) if by else step, [])
        for share in (0.01, 0.25, 0.5, 0.9, 0.999):
            bound = united.select(mergeable.quantile("sketch", share)).first()[0]
            below, up_to = sum(v < bound for v in values) / len(values), sum(v <= bound for v in values) / len(values)
            assert below <= share + mergeable.RANK_ERROR and up_to >= share - mergeable.RANK_ERROR
