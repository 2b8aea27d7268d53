from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

from helpers import documents
from pyspark.sql import functions as F

from lakeloom.llm import mixing


def highest_quotients(sizes, seats):
    won = [0] * len(sizes)
    for _ in range(seats):
        i = max(range(len(sizes)), key=lambda j: (Fraction(sizes[j], 2 * won[j] + 1), -j))
        won[i] += 1
    return won


def filled(sizes, weights, goal):
    """Targets by raising a common level until the caps hold."""
    open_, target = set(range(len(sizes))), {}
    while open_:
        left = goal - sum(target.values())
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if Fraction(left * weights[i], total) > 2 * sizes[i]}
        if not over:
            return [float(target.get(i, Fraction(left * weights[i], total))) for i in range(len(sizes))]
        target |= {i: Fraction(2 * sizes[i]) for i in over}
        open_ -= over
    return [float(target[i]) for i in range(len(sizes))]


def test_apportioned(spark):
    rnd = random.Random(3)
    for n, seats in ((1, 5), (4, 3), (5, 40), (7, 1000)):
        sizes = [rnd.randrange(1, 10_000) for _ in range(n)]
        df = spark.createDataFrame([(0, i, float(s)) for i, s in enumerate(sizes)], "g int, place int, size double")
        out = mixing.apportioned(df, ["g"], "size", F.lit(seats), ["place"], "quota").orderBy("place").collect()
        assert [r["quota"] for r in out] == highest_quotients(sizes, seats)


def test_targets(spark):
    rnd = random.Random(4)
    for _ in range(3):
        sizes = [rnd.randrange(0, 5000) for _ in range(6)]
        df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
        found = [r["target"] for r in mixing.targets(df).orderBy("place").collect()]
        expected = filled(sizes, [(5, 2, 1)[i % 3] for i in range(6)], Fraction(3 * sum(sizes), 2))
        assert all(abs(a - b) < 1e-6 * max(1, b) for a, b in zip(found, expected, strict=True))


def test_mix(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randrange(0, 300), rnd.choice(["a", "b", "c", "d", None])) for i in range(2000)]
    docs = documents(spark, rows)
    out = [tuple(r) for r in mixing.mixed(docs).collect()]
    assert len(out) == 2000
    taken, target, size = defaultdict(int), {}, dict((r[0], len(r[1].split())) for r in rows)
    source = {r[0]: r[2] for r in rows}
    for doc_id, n, _, goal, got in out:
        assert n == size[doc_id] and 0 <= got <= 2 * n
        taken[source[doc_id]] += got
        target[source[doc_id]] = goal
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= max(0.01 * goal, 2 * mixing.BLOCK)
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted(out, key=repr) == sorted(map(tuple, again), key=repr)


def test_plan_is_native(spark):
    plan = mixing.mixed(documents(spark, [(1, "a b", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_what_is_taken(spark):
    """Against a plain version that lays out every token."""
    rnd = random.Random(6)
    rows = [(i, "w " * rnd.randrange(0, 90), rnd.choice(["a", "a", "a", "b", "c", None])) for i in range(300)] + [(None, "w w w", "a"), (7, None, "b")]
    got = defaultdict(list)
    for r in mixing.mixed(documents(spark, rows).repartition(3)).collect():
        got[r["doc_id"]].append((r["size"], r["source_size"], r["taken"]))
    md5 = lambda *parts: hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()
    names = sorted({s for *_, s in rows if s}) + [None]
    docs = [(i, len((t or "").split()), s) for i, t, s in rows]
    sizes = [sum(n for _, n, s in docs if s == name) for name in names]
    targets = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], Fraction(3 * sum(sizes), 2))
    quotas = highest_quotients([Fraction(t) for t in targets], int(sum(targets) / mixing.BLOCK + 0.5))
    expected = defaultdict(list)
    for place, (name, size, quota) in enumerate(zip(names, sizes, quotas, strict=True), 1):
        n_shards = max(1, int((size / mixing.BLOCK) ** 0.5))
        shards = defaultdict(list)
        for i, n, s in docs:
            if s == name:
                order = md5(1, i)
                shards[int(order[:8], 16) * n_shards >> 32].append((order, i, n))
        numbers = sorted(shards)
        seats = dict(zip(numbers, highest_quotients([sum(n for *_, n in shards[k]) for k in numbers], quota), strict=True))
        length = {k: sum(n for *_, n in shards[k]) for k in numbers}
        blocks = {k: max(1, int(length[k] / mixing.BLOCK + 0.5)) for k in numbers}
        room = {k: 2 * blocks[k] if length[k] else 0 for k in numbers}
        cut = sum(max(0, seats[k] - room[k]) for k in numbers)
        for k in sorted(numbers, key=lambda k: (-length[k] / (2 * seats[k] + 1), k)):
            more = min(max(0, room[k] - seats[k]), cut)
            cut, seats[k] = cut - more, seats[k] + more
        for k in numbers:
            n_blocks, q = blocks[k], min(seats[k], room[k])
            times, extra, start = q // n_blocks, q % n_blocks, int(md5(2, place, k)[:12], 16) % n_blocks
            chosen = [((j + 1) * extra + start) // n_blocks - (j * extra + start) // n_blocks for j in range(n_blocks)]
            at = 0
            for _, i, n in sorted(shards[k], key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
                blocks_of = [min(t // mixing.BLOCK, n_blocks - 1) for t in range(at, at + n)]
                expected[i].append((n, size, sum(times + chosen[b] for b in blocks_of)))
                at += n
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in expected.items()}
