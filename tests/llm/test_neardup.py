from __future__ import annotations

import random

import numpy as np
from helpers import documents, prose

from lakeloom.llm import neardup


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components(rows):
    """All pairs that share a shingle, and the smallest id that each can reach."""
    sets = {i: shingles(t) for i, t in rows}
    where: dict = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for ids in where.values() for n, a in enumerate(ids) for b in ids[n + 1 :]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return words


def check(spark, rows):
    got = {r["doc_id"]: r for r in neardup.near_duplicates(documents(spark, rows).repartition(3)).collect()}
    expected = components(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == expected
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_groups_chains_and_copies(spark):
    rnd = random.Random(1)
    rows, i = [], 0
    for _ in range(12):
        base = prose(rnd, rnd.randint(30, 150), 5000)
        for _ in range(rnd.randint(1, 6)):
            rows.append((i, " ".join(edited(rnd, base, rnd.randint(0, 3)))))
            i += 1
    chain = prose(rnd, 120, 5000)
    for _ in range(12):
        rows.append((i, " ".join(chain)))
        chain = edited(rnd, chain, 2)
        i += 1
    copy = " ".join(prose(rnd, 60, 5000))
    rows += [(i + j, copy.upper() if j % 2 else copy) for j in range(30)]
    rows += [(900, "one two"), (901, "ONE  two"), (902, "one"), (903, ""), (904, None), (905, " ")]
    check(spark, rows)


def test_one_large_group_of_near_copies(spark):
    rnd = random.Random(2)
    base = prose(rnd, 100, 5000)
    check(spark, [(i, " ".join(edited(rnd, base, rnd.randint(0, 2)))) for i in range(400)])


def test_against_all_pairs_on_the_table(spark, sf_dir):
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()])


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(4)
    for _ in range(300):
        one = rng.integers(0, 1 << 16, neardup.COMPONENTS, np.uint16)
        two = one.copy()
        two[rng.choice(neardup.COMPONENTS, neardup.DISTANCE, replace=False)] += np.uint16(1)
        assert set(neardup.chunk_keys(one)[0].tolist()) & set(neardup.chunk_keys(two)[0].tolist())


def test_similar_texts_are_missed_as_seldom_as_computed():
    """Of pairs at a similarity of 0.75, two in 100,000 have a distance above the bound; none of 500 here."""
    rng = np.random.default_rng(5)
    factors, shifts = neardup._multipliers()
    for _ in range(500):
        common, own = rng.integers(0, 1 << 63, 300, np.uint64), rng.integers(0, 1 << 63, (2, 50), np.uint64)
        one, two = (neardup.signatures_of(np.concatenate([common, x]), np.array([350]), factors, shifts)[0] for x in own)
        assert (one != two).sum() <= neardup.DISTANCE


def sharing(rnd, n, share, words=120):
    """Texts with a passage in common and the rest of their own: no two are near for a share below 6 / 7."""
    common = prose(rnd, int(words * share), 10**6)
    return [(i, " ".join(common + prose(rnd, words - len(common), 10**6))) for i in range(n)]


def test_filings_grow_with_the_members_of_a_group(spark):
    counts = []
    for n in (250, 500, 1000):
        rows = sharing(random.Random(n), n, 0.75)
        hot = spark.createDataFrame([(i, i, t) for i, t in rows], "id long, component long, text string").repartition(3)
        filed = neardup.rare_filings(hot)
        assert filed.count() <= 10 * n
        counts.append(neardup._in_cells(neardup.possible(filed), "gram").count())
    assert counts[1] <= 2.5 * counts[0] + 100 and counts[2] <= 2.5 * counts[1] + 100


def test_a_group_that_shares_a_passage_and_one_of_heavily_edited_copies(spark):
    rnd = random.Random(6)
    rows = sharing(rnd, 200, 0.8)
    base = prose(rnd, 120, 10**6)
    rows += [(1000 + i, " ".join(edited(rnd, base, rnd.randint(1, 8)))) for i in range(300)]
    check(spark, rows)


def test_cells_of_several_blocks_hold_each_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = spark.range(90).selectExpr("1L as gram", "id", "if(id % 3 = 0, 0L, id) as component")
    cells = {}
    for r in neardup._in_cells(rows, "gram").collect():
        cells.setdefault(r["cell"], []).append(r)
    met = set()
    for members in cells.values():
        blocks = {r["block"] for r in members}
        assert len(blocks) <= 2
        pairs = [(a, b) for n, a in enumerate(members) for b in members[n + 1 :] if a["component"] != b["component"] and (len(blocks) == 1 or a["block"] != b["block"])]
        for a, b in pairs:
            pair = (min(a["id"], b["id"]), max(a["id"], b["id"]))
            assert pair not in met
            met.add(pair)
    assert len(met) == 90 * 89 // 2 - 30 * 29 // 2


def test_sets_and_signatures_together_are_those_of_each():
    rnd, cache = random.Random(8), neardup.WordHashes()
    factors, shifts = neardup._multipliers()
    texts = [" ".join(prose(rnd, n, 50)) for n in (0, 1, 4, 5, 6, 0, 3000, 700, 2, 900, 5000, 0)] + [None, "w " * 2000]
    sets, sizes = neardup.shingle_sets(texts, cache)
    each = [neardup.shingle_set(t, cache) for t in texts]
    assert sizes.tolist() == [len(x) for x in each] and np.array_equal(sets, np.concatenate(each))
    full = [x for x in each if len(x)]
    together = neardup.signatures_of(sets, sizes[sizes > 0], factors, shifts)
    assert np.array_equal(together, np.stack([neardup.signatures_of(x, np.array([len(x)]), factors, shifts)[0] for x in full]))
    low = (((full[2] >> np.uint64(32)).astype(np.uint32)[:, None] * factors + shifts)).min(0)
    assert np.array_equal(together[2], (neardup.mix(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16))
