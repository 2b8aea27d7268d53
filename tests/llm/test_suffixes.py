from __future__ import annotations

import random
from collections import defaultdict

import pytest
from helpers import documents, prose

from lakeloom.llm import suffixes


def repeated(rows, least):
    """Words of all windows that occur twice; words of all but the first occurrence of each."""
    seen = defaultdict(set)
    for i, text in rows:
        words = (text or "").encode().lower().split()
        for k in range(len(words) - least + 1):
            seen[tuple(words[k : k + least])].add((i, k))
    every, later = defaultdict(set), defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                every[i] |= set(range(k, k + least))
                if (i, k) != min(places):
                    later[i] |= set(range(k, k + least))
    return every, later


def covered(found):
    every, later = defaultdict(set), defaultdict(set)
    for r in found:
        (later if r["removable"] else every)[r["doc_id"]] |= set(range(r["start"], r["end"]))
    return every, later


@pytest.mark.parametrize("seed,words", [(0, 6), (1, 40)])
def test_finds_exactly_what_is_repeated(spark, seed, words):
    rnd = random.Random(seed)
    passages = [prose(rnd, rnd.randint(5, 40), words) for _ in range(8)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rnd.randint(0, 8)):
            text += rnd.choice(passages) if rnd.random() < 0.5 else prose(rnd, rnd.randint(1, 30), words)
        rows.append((i, " ".join(text)))
    got = suffixes.repeated_passages(documents(spark, [*rows, (100, None), (101, "")]).repartition(5), 12, 4).collect()
    every, later = covered(got)
    expected, removable = repeated(rows, 12)
    assert every == expected
    # what goes always has an earlier copy
    assert all(later[i] <= removable[i] for i in later)
    # the other document named does hold one of the passage's windows, in another place
    words = {i: text.encode().lower().split() for i, text in rows}
    held = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 11):
            held[tuple(w[k : k + 12])].add((i, k))
    for r in got:
        own = words[r["doc_id"]]
        others = {(i, k) for s in range(r["start"], r["end"] - 11) for i, k in held[tuple(own[s : s + 12])] if (i, k) != (r["doc_id"], s)}
        assert r["other_doc_id"] in {i for i, _ in others}
        if {i for i, _ in others} == {r["doc_id"]}:
            assert r["other_doc_id"] == r["doc_id"]


def test_one_copy_of_a_passage_stays(spark):
    rnd = random.Random(9)
    passage = " ".join(prose(rnd, 60))
    rows = [(i, " ".join([*prose(rnd, 30, 10_000), passage, *prose(rnd, 30, 10_000)])) for i in range(20)]
    docs = documents(spark, [*rows, (50, " ".join(prose(rnd, 90, 10_000)))])
    found = suffixes.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found if not r["removable"]} == set(range(20))
    assert all((r["start"], r["end"], r["n_words"]) == (30, 90, 60) and r["other_doc_id"] != r["doc_id"] for r in found)
    left = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(docs).collect()}
    assert [i for i in range(20) if passage in left[i]] == [0] and len(left) == 21
    assert all(len(left[i].split()) == 60 for i in range(1, 20))


def test_rows_alike_are_one(spark):
    text = " ".join(prose(random.Random(2), 80, 10_000))
    assert suffixes.repeated_passages(documents(spark, [(1, text), (1, text)])).collect() == []
    other = suffixes.repeated_passages(documents(spark, [(1, text), (1, text + " x")])).collect()
    assert sorted((r["removable"], r["start"], r["end"]) for r in other) == [(False, 0, 80), (False, 0, 80), (True, 0, 80)]
