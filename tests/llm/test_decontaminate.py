from __future__ import annotations

import random

import numpy as np
from helpers import documents, prose

from lakeloom.llm import decontaminate as d


def distance_within(pattern, text):
    """Fewest edits between the pattern and any part of the text, by the whole table."""
    row = np.zeros(len(text) + 1, int)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = np.array(new)
    return int(row.min())


def edited(rnd, text, n):
    out = list(text)
    for _ in range(n):
        k = rnd.randrange(len(out))
        out[k : k + 1] = rnd.choice([[], ["z"], [out[k], "q"]])
    return "".join(out)


def test_all_within_the_budget_are_found(spark):
    rnd = random.Random(1)
    items = [(i, " ".join(prose(rnd, 30, 10_000))) for i in range(8)]
    rows, expected = [], set()
    for i in range(60):
        before, after = " ".join(prose(rnd, 40, 10_000)), " ".join(prose(rnd, 40, 10_000))
        item = rnd.choice(items)
        part = edited(rnd, item[1][:130], rnd.randint(0, 16)) if i % 3 else ""
        rows.append((i, f"{before}\n{part.upper() if i % 2 else part} {after}"))
    index = d.Index.of(items)
    for doc_id, text in rows:
        codes, _ = d.letters(text)
        for s, segment in enumerate(index.segments):
            if distance_within(segment, codes) <= index.allowed[s]:
                expected.add((doc_id, int(index.items[index.segment_item[s]])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(documents(spark, rows), benchmark).collect()}
    assert found == expected and len(expected) > 20
    kept = {r["doc_id"] for r in d.without_benchmark(documents(spark, rows), benchmark).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in expected}


def test_several_slices_find_the_same(spark, monkeypatch):
    rnd = random.Random(2)
    items = [(i, " ".join(prose(rnd, 25, 10_000))) for i in range(12)]
    docs = documents(spark, [(i, "Some text. " + items[i][1] + " More.") for i in range(12)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, d.contaminated(docs, benchmark).collect()))
    docs = docs.union(documents(spark, [(90, "clean words " * 20), (91, None)]))
    monkeypatch.setattr(d, "SLICE_CHARS", 400)
    assert sorted(map(tuple, d.contaminated(docs, benchmark).collect())) == whole and len(whole) == 12
    assert sorted(r["doc_id"] for r in d.without_benchmark(docs, benchmark).collect()) == [90, 91]
    # an index is built, broadcast and used up before the next
    assert "ArrowEvalPython" not in d.contaminated(docs, benchmark)._jdf.queryExecution().toString()


def test_spans_are_of_the_source(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards brew tea in the old tower at noon"
    text = f"Né! -- {item.upper().replace(' ', '   ')} tail"
    row = d.contaminated(documents(spark, [(1, text)]), spark.createDataFrame([(9, item)], "item_id long, text string")).first()
    assert text[row["start"] : row["end"]].split() == item.upper().split() and row["edits"] == 0


def test_a_least_passage_is_found_at_every_offset():
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    for length in (66, 100, 186, 326):
        item = text(length)
        index = d.Index.of([(1, item), (2, text(200))])
        for at in range(length - d.PASSAGE + 1):
            found = index.matches(text(150) + item[at : at + d.PASSAGE] + text(150))
            assert [m[0] for m in found] == [1], (length, at)
    assert 50 <= d.PASSAGE <= 60


def test_more_segments_than_sixteen_bits_number():
    rnd = random.Random(5)
    items = [(i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20))) for i in range(70_000)]
    index = d.Index.of(items)
    assert len(index.segments) > 65_536
    for i in (0, 40_000, 65_600, 69_999):
        assert [m[0] for m in index.matches("1234567890" + items[i][1] + "0987654321")] == [i]


def test_items_without_id_count(spark):
    rnd = random.Random(6)
    items = [(None, " ".join(prose(rnd, 25, 10_000))), (None, " ".join(prose(rnd, 25, 10_000))), (7, " ".join(prose(rnd, 25, 10_000)))]
    docs = documents(spark, [(1, f"a {items[0][1]} b"), (2, f"a {items[1][1]} b"), (3, f"a {items[2][1]} b"), (4, "clean " * 30)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in d.contaminated(docs, benchmark).collect()) == [(1, None), (2, None), (3, 7)]
    assert [r["doc_id"] for r in d.without_benchmark(docs, benchmark).collect()] == [4]


def edits_between(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_a_span_is_as_far_from_its_segment_as_it_says():
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("abcdefgh ijklmno pqrstuv, wxyz.") for _ in range(n))
    seen = set()
    for i in range(150):
        item = text(100)
        index = d.Index.of([(1, item)])
        whole = text(80) + edited(rnd, item, rnd.randint(0, 9)) + text(80)
        long = index.segments[: index.n_long]
        if len(long) != 1:
            continue
        codes, _ = d.letters(whole)
        within = distance_within(long[0], codes) <= index.allowed[0]
        found = index.matches(whole)
        assert within <= bool(found)
        if found and within:
            _, start, end, edits, segments = found[0]
            part = d.letters(whole[start:end])[0]
            assert segments == 1 and edits_between(long[0].tolist(), part.tolist()) == edits <= index.allowed[0]
            seen.add(edits)
    assert len(seen) > 4


def test_letters_of_the_last_planes_count():
    item = "".join(chr(0x30000 + 37 * i) for i in range(40))
    assert [m[:3] for m in d.Index.of([(1, item)]).matches(f"xx{item}yy")] == [[1, 2, 42]]


def test_short_items_match_nothing():
    index = d.Index.of([(1, "multiple choice"), (2, "twenty letters or so here")])
    assert index.matches("a multiple choice question") == []
    assert [m[0] for m in index.matches("with Twenty letters, or so, here it is")] == [2]
