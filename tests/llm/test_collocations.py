"""Collocations against counts by hand; the query agrees with its SQL."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import pytest
from agreement import assert_agrees, connection
from helpers import awkward, with_clashes

from lakeloom.llm import collocations, queries

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, longest=4):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, all_ in counts.items():
        frequent = {p: a for p, a in all_.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in frequent.items():
            inside = [q for q, f in frequent.items() if len(q) > len(p) and 100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not inside:
                score, _, left, right = min((2_000_000 * a // (all_[p[:k]] + all_[p[k:]]), k, all_[p[:k]], all_[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(rnd, n):
    vocabulary = [f"w{i}" for i in range(30)] + ["Ärger", "É", "日本", "a-b", "0 1", "x\x00y"]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 40, 90]))]
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice([["New", "York", "City"], ["in", "spite", "of", "all"], ["spite", "of"], ["a", "a", "a", "a", "a", "a"]])
        text = "".join(w + rnd.choice([" ", " ", " ", " ", "\t ", ". ", ",", "\n", " ;\r\n", "!?"]) for w in words)
        rows.append((i, text, rnd.choice(["en", "en", "fr", None])))
    return rows


@pytest.mark.parametrize("shard_bytes,slice_,block", [(1 << 22, 1 << 22, 1 << 16), (300, 1 << 12, 1 << 8)])
def test_against_counts_by_hand(spark, monkeypatch, shard_bytes, slice_, block):
    # many shards and slices of a small sketch, so that counters are shared by several phrases
    for name, value in (("SHARD_BYTES", shard_bytes), ("SLICE", slice_), ("BLOCK", block)):
        monkeypatch.setattr(collocations, name, value)
    rows = corpus(random.Random(3), 200)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least, top in ((4, 2000), (9, 20)):
        expected = plain(rows, least, top)
        assert len(expected) > 20 and rows_of(collocations.collocations(table, least, top)) == expected


def test_agrees_with_its_sql(spark, sf_dir):
    name = "op12_phrase_collocations"
    assert_agrees(queries.QUERIES[name](spark, sf_dir), connection(sf_dir), queries.ORACLE_SQL[name])


def test_phrases_are_not_rows_of_each_task_that_has_them(spark, monkeypatch):
    # forty shards, each passed on by itself, have the same phrases
    monkeypatch.setattr(collocations, "HELD", 0)
    rnd, made = random.Random(8), {}
    text = " ".join(f"w{rnd.randrange(150)}" for _ in range(300))
    table = spark.createDataFrame([(i, text, "en") for i in range(40)], SCHEMA).repartition(40, "doc_id")
    plain_map = type(table).mapInPandas

    def counting(self, step, schema):
        rows = made[step.__qualname__] = spark.sparkContext.accumulator(0)

        def run(batches):
            for out in step(batches):
                rows.add(len(out))
                yield out

        return plain_map(self, run, schema)

    shards = table.selectExpr("doc_id as shard", "lang", "encode(text, 'UTF-8') as lines", "300L as n_words")
    monkeypatch.setattr(type(table), "mapInPandas", counting)
    found = {(r["phrase"], r["a"]) for r in collocations.frequent_phrases(shards, 30).collect()}
    words = text.split()
    assert found == set(Counter(" ".join(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1) for _ in range(40)).items())
    # 40 rows a phrase before
    assert max(rows.value for rows in made.values()) < 2 * len(found)


def test_counts_of_any_size_and_order_are_summed():
    import pandas as pd

    # the second task has a count past two bytes
    told = pd.DataFrame({"slices": [[0]], "places": [[bytes(4)]], "lang": ["en"]})
    blocks = []
    for lines in (b"a b\na b", b"\n".join([b"a b"] * 70_000)):
        hashes = [h >> 40 for _, _, h in collocations.phrase_hashes("en", collocations.Lines.of(lines), 2)]
        places = sorted({int(x) for h in hashes for x in h})
        batch = told.assign(lines=[lines], places=[[collocations.np.array(places, "u4").tobytes()]])
        blocks.append(pd.concat(collocations._counted(24, 2, 3)(iter([batch]))))
    blocks = pd.concat(blocks).sort_values(["part", "lang"])
    sums = pd.concat(collocations._summed(70_002)(iter([blocks.iloc[:2], blocks.iloc[2:]])))
    assert sorted(map(tuple, sums.to_numpy())) == [("en", "a", 70_002), ("en", "a b", 70_002), ("en", "b", 70_002)]
    assert not list(collocations._summed(70_003)(iter([blocks])))


@pytest.mark.parametrize("together", [1, 4])
def test_shards_share_rows_of_the_sketch(monkeypatch, together):
    import numpy as np
    import pandas as pd

    for name, value in (("SLICE", 1 << 8), ("BLOCK", 1 << 6), ("TOGETHER", 4)):
        monkeypatch.setattr(collocations, name, value)
    rnd, bits, least = random.Random(5), 13, 9
    lines = [" ".join(f"w{rnd.randrange(40)}" for _ in range(200)).encode() for _ in range(10)]
    own = [np.concatenate([h >> np.uint64(64 - bits) for *_, h in collocations.phrase_hashes("en", collocations.Lines.of(x))]).tolist() for x in lines]
    sums = sum(map(Counter, own), Counter())
    batch = pd.DataFrame({"shard": [7 * i for i in range(10)], "lang": "en", "lines": lines})
    rows = pd.concat(collocations._contributed(bits, 4)(iter([batch[:3], batch[3:]]))).sort_values("slice", kind="stable")
    # 32 slices, and 320 rows before
    assert len(rows) == 3 * 32
    frames = list(collocations._reached(least, together)(iter([rows[:50], rows[50:]])))
    # a frame for each shard and slice before
    assert len(frames) <= 32 // together
    found = sorted((s, at * 256 + p) for f in frames for s, at, b in f[["shard", "slice", "places"]].itertuples(index=False) for p in np.frombuffer(b, np.uint32).tolist())
    assert found == sorted((7 * i, c) for i, x in enumerate(own) for c in set(x) if sums[c] >= least)


def test_only_what_repeats_in_a_shard_is_scanned(monkeypatch):
    import numpy as np

    scans, scanned = [], collocations.scanned
    monkeypatch.setattr(collocations, "scanned", lambda text, phrases: scans.append((len(text), len(phrases))) or scanned(text, phrases))
    for lines, n in ((" ".join(f"w{i}" for i in range(500)).encode(), 0), (b"u v w x\na a a b\ny z a a a", 3)):
        told = np.unique(np.concatenate([h >> np.uint64(40) for *_, h in collocations.phrase_hashes("en", collocations.Lines.of(lines))]))
        phrases, _, counts = collocations.candidates_of("en", lines, told, 24, 4)
        pieces = [x.split(b" ") for x in lines.split(b"\n")]
        expected = Counter(b" ".join(x[i : i + k]) + b"\n" for x in pieces for k in range(1, 5) for i in range(len(x) - k + 1))
        assert dict(zip(phrases.to_pylist(), counts.tolist(), strict=True)) == expected
        # every candidate of two words or more before, over the whole shard
        assert scans[-1][1] <= n and scans[-1][0] <= 2 * 6 + 3


def test_overlapping_matches_and_piece_ends(spark):
    rows = [(i, "a a a. a a b", "en") for i in range(10)]
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA), 10, 10)
    assert rows_of(found) == plain(rows, 10, 10)
    assert {(r["phrase"], r["a"]) for r in found.collect()} >= {("a a a", 10), ("a a b", 10)}


def test_a_long_piece_is_cut_nowhere(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(collocations, "SHARD_BYTES", 20)
    text = "short one. " + "a long piece that has no end at all here " * 3 + ". one more, and another; x"
    shards = pd.concat(collocations._packed(iter([pd.DataFrame({"lang": ["en", "fr"], "text": [text, None]})])))
    assert b"\n".join(shards["lines"]) == collocations.pieces_of(text)
    assert shards["n_words"].sum() == len(re.findall(r"[^ .,;]+", text))
    assert all(len(x) <= 20 or b"\n" not in x for x in shards["lines"])


def test_hashing_a_shard_takes_little_beside_it():
    lines = b"ab cde f\n" * (collocations.SHARD_BYTES // 9) + b"x" * 300_000 + b" ab cde"
    of = collocations.Lines.of(lines)
    collocations._powers.cache_clear()
    tracemalloc.start()
    hashes = collocations.word_hashes(of)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * hashes.nbytes + (16 << 20)
    assert hashes[0] == hashes[3] == hashes[-2] and hashes[1] == hashes[-1] and len(set(hashes.tolist())) == 4


def test_scores_past_64_bits(spark):
    big = 4_000_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big), ("en", "a b", big - 1)], "lang string, phrase string, a long")
    # l + r itself stays within 64 bits, as a count of words must
    found = collocations.ranked(counts, spark.createDataFrame([("en", big)], "lang string, n long"), 5).collect()
    assert [(r["phrase"], r["score"]) for r in found] == [("a b", 2_000_000 * (big - 1) // (2 * big))]


def test_ties_go_to_the_first_cut_and_to_the_phrase(spark):
    rows = [(i, "p q r. s t. u v", "en") for i in range(5)] + [(9, "q r p q. p q r", "en")]
    assert rows_of(collocations.collocations(spark.createDataFrame(rows, SCHEMA), 3, 10)) == plain(rows, 3, 10)


def test_awkward_rows(spark):
    table = awkward(spark)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table.collect()]
    assert rows_of(collocations.collocations(with_clashes(table), 4, 50)) == plain(rows, 4, 50)
    assert collocations.collocations(table.limit(0)).collect() == []
