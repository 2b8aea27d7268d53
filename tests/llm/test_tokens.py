"""Token alignment against a plain version that encodes whole texts with the two libraries."""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, documents, with_clashes

from lakeloom.llm import tokens

FOLDER = tokens.FOLDER
pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/{tokens.PIECES}"), reason="the tokenizers' files are not here")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(f"{FOLDER}/{tokens.BYTE_LEVEL}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{tokens.PIECES}")
    letters = tokens.byte_letters()
    names = {i: t for t, i in a.get_vocab().items()}

    def bytes_b(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def encode(text):
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return x, [bytes(letters[c] for c in names[i]) for i in x], y, [bytes_b(i) for i in y]

    return encode


def plain_groups(text, encode):
    """Lists of A ids and of B ids of each group; none if the bytes differ."""
    if not text:
        return []
    a, a_bytes, b, b_bytes = encode(text)
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    ends = lambda some: [sum(map(len, some[: i + 1])) for i in range(len(some))] if len(some) < 500 else _ends(some)
    ends_a, ends_b = ends(a_bytes), ends(b_bytes)
    groups, i, j = [], 0, 0
    for e in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return groups


def _ends(some):
    found, at = [], 0
    for s in some:
        at += len(s)
        found.append(at)
    return found


def plain(rows, encode):
    """What the query returns for (doc_id, text) rows, by id."""
    groups = [(i, plain_groups(t, encode)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in groups]
    count = Counter(p for some in links for p in some)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    found = []
    for (i, g), some in zip(groups, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        found.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(some.values()),
            sum(n for p, n in some.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in some.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark, sf_dir, libraries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = plain([(r["doc_id"], r["text"]) for r in docs.collect()], libraries)
    assert rows_of(tokens.aligned(docs)) == expected
    assert sum(r[3] for r in expected) > 10_000


def test_pairs_are_counted_over_all_shards(spark, monkeypatch, libraries):
    rows = [(i, f"the quick brown fox number {i % 7} jumps over {'it ' * (i % 5)}again") for i in range(60)]
    expected = plain(rows, libraries)
    assert rows_of(tokens.aligned(documents(spark, rows).repartition(7))) == expected


AWKWARD = [
    "  two blanks in front", "blank at the end ", "a  b   c", "tab\tand\nline \n x", "é́ combined", "日本語のテキスト、句読点。", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢",
    "literal ▁ mark and a▁b", "<0x41> is no byte", "</s> <s> <unk> <|endoftext|> inside", "zero\x00byte", "no-break space and　wide", "\x1c file sep \x1c x",
    "it's 's 've I'LL don't", "x" * 5000, "http://a.b/c?d=e&f=%20", "1234567890 12 3.14", "ﬁ ligature ½ Å", " ", "\n", "\r\n\r\n", "😀 😀‍😀", "a b  c", "﻿bom", "mixed    runs",
]


def pair():
    return tokens.byte_level(f"{FOLDER}/{tokens.BYTE_LEVEL}"), tokens.pieces(f"{FOLDER}/{tokens.PIECES}")


def test_words_are_what_whole_texts_are(libraries):
    aligner = tokens.Aligner(*pair())
    assert aligner.right.by_word
    texts = [*AWKWARD, " ".join(AWKWARD), *[" ".join(t.split()) for t in AWKWARD]]
    for text, found in zip(texts, aligner.texts(texts), strict=True):
        groups = plain_groups(text, libraries)
        assert found.groups.decode() == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups), text
        assert found.n_links == sum(len(a) * len(b) for a, b in groups)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        wide = aligner.right.size
        assert dict(zip(found.pairs.tolist(), found.times.tolist(), strict=True)) == {x * wide + y: n for (x, y), n in links.items()}


def test_the_mark_of_a_blank_leaves_a_text_without_tokens(spark, libraries):
    found = {r["doc_id"]: r for r in tokens.aligned(documents(spark, [(1, "a▁b"), (2, "a b")])).collect()}
    assert found[1]["n_a"] == 0 and found[1]["groups_sha256"] == "" and found[2]["n_groups"] > 0


def test_a_forgetful_store_changes_nothing(monkeypatch, libraries):
    texts = [f"word{i} and {i % 3} others" for i in range(400)]
    expected = [x.groups for x in tokens.Aligner(*pair()).texts(texts)]
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    aligner = tokens.Aligner(*pair())
    assert [x.groups for i in range(0, 400, 7) for x in aligner.texts(texts[i : i + 7])] == expected


def test_a_large_group_costs_its_distinct_ids(monkeypatch):
    left, right = pair()
    rnd = np.random.default_rng(1)
    # letters that the sides cut at other places all along
    a = np.array([i for i, n in enumerate(left.spelled.lengths.tolist()) if n == 2])[rnd.integers(0, 50, 300)]
    b = np.array([i for i, n in enumerate(right.spelled.lengths.tolist()) if n == 1])[rnd.integers(0, 50, 2)]
    two = np.array([i for i, n in enumerate(right.spelled.lengths.tolist()) if n == 2])[rnd.integers(0, 50, 299)]
    b = np.concatenate([b[:1], two, b[1:]])
    expected = tokens.aligned_ids(a, b, left, right)
    assert (expected.n_groups, expected.n_links) == (1, 300 * 301)
    links = Counter((x, y) for x in a.tolist() for y in b.tolist())
    for many in (1 << 30, 1):
        monkeypatch.setattr(tokens, "MANY", many)
        found = tokens.aligned_ids(a, b, left, right)
        assert dict(zip(found.pairs.tolist(), found.times.tolist(), strict=True)) == {x * right.size + y: n for (x, y), n in links.items()}


def test_other_vocabularies_are_encoded_by_their_own_library(tmp_path):
    with open(f"{FOLDER}/{tokens.BYTE_LEVEL}", encoding="utf-8") as f:
        stated = json.load(f)
    # two merges change places, so ids are no ranks
    first, second = stated["model"]["merges"][:2]
    stated["model"]["merges"][:2] = [second, first]
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(stated, f)
    own = tokens.byte_level.__wrapped__(path)
    assert own.spelled.joined(own.encode(" some words <|endoftext|>")) == b" some words <|endoftext|>"


def test_group_ends():
    a, b = tokens.group_ends(np.array([1, 2, 3, 2]), np.array([3, 1, 1, 1, 2]))
    assert a.tolist() == [2, 3, 4] and b.tolist() == [1, 4, 5]
    a, b = tokens.group_ends(np.array([2, 2]), np.array([1, 2, 1]))
    assert a.tolist() == [2] and b.tolist() == [3]
    assert [len(x) for x in tokens.group_ends(np.array([], int), np.array([], int))] == [0, 0]


def test_awkward_rows(spark, libraries):
    table = awkward(spark)
    expected = plain([(r["doc_id"], r["text"]) for r in table.collect()], libraries)
    assert rows_of(tokens.aligned(with_clashes(table))) == expected
    assert tokens.aligned(table.limit(0)).collect() == []
