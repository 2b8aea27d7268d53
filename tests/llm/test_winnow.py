from __future__ import annotations

import hashlib
import random
import zlib

import regex
from helpers import documents, prose

from lakeloom.llm import winnow
from lakeloom.llm.winnow import BASE, PRIME, K, W


def fingerprint(text):
    """Plain winnowing: the rightmost smallest hash of each window of grams."""
    h = [zlib.crc32(t.encode()) % PRIME for t in regex.findall(winnow.TOKEN, text.lower())]
    if not h:
        return []
    if len(h) < K:
        a = 7
        for x in h:
            a = (a * BASE + x) % PRIME
        h = [a] * K
    power = [BASE]
    while 2 ** len(power) < K:
        power.append(power[-1] ** 2 % PRIME)
    grams, n = h, 1
    for p in power:
        grams = [(grams[i] * p + grams[i + n]) % PRIME for i in range(len(grams) - n)]
        n *= 2
    out = []
    for s in range(max(1, len(grams) - W + 1)):
        window = grams[s : s + W]
        low = min(window)
        at = max(s + i for i, g in enumerate(window) if g == low)
        if (low, at) not in out[-1:]:
            out.append((low, at))
    return out


def shown(f):
    return ",".join(f"{h}:{at}" for h, at in f)


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_plain_winnowing(spark):
    rnd = random.Random(1)
    rows = [(i * 3, " ".join(prose(rnd, rnd.choice([0, 1, 3, 4, 9, 12, 60, 200]), rnd.choice([2, 50])))) for i in range(40)] + [(500, None), (501, "z" * 50), (502, "é ß 𝔘 x y z w"), (503, "".join(rnd.choice("0123456789abcdef") for _ in range(300))), (504, "日本語のテキスト、句読点。漢字abc仮名" * 3)]
    ordered = sorted(rows)
    got = {r["doc_id"]: r for r in winnow.fingerprints(documents(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(ordered):
        text = text or ""
        following = ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        own, changed, near = fingerprint(text), fingerprint(edited), fingerprint(following)
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == shown(own) and r["edited_fingerprint"] == shown(changed)
        assert abs(r["near_edited"] - likeness(own, changed)) < 1e-12 and abs(r["near_next"] - likeness(own, near)) < 1e-12


def test_plan_is_native(spark):
    plan = winnow.fingerprints(documents(spark, [(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def shared(a, b):
    x, y = ({h for h, _ in fingerprint(t)} for t in (a, b))
    return len(x & y) / len(x)


def test_passages_without_blanks_are_found_wherever_they_stand():
    rnd = random.Random(2)
    han = "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(1000))
    line = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(4000))
    for text in (han, line):
        for shift in range(1, 9):
            assert shared(text, text[:shift] * 2 + text) > 0.98
            assert shared(text[500:], text) > 0.95


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "one two three four five"), (1, "six seven eight"), (1, "six seven eight"), (2, "nine ten"), (None, "a b c d"), (None, None)]
    out = winnow.fingerprints(documents(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "1", "1", "2", "None", "None"]
    twice = [r for r in out if r["n_chars"] == 15]
    assert len(twice) == 2 and twice[0] == twice[1]
