from __future__ import annotations

import random
import string

from helpers import documents
from pyspark.sql import functions as F

from lakeloom.llm import secrets


def made(alphabet, n, seed=1):
    rnd = random.Random(seed)
    return "".join(rnd.choice(alphabet) for _ in range(n))


ALNUM = string.ascii_letters + string.digits


def found_and_masked(spark, rows):
    docs = documents(spark, rows)
    found = {}
    for r in secrets.findings(docs).where(F.col("is_secret")).collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    return found, {r["doc_id"]: r["text"] for r in secrets.without_secrets(docs).collect()}


def test_values_assigned_without_blank_or_quote(spark):
    cases = [
        ("api_key=", made("0123456789abcdef", 40)),
        ("API_KEY=", "sk_live_" + made(ALNUM, 24)),
        ("DB_PASSWORD=", "ab12cd!efG7#kQ"),
        ("AWS_SECRET_ACCESS_KEY=", made(ALNUM, 24) + "/" + made(ALNUM, 14, 2) + "="),
        ("https://host.org/get?page=1&access_token=", made(ALNUM, 40)),
        ("mode=", "AKIA" + made(string.ascii_uppercase + string.digits, 16)),
    ]
    rows = [(i, f"first {name}{value} then more words") for i, (name, value) in enumerate(cases)]
    found, masked = found_and_masked(spark, rows)
    for i, (name, value) in enumerate(cases):
        at = rows[i][1].index(value)
        assert found.get(i) == [(at, at + len(value))], name
        assert masked[i] == f"first {name}[SECRET] then more words"


def test_runs_are_split_and_kept():
    text = f"commit={made('0123456789abcdef', 40)} a=1234567b=89abcdefg"
    assert [text[a:b] for _, a, b in secrets.candidates(text)] == [text[7:47], "a=1234567b=89abcdefg"]


def test_long_values_and_blocks_go_whole(spark):
    jwt = ".".join(["eyJ" + made(ALNUM + "-_", 200), "eyJ" + made(ALNUM + "-_", 500, 2), made(ALNUM + "-_", 90, 3)])
    body = "\n".join(made(ALNUM + "+/", 64, i) for i in range(400))
    plain = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
    headed = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{made('0123456789ABCDEF', 32)}\n\n{body[:640]}\n-----END RSA PRIVATE KEY-----"
    values = [jwt, plain, headed]
    rows = [(0, f"first token = {jwt} then more words"), (1, f"first {plain} then more words"), (2, f"first {headed} then more words")]
    found, masked = found_and_masked(spark, rows)
    for i, value in enumerate(values):
        at = rows[i][1].index(value)
        assert found.get(i) == [(at, at + len(value))]
        assert masked[i] == rows[i][1].replace(value, "[SECRET]")


def test_blocks_without_an_end_line_take_their_body_alone():
    body = "\n".join(made(ALNUM + "+/", 64, i) for i in range(3))
    closed = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
    text = f"-----BEGIN EC PRIVATE KEY-----\n{body}\n\nsome words {closed} some words"
    assert [text[a:b] for _, a, b in secrets.candidates(text)] == [f"-----BEGIN EC PRIVATE KEY-----\n{body}", closed]


def test_many_signs_in_one_value_are_read_once():
    text = "token=" * 100_000
    assert secrets.candidates(text)[0][1:] == (6, len(text))


def test_an_ampersand_ends_parameters_alone():
    for text, value in [("x PASSWORD=abc12&def=34gh y", "abc12&def=34gh"), ("http://h/?a=1&token=abc123def&b=2 y", "abc123def")]:
        assert value in [text[a:b] for _, a, b in secrets.candidates(text)]


def test_all_that_is_assigned_or_mixed_is_a_candidate():
    """Against a plain search at each place, on texts put together at random."""
    import re

    rnd = random.Random(9)
    pieces = ["api_key", "password", "TOKEN", "secret", "name", "=", "=", ": ", " = ", ":", '"', "'", " ", " ", "\n", ",", ";", "&", "?", "ab12cd34ef56ab78", "sk_live_abcdefghijklmnop1234", "A" * 20, "9f8e7d6c5b4a39281706", "x!y#z1$2", "/path/to/file1/file2/x", "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "é"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 18)))
        spans = secrets.candidates(text)
        assert all(a < b for _, a, b in spans) and all(x[2] <= y[1] for x, y in zip(spans, spans[1:], strict=False)), text
        held = set().union(*(range(a, b) for _, a, b in spans)) if spans else set()
        for at, sign in enumerate(text):
            name = re.search(r"(?:pass(?:word)?|secret|token|api_key)[\"']?\s{0,3}$", text[:at], re.I)
            if sign not in "=:" or not name:
                continue
            lead = re.match(r"=?>?\s{0,3}[\"']?", text[at + 1 :]).end()
            start = end = at + 1 + lead
            stops = "\"'<>,;| \n\t" + ("&" if re.search(r"[?&][\w.-]{1,47}$", text[:at]) else "")
            while end < len(text) and text[end] not in stops:
                end += 1
            if end - start >= 6 and not any(k == "block" and a < end and start < b for k, a, b in spans):
                assert set(range(start, end)) <= held, (text, text[start:end])
        for m in re.finditer(r"-----BEGIN PRIVATE KEY-----", text):
            assert set(range(*m.span())) <= held, text
        for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}(?![A-Za-z0-9+/_=-])", text):
            if sum(map(str.isdigit, m[0])) > 1:
                assert held & set(range(*m.span())), (text, m[0])


def test_words_of_the_corpus_are_its_dictionary(spark):
    rows = [(i, f"zyxwa lorem qwrtz{i} " + ("rare1word" if i < 2 else "")) for i in range(5)] + [(9, None), (10, "")]
    language = secrets.language_of(documents(spark, rows))
    assert {"zyxwa", "lorem", "password"} <= language.known and "rare" not in language.known
    assert language.covered("zyxwalorem12zzzz") == 10
    assert secrets.language_of(documents(spark, [(1, None)])).words == secrets.plain_language().words
