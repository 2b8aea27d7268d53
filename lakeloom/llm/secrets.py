"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are values assigned to telling names, tokens with known prefixes, key blocks and
long runs of mixed characters. Each is described by its length, its character transitions, how much
of it is dictionary words, whether it is part of a path, and the words beside it. A
random forest trained on labelled findings tells secrets from look-alikes (digests, ids, paths,
placeholders). Dictionary and transitions are those of the corpus: the DICTIONARY words that most of its texts
have, counted over all of them. Then scanning and scoring happen in one pass where the text lies.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, replaced

TREES, DEPTH, THRESHOLD = 40, 8, 0.5
#: Words of the dictionary, and texts that one of them is in at least.
DICTIONARY, LEAST_TEXTS = 20_000, 3
#: Characters of neighbouring text that a finding is judged by.
CONTEXT = 48

_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_NAME = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|(?:access|private|client|auth|account)[_-]?key|credentials?|auth)[\w-]{0,16}[\"']?\s{0,3}$", re.I)
# What may stand between the sign and the value, and what ends a value; that of a URL's parameter ends at the next one too.
_LEAD = re.compile(r"=?>?\s{0,3}[\"']?")
_STOP = re.compile(r"[\s\"'<>,;|]")
_STOP_PARAMETER = re.compile(r"[\s\"'<>,;|&]")
_PARAMETER = re.compile(r"[?&][\w.-]{1,47}$")
_BEGIN = re.compile(r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----")
_END = re.compile(r"-----END [A-Z ]{0,32}PRIVATE KEY-----")
# The lines of a key block that has no END line.
_BODY = re.compile(r"(?:\s++[A-Za-z0-9+/=]{16,}+)*+")
# Parts of a run between inner "="; those at the end of the run (padding) belong to the part before them.
_PIECE = re.compile(r"[^=]+(?:=+(?![A-Za-z0-9+/_=-]))?")
_PREFIX = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk_(?:live|test)_\w{16,}|xox[abprs]-[\w-]{10,}|eyJ[\w-]{8,}|AIza[\w-]{30,}|glpat-[\w-]{20}")
_INNER = re.compile(rf"(?<![A-Za-z0-9])(?:{_PREFIX.pattern})")

# Words that speak for or against a secret beside it.
_FOR = frozenset("token key secret password passwd pwd passphrase credential credentials auth apikey bearer authorization private".split())
_AGAINST = frozenset(
    "sha sha1 sha256 md5 commit checksum digest hash uuid guid id version revision example sample test dummy placeholder "
    "changeme fingerprint etag build trace session public path file url image isbn".split()
)
# Common words, which a dictionary has in any case.
_WORDS = (
    "about account action address after again application array audio author base before begin between book branch build button "
    "cache change channel character check class client code color column command common company config connection content context "
    "control copy count country create current data database date default delete description design detail device directory "
    "document domain download editor element email empty enable error event example false field file filter final first folder form "
    "format function general global group header height help history home image import index info input instance integer "
    "interface internal item key label language last layout length level library license line link list local location login main "
    "manager map master media member memory menu message method mobile model module month name network never node normal note number "
    "object offset option order output package page parameter parent password path pattern people place placeholder plugin point port position "
    "power prefix price private process product profile program project property protocol public query question random range read "
    "record region release remote report request resource response result return right role root sample save schema screen script "
    "search second secret section select server service session setting share shop simple size source space special staff standard start state "
    "static status storage store stream string style subject support system table target task template test text theme this time title "
    "token tool total track training type unit update upload user value variable version video view visible warning website width window "
    "with word work world write year your their there these which would other people because through"
).split()


@dataclass
class Language:
    """The words of ordinary text, and log-probabilities of its letter pairs (26 stands for what is no letter)."""

    words: list[str]
    known: frozenset[str]
    pairs: np.ndarray

    @classmethod
    def of(cls, counts: list[tuple[str, int]]) -> Language:
        """From words with how often they occur; pairs count as often as 100,000 letters would have them, and once more."""
        words = list(dict.fromkeys([*_WORDS, *(w for w, _ in counts)]))
        weight = dict.fromkeys(_WORDS, 1) | dict(counts)
        n, scale = np.zeros((27, 27)), 1e5 / sum(weight[w] * len(w) for w in words)
        for w in words:
            codes = [ord(c) - 97 for c in w]
            for a, b in zip(codes, codes[1:], strict=False):
                n[a, b] += weight[w] * scale
        n += 1
        return cls(words, frozenset(w for w in words if len(w) > 3), np.log(n / n.sum(1, keepdims=True)))

    def covered(self, text: str) -> int:
        """How many characters of a lower-cased text are words, the longest first at each place."""
        total = 0
        for run in _LETTERS.findall(text):
            at = 0
            while at + 4 <= len(run):
                size = next((n for n in range(min(16, len(run) - at), 3, -1) if run[at : at + n] in self.known), 0)
                total += size
                at += size or 1
        return total


_LETTERS = re.compile(r"[a-z]{4,}")


@lru_cache(maxsize=1)
def plain_language() -> Language:
    return Language.of([])


def language_of(docs: DataFrame) -> Language:
    """The language of all ``docs`` (text, ...); without texts that of common words alone."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit("[a-z]{4,16}"), F.lit(0)))
    counts = pick(docs, "text").where("text is not null").select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") >= LEAST_TEXTS).orderBy(F.col("n").desc(), "word").limit(DICTIONARY)
    # gathered by a task: as the last step, the limit would send as many rows of every task to the driver
    rows = top.agg(F.collect_list(F.struct("n", "word")).alias("words")).first()["words"]
    return Language.of([(r["word"], r["n"]) for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))])


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(left: str, value: str, right: str, language: Language) -> list[float]:
    """What the forest judges a finding by; left and right are its neighbouring text."""
    n, low = len(value), value.lower()
    codes = [ord(c) - 97 if "a" <= c <= "z" else 26 for c in low]
    table, pairs = language.pairs, list(zip(codes, codes[1:], strict=False))
    kinds = [_class(c) for c in value]
    counts = Counter(value)
    entropy = -sum(v / n * np.log2(v / n) for v in counts.values())
    near = re.findall(r"[a-z0-9]+", left.lower())[-6:]
    after = re.findall(r"[a-z0-9]+", right.lower())[:2]
    return [
        n,
        float(np.mean([table[p] for p in pairs])) if pairs else 0.0,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        entropy,
        len(counts) / n,
        kinds.count(2) / n,
        kinds.count(1) / n,
        float(all(c in string.hexdigits for c in value)),
        language.covered(low) / n,
        value.count("/") + value.count("."),
        float(bool(re.search(r"[/\\.]$", left)) or bool(re.match(r"[/\\]|\.[a-z]{2,4}\b", right))),
        float(any(w in _FOR for w in near)),
        float(any(w in _AGAINST for w in [*near, *after])),
        float(bool(re.search(r"[=:]\s*[\"']?$", left))),
        float(bool(_PREFIX.match(value)) or value.startswith("-----BEGIN")),
        max(counts.values()) / n,
    ]


@dataclass
class Forest:
    """Trees in arrays: the feature of each node (-1: leaf), its limit, its two children, its share of secrets."""

    trees: list[tuple[np.ndarray, ...]]
    language: Language

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, limit, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                go = x[rows, np.maximum(feature[at], 0)] <= limit[at]
                at = np.where(feature[at] < 0, at, np.where(go, left[at], right[at]))
            total += share[at]
        return total / max(1, len(self.trees))


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def split(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if depth == 0 or len(rows) < 4 or y[rows].min() == y[rows].max():
            return me
        best = (np.inf, -1, 0.0)
        for f in rng.choice(x.shape[1], int(np.ceil(np.sqrt(x.shape[1]))), replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, t = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut):
                n, ones = cut + 1, t[cut]
                rest, rest_ones = len(rows) - n, t[-1] - ones
                gini = ones * (n - ones) / n + rest_ones * (rest - rest_ones) / rest
                i = int(gini.argmin())
                best = min(best, (float(gini[i]), int(f), float((v[cut[i]] + v[cut[i] + 1]) / 2)))
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            nodes[me][:2] = best[1:]
            nodes[me][2] = split(rows[low], depth - 1)
            nodes[me][3] = split(rows[~low], depth - 1)
        return me

    split(rng.integers(0, len(y), len(y)), DEPTH)
    feature, limit, left, right, share = map(np.array, zip(*nodes, strict=True))
    return feature.astype(np.int64), limit.astype(float), left.astype(np.int64), right.astype(np.int64), share.astype(float)


def train(findings: list[tuple[str, str, str, int]], language: Language | None = None, trees: int = TREES, seed: int = 11) -> Forest:
    """A forest from labelled findings (left, value, right, 1 if secret)."""
    language = language or plain_language()
    x = np.array([features(a, v, b, language) for a, v, b, _ in findings])
    y = np.array([label for *_, label in findings], float)
    rng = np.random.default_rng(seed)
    return Forest([_grow(x, y, rng) for _ in range(trees)], language)


def made_findings(n: int = 1500, seed: int = 7, language: Language | None = None) -> list[tuple[str, str, str, int]]:
    """Labelled findings made from templates, in words of the language: the training set where no reviewed one is at hand."""
    vocabulary = (language or plain_language()).words
    rng = np.random.default_rng(seed)
    pick_one = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(alphabet[int(i)] for i in rng.integers(0, len(alphabet), k))
    words = lambda k, sep=" ": sep.join(pick_one(vocabulary) for _ in range(k))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    name = lambda: pick_one(["token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "pwd", "private_key"])
    benign = lambda: pick_one(["commit", "sha256", "md5", "checksum", "digest", "uuid", "build id", "etag", "revision", "fingerprint", "trace id", "hash"])
    sign = lambda: pick_one([" = ", "=", ": ", ":", " := "])

    def secret() -> tuple[str, str, str, int]:
        quote = pick_one(['"', "'", ""])
        value = pick_one([chars(hexes, int(rng.integers(24, 72))), chars(hexes.upper(), 40), chars(alnum, int(rng.integers(16, 64))), chars(alnum + "+/", 40) + "=", chars(alnum + "!@#$%^&*", int(rng.integers(10, 24))),
                          "AKIA" + chars(string.ascii_uppercase + string.digits, 16), "ghp_" + chars(alnum, 36), "sk_live_" + chars(alnum, 24)])
        left = f"{words(4)} {name()}{sign()}{quote}" if rng.random() < 0.85 or not _PREFIX.match(value) else f"{words(5)} "
        return left.upper() if rng.random() < 0.1 else left, value, f"{quote} {words(2)}", 1

    def lookalike() -> tuple[str, str, str, int]:
        kind = int(rng.integers(8))
        if kind == 0:
            return f"{words(3)} {benign()}{pick_one([' ', ': ', '='])}", chars(hexes, pick_one([32, 40, 64])), f" {words(2)}", 0
        if kind == 1:
            return f"{words(3)} {pick_one(['uuid', 'id', 'session'])}{sign()}", "-".join(chars(hexes, k) for k in (8, 4, 4, 4, 12)), f" {words(2)}", 0
        if kind == 2:
            return f"{words(3)} /", words(int(rng.integers(3, 6)), "/"), pick_one([".py", ".html", "/", " "]) + words(1), 0
        if kind == 3:
            value = pick_one([f"your_{words(1)}_here", "changeme" * 2, "x" * int(rng.integers(8, 33)), f"<{words(1)}-{words(1)}>", "example" + words(1), f"{words(1)}_{words(1)}_{words(1)}", "*" * 12, "placeholder"])
            return f"{words(3)} {name()}{sign()}{pick_one(['', chr(34)])}", value, f" {words(2)}", 0
        if kind == 4:
            return f"{words(4)} ", words(int(rng.integers(2, 5)), pick_one(["_", "-", ""])) + pick_one(["", "2", "10"]), f" {words(2)}", 0
        if kind == 5:
            return f"{words(4)} ", chars("0123456789", int(rng.integers(16, 22))), f" {words(2)}", 0
        if kind == 6:
            return f"{words(4)} {pick_one(['', '|'])}", pick_one(["-", "=", "_", "+"]) * int(rng.integers(16, 80)), f" {words(2)}", 0
        return f"{words(2)} {name()} {pick_one(['is', 'of', 'for'])}{sign()}", f"{words(1)}{pick_one(['', '.', '-'])}{words(1)}", f" {words(3)}", 0

    return [secret() if i % 2 else lookalike() for i in range(n)]


def _blocks(text: str) -> list[tuple[str, int, int]]:
    """Key blocks up to their END line, whatever their length; without one before the next block, the lines of the body."""
    begins = [m.span() for m in _BEGIN.finditer(text)]
    ends = [m.span() for m in _END.finditer(text)] if begins else []
    found, e = [], 0
    for i, (a, b) in enumerate(begins):
        while e < len(ends) and ends[e][0] < b:
            e += 1
        closed = e < len(ends) and (i + 1 == len(begins) or ends[e][0] < begins[i + 1][0])
        found.append(("block", a, ends[e][1] if closed else _BODY.match(text, b).end()))
    return found


def _assigned(text: str) -> list[tuple[str, int, int]]:
    """Values assigned to telling names, up to their delimiter, whatever their length."""
    found = []
    for sign in "=:":
        at, ends = text.find(sign), {}
        while at >= 0:
            if _NAME.search(text, max(0, at - CONTEXT), at):
                a = _LEAD.match(text, at + 1).end()
                stop = _STOP_PARAMETER if _PARAMETER.search(text, max(0, at - CONTEXT), at) else _STOP
                # values that overlap end together, so the text is read once
                if a > (end := ends.get(stop, -1)):
                    end = ends[stop] = m.start() if (m := stop.search(text, a)) else len(text)
                if end - a >= 6:
                    found.append(("assigned", a, end))
            at = text.find(sign, at + 1)
    return found


def _pieces(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Known tokens and other runs. A run is split at each inner "=", and where a known token begins in it."""
    known, runs = [], []
    for m in _RUN.finditer(text):
        for p in _PIECE.finditer(text, *m.span()):
            k = _INNER.search(text, *p.span())
            if k:
                known.append(("known", k.start(), p.end()))
            runs.append(("run", p.start(), k.start() if k else p.end()))
    return known, runs


def _apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """By start, the longest first; what overlaps one before it goes."""
    out, end = [], -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out.append((kind, a, b))
            end = b
    return out


def _outside(spans: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The parts of ``spans`` outside ``taken``; both are by start and without overlaps."""
    out, i = [], 0
    for kind, a, b in spans:
        while i < len(taken) and taken[i][2] <= a:
            i += 1
        j = i
        while j < len(taken) and taken[j][1] < b:
            if a < taken[j][1]:
                out.append((kind, a, taken[j][1]))
            a = max(a, taken[j][2])
            j += 1
        if a < b:
            out.append((kind, a, b))
    return out


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all candidates of a whole text, without overlaps, by start.

    Key blocks come first, then assigned and known values, then what of the runs lies outside both.
    """
    if not text:
        return []
    out = _blocks(text) if "PRIVATE KEY-----" in text else []
    known, runs = _pieces(text)
    out = sorted([*out, *(s for s in _outside(_apart(_assigned(text) + known), out) if s[2] - s[1] >= 6)], key=lambda s: s[1])
    rest = [s for s in _outside(runs, out) if s[2] - s[1] >= 16 and sum(map(str.isdigit, text[s[1] : s[2]])) > 1]
    out += rest
    # a run with inner "=" of which no part is a candidate stays one
    whole = [("run", *m.span()) for m in _RUN.finditer(text) if sum(map(str.isdigit, m[0])) > 1]
    taken = sorted(out, key=lambda s: s[1])
    i = 0
    for s in whole:
        while i < len(taken) and taken[i][2] <= s[1]:
            i += 1
        if i == len(taken) or taken[i][1] >= s[2]:
            out.append(s)
    return sorted(out, key=lambda s: s[1])


def judged(text: str | None, forest: Forest) -> list[tuple[str, int, int, float]]:
    spans = candidates(text)
    if not spans:
        return []
    x = np.array([features(text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT], forest.language) for _, a, b in spans])
    return [(*s, float(p)) for s, p in zip(spans, forest.scores(x), strict=True)]


def trained_on(docs: DataFrame) -> Forest:
    """A forest for these texts: of their language, trained on made findings in it."""
    language = language_of(docs)
    return train(made_findings(language=language), language)


def findings(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """(doc_id, kind, start, end, score, is_secret): one row per candidate, rejected ones too.

    Offsets are in code points. Null, empty and clean texts give no rows, nor does an empty table; repeated rows repeat
    theirs, and those of a row without doc_id have a null one. Texts and values of any length are read whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(forest or trained_on(docs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch["doc_id"], batch["text"], strict=True) for f in judged(t, held.value)]
            out = pd.DataFrame(rows, columns=["doc_id", "kind", "start", "end", "score"])
            out["is_secret"] = out["score"] >= THRESHOLD
            yield out.astype({"doc_id": "Int64", "is_secret": bool})

    return pick(docs, "doc_id", "text").mapInPandas(run, "doc_id long, kind string, start long, end long, score double, is_secret boolean")


def redacted(text: Column, held, mark: str = "[SECRET]") -> Column:
    """``text`` with each secret replaced by ``mark``; ``held`` is the broadcast forest."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                for _, a, b, score in reversed(judged(t, held.value)):
                    if score >= THRESHOLD:
                        t = t[:a] + mark + t[b:]
                out.append(t)
            yield pd.Series(out, dtype="object")

    return run(text)


def without_secrets(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """``docs`` with secrets masked in ``text`` and ``n_chars`` counted anew; every row stays.

    Null and empty texts stay as they are, with their length; rows alike stay alike, an empty table stays empty. Texts of any length are masked whole.
    Other columns stay, whatever their names; without ``n_chars`` there is none to count.
    """
    held = docs.sparkSession.sparkContext.broadcast(forest or trained_on(docs))
    masked = replaced(docs, "text", lambda text: redacted(text, held))
    if "n_chars" not in docs.columns:
        return masked
    places = masked.toDF(*[f"c{i}" for i in range(len(masked.columns))])
    length = F.length(f"c{docs.columns.index('text')}").cast(dict(docs.dtypes)["n_chars"])
    return places.withColumn(f"c{docs.columns.index('n_chars')}", length).toDF(*docs.columns)
