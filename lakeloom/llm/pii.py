"""Personal data in text: plain patterns, and disguised ones found by offset-preserving deobfuscation.

The plain pass finds emails, IPv4 addresses, card numbers and phone numbers as written. The
second pass runs transducers over the text: each rewrites a piece (a homoglyph, a spelled
digit, an "at" or "dot" disguise) and keeps, for every character of the rewritten text, the
source range that it came from. What the patterns find in the rewritten text maps back to source
offsets, and counts when it overlaps no plain finding of its kind. Offsets are in code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import pick

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# An address or, so that the scan stays linear, the digits that begin none.
_IP = re.compile(r"[0-9]++(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match holds an @, so the search starts there; equal to a leftmost search for the whole."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def plain_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, less those that fail its test."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if m[1] and all(map(_small, m[0].split("."))):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# Cyrillic and Greek letters that look like Latin ones, each before its double.
_LOOKALIKES = """
А A  В B  Е E  К K  М M  Н H  О O  Р P  С C  Т T  Х X  У Y  І I  Ј J  Ѕ S
а a  е e  о o  р p  с c  у y  х x  і i  ј j  ѕ s  ԁ d  ԛ q  ԝ w  һ h  ո n
Α A  Β B  Ε E  Ζ Z  Η H  Ι I  Κ K  Μ M  Ν N  Ο O  Ρ P  Τ T  Υ Y  Χ X  ο o  ν v
ı i  ɡ g  ⅼ l  ﹫ @  ․ .  。 .  ‐ -  ‑ -  – -  — -  ¹ 1  ² 2  ³ 3  ⁰ 0
""".split()
_HOMOGLYPHS = dict(zip(_LOOKALIKES[::2], _LOOKALIKES[1::2], strict=True))
# full-width forms; digits of other scripts and styles; styled mathematical letters; odd spaces
_HOMOGLYPHS |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
_HOMOGLYPHS |= {chr(base + d): str(d) for base in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6, 0x2080) for d in range(10)}
_HOMOGLYPHS |= {chr(0x2074 + d): str(4 + d) for d in range(6)} | {chr(0x2460 + d): str(1 + d) for d in range(9)}
_HOMOGLYPHS |= {chr(base + i): chr(65 + i % 26 + 32 * (i >= 26)) for base in (0x1D400, 0x1D5A0, 0x1D5D4, 0x1D670) for i in range(52)}
_HOMOGLYPHS |= {chr(c): " " for c in (0xA0, 0x2002, 0x2003, 0x2007, 0x2009, 0x202F, 0x3000)}
# code points that show nothing
_UNSEEN = frozenset(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
# The spelled digits.
_DIGITS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789", strict=True))
_FOLDS, _FOLDABLE = str.maketrans(_HOMOGLYPHS), _UNSEEN | _HOMOGLYPHS.keys()
_FOLDED = re.compile("[" + "".join(map(re.escape, [*_HOMOGLYPHS, *_UNSEEN])) + "]")
_DIGIT_TOKEN = re.compile(rf"(?<![A-Za-z])(?:(?P<word>{'|'.join(_DIGITS)})|(?P<point>dot|point))(?![A-Za-z])|(?P<mark>[\[(](?:\.|dot|point)[\])])|(?P<number>[0-9]+)", re.I)
# What may stand between spelled digits.
_BETWEEN = re.compile(r"[ ,.()-]{1,3}")
_PLUS = re.compile(r"(?<![A-Za-z])plus ?(?=[0-9])", re.I)
# So many digits in a row are worth reading.
_FEWEST = 10
_AT = re.compile(r"\s?[\[({<]\s?(?:at|@|arroba)\s?[\])}>]\s?|\s?@\s?|\s(?:at|arroba)\s|_at_|-at-", re.I)
_DOT = re.compile(r"\s?[\[({<]\s?(?:dot|\.|punto)\s?[\])}>]\s?|\s(?:dot|punto)\s|_dot_|-dot-|\s\.\s?", re.I)
_HOST_LABEL, _NAME_CHAR = re.compile(r"[A-Za-z0-9-]+"), re.compile(r"[A-Za-z0-9._%+-]")
# "at" before a host with plain dots, which counts if it ends in a top-level domain. The usual ones.
_AT_HOST = re.compile(r"\s(?:at|arroba)\s(?=(?:[a-z0-9-]++\.)+(?:com|org|net|edu|gov|mil|int|info|biz|io|ai|dev|app|eu|uk|us|ca|au|de|at|ch|fr|es|it|nl|be|se|no|dk|fi|pl|pt|br|mx|ar|cl|co|in|jp|cn|kr|ru)(?![a-z0-9-]|\.[a-z0-9-]))", re.I)
# What a text must hold, lower-cased, for the transducers to find anything: a spelled digit beside another digit or a point, or a disguised point
# between numerals; a sign or word for "at" in brackets, or one before something with a dot. Patterns begin with what can be looked for fast.
_WORDS = "|".join(_DIGITS)
_POINT = r"[ .-]?[\[(]?(?:dot|point|\.)[\])]?[ .-]?"
_BESIDE = re.compile(rf"(?:{_WORDS})(?:[ ,.()-]{{0,3}}|{_POINT})(?:{_WORDS}|[0-9])|[0-9](?:[ ,.()-]{{0,3}}|{_POINT})(?:{_WORDS})|[0-9][ .-]?(?:dot|point|[\[(](?:dot|point|\.)[\])])[ .-]?[0-9]")
_AT_WORDS = tuple(f"{word}{blank}{end}" for word in ("at", "arroba") for blank in ("", " ") for end in "])}>") + ("_at_", "-at-")
_HIDDEN_DOTS = ("dot", "punto", *(f"{start}{blank}." for start in "[({<" for blank in ("", " ")))
_BARE_AT = re.compile(r"at\s[a-z0-9-]+\.[a-z0-9]")


class Tape:
    """Text that came from another tape by edits, and the source range of each of its characters."""

    def __init__(self, text: str, before: Tape | None = None, edits: list[tuple[int, int, str]] | None = None):
        self.text, self.before, self.edits = text, before, edits or []
        # where each edit's text begins and ends here
        self.begins, self.ends, shift = [], [], 0
        for lo, hi, new in self.edits:
            self.begins.append(lo + shift)
            self.ends.append(lo + shift + len(new))
            shift += len(new) - (hi - lo)

    def rewritten(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace ranges, in order; each new character comes from its whole range."""
        if not edits:
            return self
        text, at = [], 0
        for lo, hi, new in edits:
            text += [self.text[at:lo], new]
            at = hi
        return Tape("".join([*text, self.text[at:]]), self, edits)

    def _range(self, place: int) -> tuple[int, int]:
        """The range of the tape before that a character comes from."""
        i = bisect_right(self.begins, place) - 1
        if i < 0:
            return place, place + 1
        lo, hi, _ = self.edits[i]
        if place < self.ends[i]:
            return lo, hi
        place += hi - self.ends[i]
        return place, place + 1

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        """The source range of the characters from ``lo`` to ``hi``, which is exclusive."""
        if self.before is None:
            return lo, hi
        return self.before.source(self._range(lo)[0], self._range(hi - 1)[1])


def fold_homoglyphs(tape: Tape) -> Tape:
    if _UNSEEN.isdisjoint(tape.text):
        # one character for each: every place stays
        return Tape(tape.text.translate(_FOLDS), tape.before, tape.edits)
    return tape.rewritten([(*m.span(), _HOMOGLYPHS.get(m[0], "")) for m in _FOLDED.finditer(tape.text)])


# A token: start, end, its digits (None for a point between octets), and whether it disguises them.
Token = tuple[int, int, str | None, bool]


def _digit_tokens(text: str) -> list[Token]:
    out: list[Token] = []
    for m in _DIGIT_TOKEN.finditer(text):
        word, number = m["word"], m["number"]
        out.append((*m.span(), _DIGITS[word.lower()] if word else number, number is None))
    return out


def _octet(tokens: list[Token], from_end: bool) -> list[Token]:
    """As many of the tokens at one end as make an octet of three digits at most."""
    out, n = [], 0
    for t in tokens[::-1] if from_end else tokens:
        n += len(t[2] or "")
        if n > 3:
            break
        out.append(t)
    return out[::-1] if from_end else out


def _addresses(text: str, tokens: list[Token]) -> list[tuple[int, int, str]]:
    """Edits for four octets, spelled or not, with points between them of which something is disguised."""
    edits, parts, points, end = [], [[]], [], -2

    def finish() -> None:
        i = 0
        while i + 3 < len(parts):
            four = [_octet(parts[i], True), parts[i + 1], parts[i + 2], _octet(parts[i + 3], False)]
            used = [t for part in four for t in part]
            octets = ["".join(t[2] for t in part) for part in four]
            fit = all(0 < len(o) <= 3 and int(o) <= 255 for o in octets) and (any(points[i : i + 3]) or any(t[3] for t in used))
            if fit and not (used[0][0] and text[used[0][0] - 1].isalnum()) and not text[used[-1][1] : used[-1][1] + 1].isalnum():
                edits.append((used[0][0], used[-1][1], ".".join(octets)))
                i += 4
            else:
                i += 1

    for t in tokens:
        gap = text[end : t[0]] if t[0] - end <= 1 else None
        if gap not in ("", " ", "-", "."):
            finish()
            parts, points = [[]], []
        elif gap == "." and parts[-1] and t[2] is not None:
            parts.append([])
            points.append(False)
        if t[2] is None:
            if parts[-1]:
                parts.append([])
                points.append(True)
        else:
            parts[-1].append(t)
        end = t[1]
    finish()
    return edits


def _spelled(text: str, tokens: list[Token], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits for digits in a row of which some are spelled."""
    edits, row, t = [], [], 0

    def finish() -> None:
        digits = "".join(x[2] for x in row)
        if len(digits) >= _FEWEST and any(x[3] for x in row):
            edits.append((row[0][0], row[-1][1], digits))

    for token in tokens:
        while t < len(taken) and taken[t][1] <= token[0]:
            t += 1
        usable = token[2] is not None and not (t < len(taken) and taken[t][0] < token[1])
        if row and not (usable and token[0] - row[-1][1] <= 3 and _BETWEEN.fullmatch(text, row[-1][1], token[0])):
            finish()
            row = []
        if usable:
            row.append(token)
    finish()
    return edits


def read_digits(tape: Tape) -> Tape:
    """Spelled digits in a row become digits; separators between them go, a plus before them stays."""
    tokens = _digit_tokens(tape.text)
    if any(t[3] for t in tokens):
        addresses = _addresses(tape.text, tokens)
        tape = tape.rewritten(sorted(addresses + _spelled(tape.text, tokens, addresses)))
    return tape.rewritten([(*m.span(), "+") for m in _PLUS.finditer(tape.text)])


def join_addresses(tape: Tape) -> Tape:
    """"name at host dot org" and its kin become addresses.

    From each disguise of "at", or plain one, the name is read to the left and the host to the right, through
    disguised dots and whatever their length; what the one before has taken is not read again.
    """
    text, edits, done = tape.text, [], 0
    dots = [m.span() for m in _DOT.finditer(text)]
    begins, ends = {a: b for a, b in dots}, {b: a for a, b in dots}
    starts = [a for a, _ in dots]
    for at in _AT.finditer(text):
        if at.start() < done:
            continue
        # the host: labels with dots between them
        host, place, hidden = [], at.end(), False
        while True:
            i = bisect_left(starts, place)
            label = _HOST_LABEL.match(text, place, starts[i] if i < len(starts) else len(text))
            if not label:
                break
            host.append(label[0])
            end = place = label.end()
            if place in begins:
                place, dot = begins[place], True
            elif text[place : place + 1] == ".":
                place, dot = place + 1, False
            else:
                break
            # a dot is part of the host if a label follows
            hidden |= dot and bool(_HOST_LABEL.match(text, place)) and text[end : end + 2].strip()[:1] != "."
        if len(host) < 2:
            done = max(done, at.end() - 1)
            continue
        # words and bare signs count only beside a disguised dot: "at" and "@name" are everywhere
        bare = at[0].strip().lower() in ("at", "arroba", "@")
        if bare and not hidden and not _AT_HOST.match(text, at.start()):
            continue
        begin, name = at.start(), []
        while begin > done:
            if begin in ends and ends[begin] >= done:
                name.append(".")
                begin = ends[begin]
            elif _NAME_CHAR.match(text, begin - 1):
                name.append(text[begin - 1])
                begin -= 1
            else:
                break
        name = "".join(name[::-1])
        kept = name.lstrip(".")
        if kept:
            # dots before the name are not part of it
            while begin in begins and begins[begin] <= at.start():
                begin = begins[begin]
            edits.append((begin, end, f"{kept}@{'.'.join(host)}"))
            done = end
    return tape.rewritten(edits)


def _may_hide_addresses(text: str, low: str) -> bool:
    if "@" in text or any(map(low.__contains__, _AT_WORDS)):
        return True
    if not ("at" in low or "arroba" in low):
        return False
    return any(map(low.__contains__, _HIDDEN_DOTS)) or "arroba" in low or bool(_BARE_AT.search(low))


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """What the patterns find only after the transducers, in source offsets."""
    tape = Tape(text)
    if not text.isascii() and not _FOLDABLE.isdisjoint(text):
        tape = fold_homoglyphs(tape)
    low = tape.text.lower()
    if _BESIDE.search(low) or "plus" in low:
        tape = read_digits(tape)
    if _may_hide_addresses(tape.text, low):
        tape = join_addresses(tape)
    if tape.text == text:
        return []
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for kind, a, b in plain:
        taken[kind].append((a, b))
    out, last = [], dict.fromkeys(KINDS, 0)
    for kind, lo, hi in plain_spans(tape.text):
        a, b = tape.source(lo, hi)
        # both lists of a kind are by start and without overlaps
        i = bisect_left(taken[kind], (b, 0)) - 1
        if a >= last[kind] and not (i >= 0 and taken[kind][i][1] > a):
            out.append((kind, a, b))
            last[kind] = b
    return out


def _listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            text = text or ""
            plain = plain_spans(text)
            more = disguised_spans(text, plain)
            counts = [sum(s[0] == k for s in plain) for k in KINDS]
            digest = hashlib.sha256(_listed(plain).encode()).hexdigest()
            rows.append((None if pd.isna(doc_id) else int(doc_id), *counts, digest, _listed([*plain, *more]), len(more)))
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"]
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): plain counts, their digest and all spans.

    A null text counts as empty: no spans, the digest of the empty string. Counts and
    ``base_sha256`` are of plain findings, ``n_disguised`` of those that only the transducers
    reveal; ``spans`` has both. Repeated rows get equal rows, an empty table none. A text of any length is read whole, in
    time that grows with its length.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"
    return pick(docs, "doc_id", "text").mapInPandas(_found, schema)
