"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared by their letters and digits alone, lower-cased. An item is
cut into overlapping segments, long and short ones; a text is contaminated by an item if some part of it
is within the edit budget of one of the item's segments (a tenth of its length at most). The long
ones bear the most edits. The short ones find passages: a verbatim copy of PASSAGE letters of an item or
more, from wherever in it, holds a whole short segment. They are asked only of items that no long one finds.

A part within k edits of a segment of length m shares at least m + 1 - q * (k + 1) of its q-grams
(q-gram lemma), all on diagonals at most k apart. Shared q-grams are counted in diagonal
bands of twice a power of two >= k that overlap by half, so one band holds all of them; bands
that reach the bound are verified by banded alignment. Nothing within the budget is missed.

The benchmark is the query set: it is cut into slices of bounded size. Each is indexed, broadcast, matched against
all texts and released before the next, so neither the driver nor a task holds more than one slice, whatever
the benchmark's size. Texts never move: each is scanned whole where it lies.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_by, mix, pick, written

Q, SEGMENT, STEP = 8, 96, 48
#: The short segments, and the least verbatim passage that is sure to hold one of them whole.
SHORT, SHORT_STEP = 48, 12
PASSAGE = SHORT + SHORT_STEP - 1
ERROR_RATE = 0.1
#: Characters of benchmark text that are indexed and broadcast at a time, more only where one item is longer.
SLICE_CHARS = 600_000
#: An item with fewer letters and digits is matched as it is, from the beginning of a word to the end of one; one that has fewer words
#: besides is a name or an answer rather than a passage, and matches nothing.
LEAST_ITEM, LEAST_WORDS = 20, 4
FILTER_BITS = 22

# A band key has the segment, the band and the place in the segment, with 24, 32 and 7 bits. Bands begin at
# -SEGMENT at the least and do not pass the 2^31 characters of a string.
BAND_BITS, PLACE_BITS, FIRST_BAND = 32, 7, 128
MOST_SEGMENTS = 1 << (63 - BAND_BITS - PLACE_BITS)

_WORDS = re.compile(r"\w+")
_LIMIT = sys.maxunicode + 1
_tables: dict[str, np.ndarray] = {}


def letters(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased letters and digits as code points, and the place of each in the text."""
    if not _tables:
        _tables["kept"] = np.array([chr(i).isalnum() for i in range(_LIMIT)])
        _tables["low"] = np.array([ord(chr(i).lower()[0]) if chr(i).isalnum() else 0 for i in range(_LIMIT)], np.uint32)
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero(_tables["kept"][codes])
    return _tables["low"][codes[at]], at


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each run of q characters, by doubling (q is a power of two)."""
    h, n = codes.astype(np.uint64) + np.uint64(1), 1
    while n < q:
        if len(h) <= n:
            return np.empty(0, np.uint64)
        h = mix(h[:-n] * np.uint64(0x9E3779B97F4A7C15) + h[n:]) if n < q // 2 else h[:-n] * np.uint64(0xD6E8FEB86659FD93) + h[n:]
        n *= 2
    return h


def budget(m: int) -> int:
    """Edits allowed in a segment of m characters: a tenth, less where too few q-grams would be left."""
    return max(0, min(int(ERROR_RATE * m), int((0.9 * m - Q + 1) / Q)))


def aligned(pattern: np.ndarray, text: np.ndarray, lo: int, width: int, k: int) -> tuple[int, int, int] | None:
    """The best (edits, start, end) of ``pattern`` within the diagonals lo .. lo + width of ``text``.

    Row i of the table has the text positions i + lo .. i + lo + width; the start may be
    any of the first row and the end any of the last. None if it takes more than k edits.
    """
    m, big = len(pattern), 1 << 20
    # a verbatim copy needs no table; the leftmost one is what the table would give
    first, held = max(0, lo), text[max(0, lo) : max(0, lo + width + m)]
    if len(held) >= m:
        begins = np.flatnonzero(held[: len(held) - m + 1] == pattern[0])
        for i in begins:
            if np.array_equal(held[i : i + m], pattern):
                return 0, first + int(i), first + int(i) + m
    diagonals = np.arange(width + 1)
    at = lo + diagonals
    cost = np.where((at >= 0) & (at <= len(text)), 0, big)
    start = at.copy()
    for i in range(1, m + 1):
        at = i + lo + diagonals
        inside = (at >= 0) & (at <= len(text))
        char = text[np.clip(at - 1, 0, len(text) - 1)]
        new = np.where(inside & (at > 0), cost + (char != pattern[i - 1]), big)
        came = start
        # a pattern character without a partner: from the next diagonal of the row above
        skip = np.append(cost[1:], big) + 1
        better = inside & (skip < new)
        new, came = np.where(better, skip, new), np.where(better, np.append(start[1:], 0), came)
        # text characters without a partner: from the left in the same row
        low = np.minimum.accumulate(new - diagonals)
        source = np.maximum.accumulate(np.where(new - diagonals == low, diagonals, 0))
        gap = low + diagonals
        better = inside & (gap < new)
        cost, start = np.where(better, gap, new), np.where(better, came[source], came)
        if cost.min() > k:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(start[best]), m + lo + best) if cost[best] <= k else None


class Shorts:
    """Short items, each found where its letters stand between word ends; an automaton is made where it is used."""

    def __init__(self, items: list[tuple[str, int | None]]) -> None:
        self.items, self.automaton = items, None

    def found(self, codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int | None, int, int]]:
        """(item, start, end) in code points of the text, of the leftmost match of each."""
        if not self.items or not len(codes):
            return
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for letters_, item in self.items:
                self.automaton.add_word(letters_, (len(letters_), [*self.automaton.get(letters_, (0, []))[1], item]))
            self.automaton.make_automaton()
        # whether a word begins at a letter; past the last one, too
        begins = np.append(np.diff(at, prepend=-2) > 1, True)
        seen: set[int | None] = set()
        for last, (n, items) in self.automaton.iter(codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")):
            if begins[last - n + 1] and begins[last + 1]:
                for item in set(items) - seen:
                    seen.add(item)
                    yield item, int(at[last - n + 1]), int(at[last]) + 1


def _id_order(item: int | None) -> tuple[bool, int]:
    return item is None, item or 0


@dataclass
class Index:
    """Sorted q-gram hashes of all segments, the long ones first, with their postings."""

    items: list[int | None]
    segment_item: np.ndarray
    segments: list[np.ndarray]
    n_long: int
    hashes: np.ndarray
    first: np.ndarray
    posting_segment: np.ndarray
    posting_place: np.ndarray
    filter: np.ndarray
    allowed: np.ndarray
    half: np.ndarray
    bound: np.ndarray
    short: Shorts

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Index:
        owner, segments = [], []
        texts = [letters(text)[0] for _, text in rows]
        n_long = 0
        for length, step, least in ((SEGMENT, STEP, LEAST_ITEM), (SHORT, SHORT_STEP, SHORT + 1)):
            n_long = len(segments)
            for i, codes in enumerate(texts):
                if len(codes) < least:
                    continue
                for s in range(0, max(1, len(codes) - length + step), step):
                    s = max(0, min(s, len(codes) - length))
                    owner.append(i)
                    segments.append(codes[s : s + length])
        few = [(c.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), r[0]) for c, r in zip(texts, rows, strict=True) if 0 < len(c) < LEAST_ITEM and len(_WORDS.findall(r[1])) >= LEAST_WORDS]
        if len(segments) > MOST_SEGMENTS:
            raise ValueError(f"{len(segments)} segments in a slice; at most {MOST_SEGMENTS} can be told apart")
        found = [grams(s) for s in segments]
        every = np.concatenate([*found, np.empty(0, np.uint64)])
        segment = np.repeat(np.arange(len(segments)), [len(f) for f in found])
        place = np.concatenate([*(np.arange(len(f)) for f in found), np.empty(0, np.int64)])
        order = np.argsort(every, kind="stable")
        hashes, first = np.unique(every[order], return_index=True)
        marks = np.zeros(1 << FILTER_BITS, bool)
        marks[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        allowed = np.array([budget(len(s)) for s in segments], np.int64)
        return cls(
            items=[r[0] for r in rows],
            segment_item=np.array(owner, np.int64),
            segments=segments,
            n_long=n_long,
            hashes=hashes,
            first=np.append(first, len(every)),
            posting_segment=segment[order].astype(np.int32),
            posting_place=place[order].astype(np.int32),
            filter=marks,
            allowed=allowed,
            half=1 << np.ceil(np.log2(np.maximum(allowed, 1))).astype(np.int64),
            bound=np.maximum(np.array([len(s) for s in segments], np.int64) + 1 - Q * (allowed + 1), 1),
            short=Shorts(few),
        )

    def matches(self, text: str | None) -> list[list[int | None]]:
        """[item_id, start, end, edits, segments] of each item found in a whole text, in code points.

        The segments are the long ones that match, or the short ones where no long one does. The leftmost match of each segment counts. A
        short item is one segment without edits.
        """
        codes, at = letters(text)
        best: dict[int | None, list[int | None]] = {item: [item, start, end, 0, 1] for item, start, end in self.short.found(codes, at)}
        self._by_grams(codes, at, best)
        return [best[i] for i in sorted(best, key=_id_order)]

    def _by_grams(self, codes: np.ndarray, at: np.ndarray, best: dict[int | None, list[int | None]]) -> None:
        """Add the items that segments find to ``best``."""
        h = grams(codes)
        if not len(h) or not len(self.hashes):
            return
        spots = np.flatnonzero(self.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, h[spots]), len(self.hashes) - 1)
        hit = self.hashes[found] == h[spots]
        spots, found = spots[hit], found[hit]
        if not len(spots):
            return
        counts = self.first[found + 1] - self.first[found]
        rows = np.repeat(self.first[found] - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
        segment = self.posting_segment[rows].astype(np.int64)
        # a segment with fewer hits in the whole text reaches its bound in no band
        enough = np.bincount(segment, minlength=len(self.segments)) >= self.bound
        kept = enough[segment]
        if not kept.any():
            return
        segment, place = segment[kept], self.posting_place[rows[kept]].astype(np.int64)
        diagonal = np.repeat(spots, counts)[kept] - place
        band = diagonal // self.half[segment]
        # a q-gram counts in the two bands that cover its diagonal, once for each place in the segment
        keys = (segment << BAND_BITS) + FIRST_BAND + band
        seen = np.unique(np.concatenate([keys << PLACE_BITS | place, (keys - 1) << PLACE_BITS | place]))
        bands, n = np.unique(seen >> PLACE_BITS, return_counts=True)
        done: set[int] = set()
        by_long: set[int | None] = set()
        for key in bands[n >= self.bound[bands >> BAND_BITS]]:
            s = int(key >> BAND_BITS)
            item = self.items[self.segment_item[s]]
            if s in done or (s >= self.n_long and item in by_long):
                continue
            k, half = int(self.allowed[s]), int(self.half[s])
            lo = (int(key & ((1 << BAND_BITS) - 1)) - FIRST_BAND) * half
            spot = aligned(self.segments[s], codes, lo - k, 2 * half + 2 * k, k)
            if spot is None or spot[2] <= spot[1]:
                continue
            done.add(s)
            edits, start, end = spot[0], int(at[spot[1]]), int(at[spot[2] - 1]) + 1
            if s < self.n_long:
                by_long.add(item)
            old = best.get(item, [item, start, end, edits, 0])
            best[item] = [item, min(start, old[1]), max(end, old[2]), min(edits, old[3]), old[4] + 1]


def _matcher(held):
    @F.pandas_udf("array<array<bigint>>")
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([held.value.matches(t) for t in texts], dtype="object")

    return matches


def _slices(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple[Callable[[Column], Column], bool]]:
    """For each slice of the benchmark a function of a text column, the matches with its items, and whether it is the only one.

    What is asked of a slice has to be computed before the next is taken, which releases its index.
    """
    spark = docs.sparkSession
    items = pick(benchmark, "item_id", "text").where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-chars // SLICE_CHARS))
    for i in range(slices):
        rows = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i).distinct().collect()]
        held = spark.sparkContext.broadcast(Index.of(sorted(rows, key=lambda r: (_id_order(r[0]), r[1]))))
        yield _matcher(held), slices == 1
        if slices > 1:
            held.unpersist()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits, segments): one row for each item found in a text.

    ``start`` and ``end`` cover the leftmost match of each matching segment, in code points of the text, ``edits`` is the
    fewest of any matching segment. Null and empty texts match nothing. An item with fewer than LEAST_ITEM letters and digits
    is found where it stands letter by letter between word ends, if it has LEAST_WORDS words; equal items each match; items without an id have a null item_id and count as one in each slice;
    repeated rows give repeated rows, a text without doc_id a null one. An empty table or benchmark gives no rows. Texts
    of any length are read whole.
    """
    docs, found = pick(docs, "doc_id", "text"), None
    for matches, alone in _slices(docs, benchmark):
        names = ["item_id", "start", "end", "edits", "segments"]
        pairs = docs.select("doc_id", F.explode(matches(F.col("text"))).alias("m"))
        part = pairs.select("doc_id", *[F.col("m")[i].alias(n) for i, n in enumerate(names)])
        if alone:
            return part
        part = written(part, "contaminated")
        found = part if found is None else found.unionByName(part)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has no part of any benchmark item, with all their columns, whatever their names.

    Null and empty texts stay, and so does everything if the benchmark is empty; repeated rows stay or go together. With several
    slices, the digests of the texts found are gathered by each, and the rows that have none of them stay.
    """
    gone = None
    texts = pick(docs, "text")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    for matches, alone in _slices(docs, benchmark):
        if alone:
            return kept_by(docs, "text", lambda text: F.size(matches(text)) == 0)
        part = written(texts.where(F.size(matches(F.col("text"))) > 0).select(digest("text").alias("__digest")).distinct(), "contaminated")
        gone = part if gone is None else gone.union(part)
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return rows.withColumn("__digest", digest(f"c{docs.columns.index('text')}")).join(gone, "__digest", "left_anti").drop("__digest").toDF(*docs.columns)
