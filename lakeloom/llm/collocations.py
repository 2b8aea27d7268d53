"""Phrase collocations: exact counts of all phrases that are frequent, without a row for each phrase of the corpus.

1. Texts are cut into pieces, and those packed by language into shards of bounded size. A shard is one row.
2. Each shard counts its phrases in the counters that their hashes name. The sketch has about as many counters
   as the corpus has phrases; it lies in slices, each summed in one task. A counter is no less than
   the count of any phrase that it stands for. The counters that reach the bound are told to the
   shards that contributed to them, and to no others. Some shards of a task share a row for each slice.
3. What a shard holds of phrases whose counters reach the bound are its candidates. Those whose hash occurs there again are compiled
   into an automaton, each word as two characters of two alphabets so that matches are whole words, and what they may cover of the
   shard is scanned, overlapping matches counted; a candidate whose hash occurs once occurs once. Single words
   are counted as they are. Counts move in blocks by phrase, a row each, not in a row for each phrase and task. Summed over the shards,
   these are exact counts, and the bound is applied to them: a phrase becomes a row once, when it is frequent.
4. Scores, containment in longer phrases and ranks are joins and windows over the phrases that are left.

Collisions in the sketch cost a candidate, never a phrase. What a task holds is one shard and the contributions of
TOGETHER, or one slice with its contributions, or one block of phrases; what moves between tasks are two to three bytes for each distinct phrase of a shard,
and the candidates with their counts.
"""

from __future__ import annotations

import ctypes
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, mix, odd_numbers, pick, remove, written

#: Fixed: what ends a piece, and the letters that are lower-cased.
_PIECE_END = b".,;:!?\n\x0b\x0c\r"
LONGEST, LEAST, TOP = 4, 30, 2000
#: Bytes of a shard; a longer piece is a shard of its own.
SHARD_BYTES = 1 << 21
#: Counters of a slice of the sketch, and of a block, whose places take two bytes.
SLICE, BLOCK = 1 << 22, 1 << 16
#: Bytes of a shard whose words are hashed at once.
STRETCH = 1 << 17
#: Phrases whose counts a task holds before it passes them on, and bytes of what it holds.
HELD, HELD_BYTES = 500_000, 1 << 26
#: Shards of a task that share a row for each slice.
TOGETHER = 8

#: Where the alphabets of spelled words begin, and what ends a piece there.
_SECOND, _FIRST, _PIECE_MARK = 0x100, 0x10000, 10

_ENDS = bytes.maketrans(_PIECE_END + b"\t", b"\n" * len(_PIECE_END) + b" ")
_BETWEEN = re.compile(rb" *\n[ \n]*")
_BLANKS = re.compile(rb"  +")


def pieces_of(text: str | None) -> bytes:
    """The pieces of a text that have words, lower-cased, a line each, words parted by one blank."""
    if not text:
        return b""
    lines = text.encode("utf-8", "surrogatepass").lower().translate(_ENDS)
    return _BLANKS.sub(b" ", _BETWEEN.sub(b"\n", lines).strip(b" \n"))


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task keeps none of the last one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, lines, n_words): pieces of one language, SHARD_BYTES of them at most or one longer one."""
    held: dict[str | None, list[bytes]] = {}
    sizes: Counter = Counter()

    def shard(lang: str) -> pd.DataFrame:
        lines = b"\n".join(held.pop(lang))
        sizes.pop(lang)
        return pd.DataFrame({"lang": [lang], "lines": [lines], "n_words": [lines.count(b" ") + lines.count(b"\n") + 1]})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            lines = pieces_of(text)
            while lines:
                room = SHARD_BYTES - sizes[lang]
                if len(lines) <= room:
                    part, lines = lines, b""
                else:
                    # a cut between pieces loses no phrase
                    cut = lines.rfind(b"\n", 0, room + 1)
                    if cut < 0 and not sizes[lang]:
                        cut = lines.find(b"\n")
                    part, lines = (lines, b"") if cut < 0 and not sizes[lang] else (lines[: max(cut, 0)], lines[cut + 1 :])
                if part:
                    held.setdefault(lang, []).append(part)
                    sizes[lang] += len(part) + 1
                if lines or sizes[lang] >= SHARD_BYTES:
                    yield shard(lang)
        give_back()
    for lang in list(held):
        yield shard(lang)


@dataclass
class Lines:
    """Where the words of a shard begin and end, and how many its piece has from each word on."""

    text: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    room: np.ndarray

    @staticmethod
    def of(lines: bytes) -> Lines:
        text = np.frombuffer(lines, np.uint8)
        gaps = np.flatnonzero((text == 32) | (text == 10))
        begins, ends = np.append(0, gaps + 1), np.append(gaps, len(text))
        last = np.append(np.flatnonzero(text[gaps] == 10), len(gaps))
        room = np.repeat(last + 1, np.diff(last, prepend=-1)) - np.arange(len(begins))
        return Lines(text, begins, ends, room)


#: An odd number and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(of: Lines) -> np.ndarray:
    """A 64-bit hash of each word: differences of running sums of powers, so no word is looked at by itself.

    The sums are taken over about STRETCH bytes at a time, from a word's beginning on; where they begin leaves the hashes as they are.
    """
    out = np.empty(len(of.begins), np.uint64)
    edges = np.append(np.flatnonzero(np.diff(of.begins // STRETCH, prepend=-1)), len(out))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        start = of.begins[lo]
        text = of.text[start : of.ends[hi - 1]]
        # few lengths, so that the powers are kept
        n = 2 * STRETCH if len(text) < 2 * STRETCH else 1 << (len(text) + 1).bit_length()
        sums = np.append(np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)[: len(text)], dtype=np.uint64))
        out[lo:hi] = (sums[of.ends[lo:hi] - start] - sums[of.begins[lo:hi] - start]) * _powers(_INVERSE, n)[of.begins[lo:hi] - start]
    return mix(out)


def phrase_hashes(lang: str, of: Lines, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, first words, hashes) of the phrases of each length."""
    hashes, factors = word_hashes(of), odd_numbers(longest, 23)
    total = np.full(len(hashes), xxhash.xxh3_64_intdigest(lang), np.uint64)
    for k in range(1, longest + 1):
        total = total[: len(hashes) - k + 1] + mix(hashes[k - 1 :] + np.uint64(k)) * factors[k - 1]
        at = np.flatnonzero(of.room[: len(total)] >= k)
        yield k, at, mix(total[at])


def _contributed(bits: int, longest: int):
    """(slice, shards, sizes, high, low, counts): how often shards hit the counters of each slice; counts end at 255.

    TOGETHER shards of a task share a row for each slice, one after another, so rows stay thick where slices are many.
    """
    slices = max((1 << bits) // SLICE, 1)

    def rows_of(held: list[tuple]) -> Iterator[pd.DataFrame]:
        shards = np.array([shard for shard, *_ in held], np.int64).tobytes()
        sizes = np.diff(np.stack([edges for _, edges, *_ in held]))
        for lo in range(0, slices, 64):
            rows = []
            for at in (lo + np.flatnonzero(sizes[:, lo : lo + 64].any(axis=0))).tolist():
                own = [(edges[at], edges[at + 1], planes) for _, edges, *planes in held]
                rows.append((at, shards, sizes[:, at].astype(np.uint32).tobytes(), *[b"".join([planes[i][x:y] for x, y, planes in own]) for i in range(3)]))
            yield pd.DataFrame(rows, columns=["slice", "shards", "sizes", "high", "low", "counts"])
        held.clear()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            for shard, lang, lines in zip(batch["shard"], batch["lang"], batch["lines"], strict=True):
                counters = np.concatenate([h >> np.uint64(64 - bits) for _, _, h in phrase_hashes(lang, Lines.of(lines), longest)])
                counters.sort()
                begin = np.flatnonzero(np.append(True, counters[1:] != counters[:-1]))
                n = np.minimum(np.diff(begin, append=len(counters)), 255).astype(np.uint8)
                counters = counters[begin]
                edges = np.searchsorted(counters, np.arange(slices + 1, dtype=np.uint64) * np.uint64(SLICE))
                place = (counters % np.uint64(SLICE)).astype(np.uint32)
                held.append((shard, edges, memoryview((place // BLOCK).astype(np.uint8)), memoryview((place % BLOCK).astype(np.uint16)), memoryview(n)))
                if len(held) >= TOGETHER:
                    yield from rows_of(held)
        if held:
            yield from rows_of(held)

    return run


def _reached(least: int, together: int = 1):
    """(shard, slice, places): the places of a slice that reach the bound in sum, for each shard that has any. Rows come sorted by slice.

    What ``together`` slices from a multiple of it on tell a shard is one row, its places counted from the first of them.
    """

    def told(at: int, rows: list[tuple], found: dict[int, list[np.ndarray]]) -> None:
        shards, sizes, high, low, counts = [np.frombuffer(b"".join(x), t) for x, t in zip(zip(*rows, strict=True), (np.int64, np.uint32, np.uint8, np.uint16, np.uint8), strict=True)]
        places = high.astype(np.uint32) * np.uint32(BLOCK) + low
        # sums of less than 2^53 are exact
        hot = np.bincount(places, counts, SLICE) >= least
        hits = hot[places]
        hit_ends = np.append(0, np.cumsum(hits))[np.append(0, np.cumsum(sizes, dtype=np.int64))]
        places = places[hits] + np.uint32(at % together * SLICE)
        for i in np.flatnonzero(np.diff(hit_ends)).tolist():
            found.setdefault(int(shards[i]), []).append(places[hit_ends[i] : hit_ends[i + 1]])

    def rows_of(at: int, found: dict[int, list[np.ndarray]]) -> Iterator[pd.DataFrame]:
        if found:
            yield pd.DataFrame({"shard": list(found), "slice": at // together * together, "places": [b"".join(x) for x in found.values()]})
            found.clear()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, found = None, [], {}
        for batch in batches:
            for at, *row in zip(*[batch[c] for c in ("slice", "shards", "sizes", "high", "low", "counts")], strict=True):
                if at != now:
                    if held:
                        told(now, held, found)
                        if at // together != now // together:
                            yield from rows_of(now, found)
                    now, held = at, []
                held.append(row)
        if held:
            told(now, held, found)
            yield from rows_of(now, found)
        give_back()

    return run


def lines_array(data: np.ndarray | bytes, ends: np.ndarray) -> pa.Array:
    """The stretches of some bytes that end at ``ends``."""
    offsets = np.append(0, ends).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def word_ids(lines: bytes) -> tuple[np.ndarray, int]:
    """(ids, n): a number for each word of a shard, equal words alike, and how many are unlike."""
    text = np.frombuffer(lines + b" ", np.uint8)
    words = lines_array(lines.replace(b"\n", b" ") + b" ", np.flatnonzero((text == 32) | (text == 10)) + 1).dictionary_encode()
    return words.indices.to_numpy(), len(words.dictionary)


def spelled(ids: np.ndarray, n: int, room: np.ndarray, kept: np.ndarray) -> tuple[str, np.ndarray]:
    """(text, places): the words of a shard that are kept, each as two characters, and where each word begins in it.

    First and second characters are of two alphabets, each as large as the root of the number of words, so a match begins and
    ends with a word; what ends a piece, or stands for words left out, is of neither. The automaton has a node or two a word, and
    each node few successors.
    """
    width = max(math.isqrt(max(n - 1, 0)) + 1, 1)
    ends = kept & ((room == 1) | ~np.append(kept[1:], False))
    # a word that is kept takes two characters, and one more if a mark follows
    lengths = kept * 2 + ends
    places = np.cumsum(lengths) - lengths
    text = np.full(int(lengths.sum()), _PIECE_MARK, np.uint32)
    text[places[kept]], text[places[kept] + 1] = _FIRST + ids[kept] // width, _SECOND + ids[kept] % width
    return text.tobytes().decode("utf-32-le"), places


def scanned(text: str, phrases: list[str]) -> np.ndarray:
    """How often each phrase occurs in a spelled shard, overlaps counted: one pass of an automaton of the phrases."""
    import ahocorasick

    if not phrases:
        return np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, phrase in enumerate(phrases):
        automaton.add_word(phrase, i)
    automaton.make_automaton()
    n = np.zeros(len(phrases), np.int64)
    found = map(itemgetter(1), automaton.iter(text))
    # matches are counted as they come, a block at a time
    while len(block := np.fromiter(islice(found, 1 << 20), np.int64)):
        n += np.bincount(block, minlength=len(phrases))
    return n


def candidates_of(lang: str, lines: bytes, told: np.ndarray, bits: int, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(phrases, hashes, counts): a shard's phrases whose counters were told to it, each a line, and how often it has them."""
    # most phrases are no candidates; a small table says so of them
    few = np.zeros(BLOCK * 16, bool)
    few[told % np.uint64(len(few))] = True
    of, (ids, n_unlike) = Lines.of(lines), word_ids(lines)
    words, kept = np.bincount(ids), np.zeros(len(ids) + 1, np.int32)
    hashes, firsts, lasts, counts = [], [], [], []
    for k, at, hashed in phrase_hashes(lang, of, longest):
        maybe = np.flatnonzero(few[(hashed >> np.uint64(64 - bits)) % np.uint64(len(few))])
        maybe = maybe[np.argsort(hashed[maybe])]
        own = hashed[maybe]
        begin = np.flatnonzero(np.append(len(own) > 0, own[1:] != own[:-1]))
        n, own = np.diff(begin, append=len(own)), own[begin]
        counters = own >> np.uint64(64 - bits)
        hit = told[np.minimum(np.searchsorted(told, counters), len(told) - 1)] == counters
        first = at[maybe[begin[hit]]]
        if k == 1:
            counts.append(words[ids[first]])
        else:
            # a hash that occurs once is of a phrase that does; the others are counted below
            counts.append(n[hit])
            again = at[maybe[np.repeat(hit & (n > 1), n)]]
            kept += np.bincount(again, minlength=len(kept)) - np.bincount(again + k, minlength=len(kept))
        hashes.append(own[hit])
        firsts.append(first)
        lasts.append(first + k - 1)
    hashes, first, last, counts = map(np.concatenate, (hashes, firsts, lasts, counts))
    again = np.flatnonzero((last > first) & (counts > 1))
    text, places = spelled(ids, n_unlike, of.room, np.cumsum(kept[:-1]) > 0)
    counts[again] = scanned(text, [text[i:j] for i, j in zip(places[first[again]].tolist(), (places[last[again]] + 2).tolist(), strict=True)])
    sizes = of.ends[last] - of.begins[first] + 1
    ends = np.cumsum(sizes)
    data = np.append(of.text, 10).astype(np.uint8)[np.repeat(of.begins[first] - ends + sizes, sizes) + np.arange(sizes.sum())]
    data[ends - 1] = 10
    return lines_array(data, ends), hashes, counts


def merged(tables: list[pa.Table]) -> pa.Table:
    """Tables of (phrase, part, n), each of which has a phrase once, as one that does, with the sums."""
    if len(tables) == 1:
        return tables[0]
    out = pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate([("part", "min"), ("n", "sum")])
    return out.select(["phrase", "part_min", "n_sum"]).rename_columns(["phrase", "part", "n"])


class Held:
    """Counts of phrases by language, merged when as many more have come as the last merging left, ``most`` phrases or ``size`` bytes at least."""

    def __init__(self, most: int, size: int) -> None:
        self.most = np.array([most, size])
        self.tables: dict[str, list[pa.Table]] = {}
        self.now = self.left = np.zeros(2, np.int64)

    def add(self, lang: str, table: pa.Table) -> bool:
        """Whether more phrases or bytes than may be held are left after merging."""
        self.tables.setdefault(lang, []).append(table)
        self.now = self.now + (len(table), table.nbytes)
        if (self.now <= self.left + np.maximum(self.left, self.most)).all():
            return False
        self.tables = {lang: [merged(tables)] for lang, tables in self.tables.items()}
        self.now = self.left = np.array([(len(t), t.nbytes) for t, in self.tables.values()]).sum(axis=0)
        return bool((self.left > self.most).any())

    def take(self) -> Iterator[tuple[str, pa.Table]]:
        """What is held, language by language; then nothing is."""
        for lang in list(self.tables):
            yield lang, merged(self.tables.pop(lang))
        self.now = self.left = np.zeros(2, np.int64)


def _counted(bits: int, longest: int, parts: int):
    """(part, lang, phrases, counts): the candidates of a task's shards in blocks, from the counters that were told to each shard."""

    def blocks_of(lang: str, whole: pa.Table) -> Iterator[pd.DataFrame]:
        # in order, since neighbours that begin alike are packed well
        whole = whole.sort_by([("part", "ascending"), ("phrase", "ascending")]).combine_chunks()
        names, part, counts = whole["phrase"].combine_chunks(), whole["part"].to_numpy(), whole["n"].to_numpy()
        offsets, data, rows = np.frombuffer(names.buffers()[1], np.int64)[names.offset :], names.buffers()[2], []
        edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            # as narrow as the block's greatest count lets them be
            rows.append((int(part[lo]), lang, data[offsets[lo] : offsets[hi]].to_pybytes(), counts[lo:hi].astype(np.min_scalar_type(counts[lo:hi].max())).tobytes()))
        yield pd.DataFrame(rows, columns=["part", "lang", "phrases", "counts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Held(HELD, HELD_BYTES)
        for batch in batches:
            for lang, lines, slices, places in zip(*[batch[c] for c in ("lang", "lines", "slices", "places")], strict=True):
                told = np.sort(np.concatenate([np.frombuffer(p, np.uint32).astype(np.uint64) + np.uint64(SLICE * int(s)) for s, p in zip(slices, places, strict=True)]))
                phrases, hashes, counts = candidates_of(lang, lines, told, bits, longest)
                table = pa.table({"phrase": phrases, "part": (hashes % np.uint64(parts)).astype(np.int32), "n": counts.astype(np.uint64)})
                # what shards of a task share is passed on once
                if held.add(lang, table):
                    for of in held.take():
                        yield from blocks_of(*of)
            give_back()
        for of in held.take():
            yield from blocks_of(*of)
        give_back()

    return run


def _summed(least: int):
    """(lang, phrase, a): the sums of the counts that reach the bound. Blocks come sorted by part and language."""

    def rows_of(lang: str, whole: pa.Table) -> Iterator[pd.DataFrame]:
        whole = whole.filter(pa.array(whole["n"].to_numpy() >= least))
        for lo in range(0, len(whole), 50_000):
            part = whole.slice(lo, 50_000)
            yield pd.DataFrame({"lang": lang, "phrase": [p[:-1].decode("utf-8", "surrogatepass") for p in part["phrase"].to_pylist()], "a": part["n"].to_numpy().astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, Held(HELD, HELD_BYTES)
        for batch in batches:
            for part, lang, phrases, counts in zip(*[batch[c] for c in ("part", "lang", "phrases", "counts")], strict=True):
                if (part, lang) != now:
                    for of in held.take():
                        yield from rows_of(*of)
                    now = (part, lang)
                names = lines_array(phrases, np.flatnonzero(np.frombuffer(phrases, np.uint8) == 10) + 1)
                n = np.frombuffer(counts, f"u{len(counts) // len(names)}").astype(np.uint64)
                held.add(lang, pa.table({"phrase": names, "part": np.full(len(n), part, np.int32), "n": n}))
        for of in held.take():
            yield from rows_of(*of)
        give_back()

    return run


def sketch_bits(n_words: int, longest: int = LONGEST) -> int:
    """The logarithm of the sketch's size: about one counter for each phrase, one slice at least."""
    return max(int(n_words * longest - 1).bit_length(), SLICE.bit_length() - 1)


def frequent_phrases(shards: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a): the exact count of each phrase of 1 to ``longest`` words that occurs ``least`` times or more, 255 at most.

    ``shards`` has (shard, lang, lines, n_words).
    """
    n = shards.agg(F.sum("n_words")).first()[0] or 0
    bits = sketch_bits(n, longest)
    slices, parts = (1 << bits) // SLICE, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = shards.select("shard", "lang", "lines").mapInPandas(_contributed(bits, longest), "slice long, shards binary, sizes binary, high binary, low binary, counts binary")
    # beyond 1,024 slices, up to 64 of them are summed one after another in a task and told together
    together = min(max(slices // 1024, 1), 64)
    by_slice = own.repartition(max(slices // together, parts), F.floor(F.col("slice") / together)).sortWithinPartitions("slice")
    told = by_slice.mapInPandas(_reached(least, together), "shard long, slice long, places binary")
    gathered = told.groupBy("shard").agg(F.collect_list(F.struct("slice", "places")).alias("told")).select("shard", "told.slice", "told.places").withColumnRenamed("slice", "slices")
    candidates = shards.select("shard", "lang", "lines").join(gathered, "shard").select("lang", "lines", "slices", "places")
    # at most 8 slices' phrases meet in a part, of which one in ``least`` can be frequent
    parts = max(parts, slices // 8)
    counts = candidates.mapInPandas(_counted(bits, longest, parts), "part int, lang string, phrases binary, counts binary")
    by_part = counts.repartitionById(parts, "part").sortWithinPartitions("part", "lang")
    return by_part.mapInPandas(_summed(least), "lang string, phrase string, a long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases of 2 to ``longest`` words of ``docs`` (doc_id, text, lang, ...).

    a, l and r count a phrase and the two parts of its lowest-scoring cut, n all words of the language; score is
    floor(2000000 * a / (l + r)). Phrases that a longer one of at least 80 percent of their count contains are dropped. Texts
    that are null or without words have no phrases; a null language is "und". Rows that repeat a doc_id count each.
    Ties are settled to the last by the phrase. Extra columns don't matter, whatever their names; an empty table gives no rows.
    Texts of any length are read whole.
    """
    texts = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    packed = texts.mapInPandas(_packed, "lang string, lines binary, n_words long")
    shards = written(packed.withColumn("shard", F.monotonically_increasing_id()), "shards")
    with batches_of(docs.sparkSession, SHARD_BYTES):
        counts = written(frequent_phrases(shards, least, longest), "phrases")
    totals = shards.groupBy("lang").agg(F.sum("n_words").alias("n"))
    out = written(ranked(counts, totals, top), "collocations")
    remove(docs.sparkSession, shards, counts)
    return out


def ranked(counts: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The best phrases of each language by (lang, phrase, a) of all frequent phrases, single words among them, and (lang, n)."""
    phrases = counts.withColumn("words", F.split("phrase", " ")).withColumn("k", F.size("words")).where("k > 1")
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at"))
    cuts = cuts.select("lang", "phrase", "a", "at", F.expr("array_join(slice(words, 1, at), ' ')").alias("first"), F.expr("array_join(slice(words, at + 1, size(words)), ' ')").alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    score = F.expr("cast(floor(cast(a as decimal(20, 0)) * 2000000 div (l + r)) as long)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("cut"))
    # each shorter phrase of two words or more that a longer one contains, with the greatest count of such
    inside = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    covers = phrases.where("k > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = best.join(covers, ["lang", "phrase"], "left").where("cover is null or cast(cover as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * 80")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")).cast("long")
    first = kept.withColumn("rank", place).where(F.col("rank") <= top)
    return first.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
