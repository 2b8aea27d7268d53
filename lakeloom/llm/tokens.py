"""Alignment of the tokens of two tokenizers over the same bytes.

Token ends are byte offsets. The tokens of B are an interval index, which is built once; for each token of A the B tokens
that it overlaps are found by bisection. Where neither a token of A nor one of B spans the gap between two tokens, a group
ends. All pairs of an A and a B token of a group are linked.

No piece of B has a blank after something that is no white space, so between single blanks B encodes each word for itself. Words
recur, so B's ids of short words are kept in a bounded store; texts with other white space, or with long words, are encoded
as a whole, and so are all if the vocabulary of B has such pieces.

Counts of linked id pairs over the corpus are joined back without moving each document's pairs: tasks pack documents to shards and
ask for each distinct pair of a shard once; the answers are gathered by shard and read beside it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, remove, written

#: The public files of the two tokenizers.
FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Documents and characters of a shard; a longer text is a shard of its own.
SHARD_DOCS, SHARD_CHARS = 4096, 1 << 23
#: Characters of the texts that are encoded together.
PART_CHARS = 1 << 20
#: Words that a worker remembers, and the characters that one may have.
REMEMBERED, SHORT = 1 << 19, 64
#: Links of a group that are made one by one.
MANY = 1 << 12

#: Fixed: how the byte-level tokenizer cuts a text before it merges bytes.
_CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

class Spellings:
    """Byte strings end to end, of which those of many ids are put together at once."""

    def __init__(self, each: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(each), np.uint8)
        self.lengths = np.array([len(x) for x in each], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        at = np.repeat(self.begins[ids] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return self.flat[at].tobytes()


@dataclass
class Tokenizer:
    """``encode`` a text that begins with a blank to an array of ids; what each id spells; whether words are encoded each for itself."""

    encode: Callable[[str], np.ndarray]
    encode_all: Callable[[list[str]], list[list[int]]]
    spelled: Spellings
    by_word: bool

    @property
    def size(self) -> int:
        return len(self.spelled.lengths)


def _joins(spelled: bytes) -> bool:
    """Whether a token has a blank after something that is no white space."""
    return re.search(r"\S ", spelled.decode(errors="replace")) is not None


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokenizer:
    """A byte-level BPE file. Ids in the order of merges are encoded by rank, which is the faster library; others by their own."""
    import tiktoken
    import tokenizers

    with open(path, encoding="utf-8") as f:
        stated = json.load(f)
    letters, model = byte_letters(), stated["model"]
    added = {t["content"]: t["id"] for t in stated.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    spelled = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
    for token, i in vocabulary.items():
        spelled[i] = bytes(letters[c] for c in token)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary["".join(m)] for m in merges]
    first = sorted(i for t, i in vocabulary.items() if len(spelled[i]) == 1)
    cut = json.dumps(stated["pre_tokenizer"])
    if ids == list(range(256, 256 + len(ids))) and first == list(range(256)) and '"ByteLevel"' in cut and stated.get("normalizer") is None:
        ranks = {spelled[i]: i for i in vocabulary.values()}
        ranked = tiktoken.Encoding("ranks", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})
        encode = lambda text: ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
    else:
        own = tokenizers.Tokenizer.from_file(path)
        own.encode_special_tokens = True
        encode = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.int64)
    return Tokenizer(encode, lambda texts: [encode(t).tolist() for t in texts], Spellings(spelled), False)


@lru_cache(maxsize=2)
def pieces(path: str) -> Tokenizer:
    """A piece model with byte fallback; it puts the blank before a text, or a word, itself."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [own.id_to_piece(i) for i in range(own.get_piece_size())]
    spelled = [bytes([int(n[3:5], 16)]) if own.is_byte(i) else b"" if own.is_control(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    encode = lambda text: np.array(own.encode(text[1:]), np.int64)
    return Tokenizer(encode, lambda words: own.encode(words, num_threads=1), Spellings(spelled), not any(map(_joins, spelled)))


class Intervals:
    """The tokens of one side as intervals of bytes, in order."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.end = np.cumsum(lengths)
        self.begin = self.end - lengths

    def stabbed(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last interval that each of the spans overlaps."""
        return np.searchsorted(self.end, begin, "right"), np.searchsorted(self.begin, end, "left") - 1


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of A and of B tokens up to the end of each group, for tokens of these lengths over the same bytes."""
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, index = Intervals(a), Intervals(b)
    first, last = index.stabbed(left.begin, left.end)
    # a B token that two neighbours overlap spans the gap between them
    open_ = np.flatnonzero(np.append(last[:-1] < first[1:], True))
    return open_ + 1, last[open_] + 1


@dataclass
class Aligned:
    """What is known of a text: counts, the groups as text, and its linked id pairs with how many links each."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes
    pairs: np.ndarray
    times: np.ndarray


_NOTHING = Aligned(0, 0, 0, 0, b"", np.empty(0, np.int64), np.empty(0, np.int64))


@lru_cache(maxsize=2)
def _numbers(n: int) -> Spellings:
    """Each id as text, three times: followed by a comma, by a bar, by a semicolon."""
    return Spellings([f"{i}{mark}".encode() for mark in ",|;" for i in range(n)])


def _as_text(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, n: int) -> bytes:
    """The ids of A of a group, a bar, those of B, and a semicolon before the next; ids are below ``n``."""
    left, right = a.copy(), b.copy()
    left[ends_a - 1] += n
    right[ends_b - 1] += 2 * n
    n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    both = np.empty(len(a) + len(b), np.int64)
    both[np.arange(len(a)) + np.repeat(ends_b - n_b, n_a)] = left
    both[np.arange(len(b)) + np.repeat(ends_a, n_b)] = right
    return _numbers(n).joined(both)[:-1]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    begin = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    return codes[begin], np.diff(begin, append=len(codes))


def aligned_ids(a: np.ndarray, b: np.ndarray, left: Tokenizer, right: Tokenizer) -> Aligned:
    """The groups and links of two arrays of ids whose bytes are the same."""
    ends_a, ends_b = group_ends(left.spelled.lengths[a], right.spelled.lengths[b])
    n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    links = n_a * n_b
    small = links <= MANY
    # each token of A of a small group as often as the group has tokens of B, which follow one another from the group's first
    times_a = np.repeat(np.where(small, n_b, 0), n_a)
    first = np.repeat(np.repeat(ends_b - n_b, n_a) - (np.cumsum(times_a) - times_a), times_a)
    pairs, times = _counted(np.repeat(a, times_a) * right.size + b[first + np.arange(len(first))])
    for g in np.flatnonzero(~small).tolist():
        # equal ids of a large group are taken together, so it costs its distinct ids
        x, nx = np.unique(a[ends_a[g] - n_a[g] : ends_a[g]], return_counts=True)
        y, ny = np.unique(b[ends_b[g] - n_b[g] : ends_b[g]], return_counts=True)
        pairs, of = np.unique(np.concatenate([pairs, (x[:, None] * right.size + y[None, :]).ravel()]), return_inverse=True)
        more = np.concatenate([times, (nx[:, None] * ny[None, :]).ravel()])
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, of, more)
    text = _as_text(a, b, ends_a, ends_b, max(left.size, right.size))
    return Aligned(len(a), len(b), len(ends_a), int(links.sum()), text, pairs, times)


class Words(dict):
    """A place for each word that can be encoded for itself, -1 for others; new ones wait in ``fresh``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        if not word or len(word) > SHORT or word[0].isspace() or word[-1].isspace():
            return -1
        place = self[word] = len(self)
        self.fresh.append(word)
        return place


class Aligner:
    """Alignments of texts; what B makes of short words is kept."""

    def __init__(self, left: Tokenizer, right: Tokenizer) -> None:
        self.left, self.right = left, right
        self.words, self.ids, self.ends = Words(), np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Encode the words that are new."""
        found = self.right.encode_all(self.words.fresh) if self.words.fresh else []
        n = np.fromiter(map(len, found), np.int64, len(found))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(n.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n)])
        self.words.fresh = []

    def _of_words(self, places: np.ndarray) -> np.ndarray:
        begins = self.ends[places]
        n = self.ends[places + 1] - begins
        at = np.repeat(begins - (np.cumsum(n) - n), n)
        return self.ids[at + np.arange(len(at))].astype(np.int64)

    def texts(self, texts: list[str | None]) -> Iterator[Aligned]:
        """Of whole texts behind a blank; nothing without text, or if the bytes of either side differ from it."""
        if len(self.words) >= REMEMBERED:
            self.words, self.ids, self.ends = Words(), np.empty(0, np.int32), np.zeros(1, np.int64)
        places: list[np.ndarray | None] = []
        for t in texts:
            words = t.split(" ") if t and self.right.by_word else []
            of = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            places.append(of if len(of) and of.min() >= 0 else None)
        self._learn()
        for t, of in zip(texts, places, strict=True):
            if not t:
                yield _NOTHING
                continue
            text = " " + t
            a, b = self.left.encode(text), self.right.encode(text) if of is None else self._of_words(of)
            whole = text.encode("utf-8", "surrogatepass")
            same = self.left.spelled.joined(a) == whole and self.right.spelled.joined(b) == whole
            yield aligned_ids(a, b, self.left, self.right) if same else _NOTHING


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest needs."""
    kinds = (np.uint8, np.uint16, np.uint32, np.uint64)
    kind = next(k for k in kinds if not len(numbers) or int(numbers.max()) <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]], offset=1).astype(np.int64)


_SHARD = "docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string, n_pairs: long>>, pairs binary, times binary"


@lru_cache(maxsize=2)
def aligner(folder: str) -> Aligner:
    """One for each worker, so that its words serve all its tasks."""
    return Aligner(byte_level(f"{folder}/{BYTE_LEVEL}"), pieces(f"{folder}/{PIECES}"))


def _parts(texts: pd.Series) -> Iterator[tuple[int, int]]:
    """Ranges of texts of PART_CHARS characters together, or of one longer text."""
    begin, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t or "") > PART_CHARS:
            yield begin, i
            begin, chars = i, 0
        chars += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def _shards(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, docs, codes, times, chars = aligner(folder), [], [], [], 0

        def shard() -> pd.DataFrame:
            return pd.DataFrame({"docs": [list(docs)], "pairs": [packed(np.concatenate(codes))], "times": [packed(np.concatenate(times))]})

        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for lo, hi in _parts(batch["text"]):
                texts = batch["text"].iloc[lo:hi].tolist()
                for doc_id, text, x in zip(ids.iloc[lo:hi], texts, of.texts(texts), strict=True):
                    digest = hashlib.sha256(x.groups).hexdigest() if x.n_groups else ""
                    docs.append({"doc_id": None if doc_id is pd.NA else doc_id, "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "n_links": x.n_links, "groups_sha256": digest, "n_pairs": len(x.pairs)})
                    codes.append(x.pairs)
                    times.append(x.times)
                    chars += len(text or "")
                if len(docs) >= SHARD_DOCS or chars >= SHARD_CHARS:
                    yield shard()
                    docs, codes, times, chars = [], [], [], 0
        if docs:
            yield shard()

    return run


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(shard, pair, n): each distinct pair of a shard, with how many of its documents hold it."""
    for batch in batches:
        for shard, data in zip(batch["shard"], batch["pairs"], strict=True):
            pairs, n = np.unique(unpacked(data), return_counts=True)
            for lo in range(0, len(pairs), 100_000):
                part = slice(lo, lo + 100_000)
                yield pd.DataFrame({"shard": shard, "pair": pairs[part], "n": n[part]})


def _answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each document of a shard, which comes with the corpus counts of its pairs."""
    for batch in batches:
        for docs, data, weights, *known in zip(*[batch[c] for c in ("docs", "pairs", "times", "pair", "n", "best")], strict=True):
            pairs, times = unpacked(data), unpacked(weights)
            rows = pd.DataFrame(list(docs), columns=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs"])
            best, total = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            if len(pairs):
                asked, n, first = (np.asarray(x, np.int64) for x in known)
                order = np.argsort(asked)
                at = order[np.searchsorted(asked[order], pairs)]
                best, total = times * first[at], times * n[at]
            ends = rows["n_pairs"].to_numpy(np.int64).cumsum()
            sums = lambda x: np.diff(np.append(0, np.cumsum(x))[ends], prepend=0)
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            yield rows.drop(columns="n_pairs").assign(n_best=sums(best), count_sum=sums(total))


_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def pair_counts(asked: DataFrame, n_right: int) -> DataFrame:
    """(pair, n, best): in how many documents each id pair is linked, and whether its A id has no more frequent one (1 or 0)."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    left = F.expr(f"pair div {n_right}")
    most = counts.groupBy(left.alias("left")).agg(F.max("n").alias("most"))
    return counts.withColumn("left", left).join(most, "left").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of ``docs`` (doc_id, text, ...).

    Texts that are null or empty, or whose tokens' bytes on either side are not those of a blank and the text, have no
    tokens: zeros, and an empty digest. A pair's count is the number of rows that hold it linked, so rows that repeat a
    doc_id count each; a null doc_id stays null. Extra columns don't matter, whatever their names. An empty table gives no rows.
    Texts of any length are read whole; a task holds one shard at a time, which a longer text fills alone. ``folder`` holds the
    tokenizers' files on driver and executors.
    """
    spark = docs.sparkSession
    texts = pick(docs, "doc_id", "text")
    shards = written(texts.mapInPandas(_shards(folder), _SHARD).withColumn("shard", F.monotonically_increasing_id()), "aligned")
    asked = written(shards.select("shard", "pairs").mapInPandas(_asked, "shard long, pair long, n long"), "asked")
    known = pair_counts(asked, pieces(f"{folder}/{PIECES}").size)
    answers = asked.select("shard", "pair").join(known, "pair").groupBy("shard").agg(F.collect_list(F.struct("pair", "n", "best")).alias("answers"))
    both = shards.join(answers, "shard", "left").select("docs", "pairs", "times", "answers.pair", "answers.n", "answers.best")
    out = written(both.mapInPandas(_answered, _ROWS), "alignments")
    remove(spark, shards, asked)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
