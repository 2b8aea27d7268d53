"""Repeated passages by a sparse suffix array.

Texts are sequences of words. Suffixes are retained only at minimiser positions: in each window of
``LEAST`` words, the place of the smallest hash of a run of ``GRAM`` words (the rightmost of equal
ones). The choice depends on the window's words alone, so two equal windows retain the same place,
and each window is the business of exactly one retained suffix.

1. Suffixes that agree in their first words and in all windows that they answer for form a class;
   a class with two members or more is repeated as a whole, and no further work depends on its size.
2. One suffix of each class, where other classes begin with the same words, goes to the suffix
   array proper: sorted by range over all partitions, each compared with its neighbours. The words
   that neighbours share to the right, extended to the left, give the windows that both hold.
3. The neighbours also bound which windows can be held by any suffix at all. Where the extension
   leaves such windows open (a longer match to the right may hide one that reaches further to the
   left, or the neighbour lies in another partition), the windows of suffixes with these first words
   are compared as a whole, by hash.

So every window of ``LEAST`` words that occurs twice is found, and nothing else. What moves is a few
numbers for each retained suffix (one of about twenty words); words themselves move only for step 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, WordHashes, gram_hashes, hashes_of, mix, odd_numbers, pick, words_of, written

#: Words of the shortest passage that counts, and of the run that selects and starts a suffix.
LEAST, GRAM = 50, 10
#: For prefix sums of word hashes; odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15

_PLACE = "doc_id long, row long, at int"
_MARKS = f"{_PLACE}, gram long, context long, left int, right int"
_SUFFIXES = f"gram long, context long, {_PLACE}, left int, tail binary, head binary"
_MATCHES = f"gram long, context long, {_PLACE}, lo int, hi int, other_doc long, other_row long, other_at int, open boolean, first int, windows array<long>"


def _rightmost_minima(x: np.ndarray, w: int) -> np.ndarray:
    """For each window of w values, the place of the smallest, the rightmost of equal ones."""
    at, span = np.arange(len(x)), 1
    while span < w:
        step = min(span, w - span)
        a, b = at[:-step], at[step:]
        at, span = np.where(x[b] <= x[a], b, a), span + step
    return at


def retained(hashes: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, gram hash) of the retained suffixes of a sequence of word hashes."""
    if len(hashes) < least:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    grams = gram_hashes(hashes, gram)
    chosen = _rightmost_minima(grams, least - gram + 1)
    # places grow with the window, so the windows of each are a run
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], len(chosen)) - 1
    place = chosen[first]
    return place, first, last, grams[place]


def _contexts(hashes: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, least: int) -> np.ndarray:
    """A hash of all words that a suffix answers for, and of its place among them."""
    n = len(hashes)
    power = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(mix(hashes) * power[:-1]))
    words = (sums[last + least] - sums[first]) * inverse[first]
    return mix(words + mix(((place - first) * (4 * least) + (last - first)).astype(np.uint64) + np.uint64(1)))


def _marks(least: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for batch in batches:
            out = []
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                h = hashes_of(words_of(text), cache)
                place, first, last, g = retained(h, least, gram)
                if len(place):
                    context = _contexts(h, place, first, last, least)
                    out.append((np.full(len(place), doc_id), np.full(len(place), row), place, g.view(np.int64), context.view(np.int64), place - first, last + least - place))
            if out:
                columns = map(np.concatenate, zip(*out, strict=True))
                names = ["doc_id", "row", "at", "gram", "context", "left", "right"]
                yield pd.DataFrame(dict(zip(names, columns, strict=True))).astype({"at": "int32", "left": "int32", "right": "int32"})

    return run


def _suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words around the asked places of each text, as hashes: onwards, and backwards from the place."""
    cache = WordHashes()
    for batch in batches:
        rows = []
        for doc_id, row, text, asked in zip(batch["doc_id"], batch["row"], batch["text"], batch["asked"], strict=True):
            h = (hashes_of(words_of(text), cache) >> np.uint64(32)).astype(">u4")
            for a in asked:
                at, left = a["at"], a["left"]
                rows.append((a["gram"], a["context"], doc_id, row, at, left, h[at : at + a["right"]].tobytes(), h[at - left : at][::-1].tobytes()))
        names = ["gram", "context", "doc_id", "row", "at", "left", "tail", "head"]
        yield pd.DataFrame(rows, columns=names).astype({"at": "int32", "left": "int32"})


def _table(cells: pd.Series, size: np.ndarray, width: int) -> np.ndarray:
    """The words of each cell, and -1 beyond its end."""
    out = np.full((len(cells), width), -1, np.int64)
    out[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(cells), ">u4")
    return out


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many leading words two rows have in common."""
    differ = (x != y) | (x < 0)
    return np.where(differ.any(1), differ.argmax(1), x.shape[1])


def _neighbours(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, starts = None, True
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch])
            # a text that is there twice brings each of its suffixes twice
            frame = frame.drop_duplicates(["gram", "context"], ignore_index=True)
            # the last row waits for its next neighbour; the one before it stays as its previous one
            if len(frame) > 2:
                yield _compared(frame, starts, False, least)
                held, starts = frame.iloc[-2:], False
            else:
                held = frame
        if held is not None and len(held):
            yield _compared(held, starts, True, least)

    return run


def _compared(frame: pd.DataFrame, starts: bool, ends: bool, least: int) -> pd.DataFrame:
    """Matches of sorted suffixes with those next to them.

    Unless the frame starts (ends) a partition, its first (last) row is there as a neighbour alone.
    ``lo`` .. ``hi`` are the words about the place that a match makes repeated (none: 0 .. 0); ``windows`` has, once for each
    suffix, the hashes of the windows that any other may hold: those with ``first`` words or more before the place.
    """
    n = len(frame)
    size, most = (frame[c].map(len).to_numpy() // 4 for c in ("tail", "head"))
    tail, head = _table(frame["tail"], size, least), _table(frame["head"], most, least)
    gram = frame["gram"].to_numpy()
    same = gram[1:] == gram[:-1]
    right = np.where(same, _shared(tail[1:], tail[:-1]), 0)
    back = np.where(same, _shared(head[1:], head[:-1]), 0)
    fewest = least - size
    reach = np.maximum(np.append(0, right), np.append(right, 0))
    low = np.maximum(fewest, least - reach)
    own = np.arange(n)
    # what lies in the next partition is unknown: all windows
    low = np.where(((own == 0) & starts) | ((own == n - 1) & ends), fewest, low)
    wanted = (low <= most) & ((own > 0) | starts) & ((own < n - 1) | ends)
    columns = [frame[c].to_numpy() for c in ("gram", "context", "doc_id", "row", "at")]
    factors, rows = odd_numbers(least, 23), []
    for i in np.flatnonzero(wanted):
        sure = [(max(fewest[i], least - right[j]), min(back[j], most[i]), other) for j, other in ((i - 1, i - 1), (i, i + 1)) if 0 <= j < n - 1 and same[j]]
        sure = [(a, b, other) for a, b, other in sure if a <= b]
        known = len(set().union(*(range(a, b + 1) for a, b, _ in sure)))
        around = np.concatenate([head[i, : most[i]][::-1], tail[i, : size[i]]]).astype(np.uint64)
        runs = np.lib.stride_tricks.sliding_window_view(around, least)[most[i] - np.arange(low[i], most[i] + 1)]
        windows = mix((mix(runs) * factors).sum(1)).view(np.int64)
        base = [c[i] for c in columns]
        for k, (a, b, other) in enumerate(sure or [(0, 0, -1)]):
            match = (-b, least - a, *(c[other] for c in columns[2:])) if sure else (0,) * 5
            rows.append((*base, *match, known <= most[i] - low[i], low[i], None if k else windows))
    names = [c.split()[0] for c in _MATCHES.split(", ")]
    whole = {c: "int64" for c in names[:-1]} | {"at": "int32", "lo": "int32", "hi": "int32", "other_at": "int32", "first": "int32", "open": bool}
    return pd.DataFrame(rows, columns=names).astype(whole)


def repeated_ranges(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(doc_id, row, start, end, other_doc, elder): word ranges that stand elsewhere too, not merged.

    ``row`` is a hash of id and text, ``elder`` tells whether an earlier place (by doc_id, row, word) is known.
    """
    docs = pick(docs, "doc_id", "text").where("doc_id is not null and text is not null")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    marks = written(docs.mapInPandas(_marks(least, gram), _MARKS), "marks")
    place = F.struct("doc_id", "row", "at")
    classes = marks.groupBy("gram", "context").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.first("left").alias("left"), F.first("right").alias("right"))
    classes = written(classes, "classes")
    several = classes.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
    asked = (
        classes.join(several, "gram", "left_semi")
        .select("low.doc_id", "low.row", F.struct("gram", "context", "low.at", "left", "right").alias("one"))
        .groupBy("doc_id", "row")
        .agg(F.collect_list("one").alias("asked"))
    )
    # rows alike in id and text answer alike; the classes below take them for one
    suffixes = written(docs.join(asked, ["doc_id", "row"]).select("doc_id", "row", "text", "asked").mapInPandas(_suffixes, _SUFFIXES), "suffixes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matches = (
        suffixes.repartitionByRange(parts, "gram", "tail", "context")
        .sortWithinPartitions("gram", "tail", "context")
        .mapInPandas(_neighbours(least), _MATCHES)
    )
    matches = written(matches, "matches")
    key = ["gram", "context"]
    whole = classes.where("low <> high").select(*key, (-F.col("left")).alias("lo"), F.col("right").alias("hi"), "low", "high")
    other = F.struct(F.col("other_doc").alias("doc_id"), F.col("other_row").alias("row"), F.col("other_at").alias("at"))
    extended = matches.where("hi > lo").select(*key, "lo", "hi", F.least(place, other).alias("low"), F.greatest(place, other).alias("high"))
    unsettled = matches.where("open").select("gram").distinct()
    windows = (
        matches.where("windows is not null")
        .join(unsettled, "gram", "left_semi")
        .select(*key, place.alias("place"), "first", F.posexplode("windows").alias("k", "window"))
        .select(*key, "place", (F.col("first") + F.col("k")).alias("before"), "window")
    )
    twice = windows.groupBy("window").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low <> high")
    held = windows.join(twice, "window").select(*key, (-F.col("before")).alias("lo"), (F.lit(least) - F.col("before")).alias("hi"), "low", "high")
    ranges = marks.join(whole.union(extended).union(held), key)
    return ranges.select(
        "doc_id",
        "row",
        (F.col("at") + F.col("lo")).alias("start"),
        (F.col("at") + F.col("hi")).alias("end"),
        F.when(F.col("low") == place, F.col("high.doc_id")).otherwise(F.col("low.doc_id")).alias("other_doc"),
        (F.col("low") < place).alias("elder"),
    )


def _merged(ranges: DataFrame) -> DataFrame:
    """(doc_id, row, removable, start, end, other_doc_id): ranges that meet or overlap become one."""
    rows = ranges.withColumn("removable", F.explode(F.when(F.col("elder"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    along = Window.partitionBy("doc_id", "row", "removable").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    rows = rows.withColumn("island", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("doc_id", "row", "removable", "island").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.coalesce(F.min(F.when(F.col("other_doc") != F.col("doc_id"), F.col("other_doc"))), F.first("doc_id")).alias("other_doc_id"),
    )


def repeated_passages(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(doc_id, start, end, n_words, other_doc_id, removable): passages of ``docs`` (doc_id, text, ...) that stand elsewhere too.

    One row for each maximal range of words (ASCII-lower-cased, end exclusive) all of whose windows of
    ``least`` words occur in another place of the corpus, be it in the same text; ``other_doc_id`` is a
    document that holds part of it, another one where there is one. Rows with ``removable`` tell
    which ranges have an earlier copy: without all of these, each passage still stands once.
    Null, empty and short texts have no passages, nor have rows without doc_id. Rows alike in id and text
    count as one row; rows that differ in text alone count as texts of their own. An empty table gives no rows.
    """
    merged = _merged(repeated_ranges(docs, least, gram))
    return merged.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "other_doc_id", "removable")


def without_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """``docs`` without the words of passages that have an earlier copy; each row stays, its other columns too, whatever their names."""
    spans = _merged(repeated_ranges(docs, least, gram)).where("removable")
    spans = spans.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    word = re.compile(WORD)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, spans, strict=True):
            if gone is not None and len(gone):
                at = [m.span() for m in word.finditer(text)]
                for a, b in sorted(((s["start"], s["end"]) for s in gone), reverse=True):
                    text = text[: at[a][0]] + text[at[b - 1][1] :]
            out.append(text)
        return pd.Series(out, dtype="object")

    # columns by place, as others' names may differ from these in case alone
    id_, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    same = (F.col(id_).cast("long") == F.col("__id")) & (F.xxhash64(F.col(id_).cast("long"), text) == F.col("__row"))
    return rows.join(spans, same, "left").withColumn(text, cut(text, "__spans")).drop("__id", "__row", "__spans").toDF(*docs.columns)
