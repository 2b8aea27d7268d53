"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature has 64 components of 16 bits each, taken from 64 min-wise hashes of its
distinct word shingles. It is cut into 16 chunks of 4. Two signatures that differ in at most
DISTANCE = 31 components differ in at most one component of some chunk (pigeonhole), so each chunk
is filed once for every component left out of it: 64 keys find all pairs within that distance for
certain, and the same signature and distance drop the pairs that meet without being near. A pair at
a similarity of 0.75 is farther apart than that with probability 1.5e-5, more similar ones less.

Pairs under a key are not all written out, which one large group would make quadratic:

1. documents with equal shingle sets form a class; only its smallest id goes on;
2. each key links its members to its smallest and largest member, and components of the
   confirmed links are found, which settles most keys;
3. members of keys that are still in several components are filed once more, under rare shingles. In
   one order for all, rarest first, a pair similar enough has its first common shingle so early
   that enough of both sets follows it. So each member is filed under its first quarter of shingles
   at most, with the largest set that its place there still allows as a partner. Members that share a passage,
   a template or an ancestor, but not enough for a link, part here, as what is their own comes
   first. The order counts all members' shingles in a table of fixed size; collisions in it cost work,
   never a pair;
4. what meets under a shingle in different components and within the distance is confirmed.

Every link is confirmed on the full shingle sets. Pairs left out are between members that are
already in one component, so components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, connected_components, gram_hashes, hashes_of, mix, odd_numbers, pick, remove, words_of, written

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
CHUNKS, CHUNK = 16, 4
COMPONENTS = CHUNKS * CHUNK
#: With more differences than this, every chunk may have two.
DISTANCE = 2 * CHUNKS - 1
#: Characters of the texts that are signed together.
PART_CHARS = 1 << 20
#: Rows of a block; a cell of two blocks is what a task holds at a time.
BLOCK = 4096
#: Counters of the shingle table, and the slices that it is summed in.
COUNTERS, SLICES = 1 << 21, 32

_SIGNED = "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary, keys array<long>"


def shingle_set(text: str | None, cache: WordHashes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    return np.unique(gram_hashes(hashes_of(words_of(text), cache), k))


def shingle_sets(texts: Iterable[str | None], cache: WordHashes, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sets of :func:`shingle_set` of several texts, end to end, and their sizes."""
    words = [words_of(t) for t in texts]
    n = np.fromiter(map(len, words), np.int64, len(words))
    hashes = hashes_of([w for some in words for w in some], cache)
    # runs of k words; those that reach into the next text are left out
    grams = gram_hashes(hashes, k) if len(hashes) >= k else np.empty(0, np.uint64)
    begin = np.cumsum(n) - n
    sets = [np.sort(grams[at : at + m - k + 1]) if m >= k else gram_hashes(hashes[at : at + m], k) for at, m in zip(begin.tolist(), n.tolist(), strict=True)]
    every, owner = np.concatenate([np.empty(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
    return every[fresh], np.bincount(owner[fresh], minlength=len(sets))


def signatures_of(sets: np.ndarray, sizes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The 16-bit components of sets that lie end to end, none of them empty: one row for each."""
    x, begin = (sets >> np.uint64(32)).astype(np.uint32), np.cumsum(sizes) - sizes
    low = np.full((len(sizes), len(factors)), np.iinfo(np.uint32).max, np.uint32)
    for lo in range(0, len(x), 2048):
        part = x[None, lo : lo + 2048] * factors[:, None] + shifts[:, None]
        first = int(np.searchsorted(begin, lo, "right")) - 1
        inside = np.maximum(begin[first : int(np.searchsorted(begin, lo + 2048, "left"))] - lo, 0)
        held = low[first : first + len(inside)]
        np.minimum(held, np.minimum.reduceat(part, inside, axis=1).T, out=held)
    return (mix(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    factors, shifts = (odd_numbers(COMPONENTS, i).astype(np.uint32) for i in (1, 2))
    return factors, shifts


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature, each chunk and each component left out: one key of the chunk's other components."""
    places = np.arange(COMPONENTS, dtype=np.uint64).reshape(CHUNKS, CHUNK)
    terms = mix(mix(signatures.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)) + places)
    return mix(terms.sum(2, keepdims=True) - terms + places * np.uint64(0x9E3779B97F4A7C15)).reshape(-1, COMPONENTS)


def _parts(texts: pd.Series) -> Iterator[tuple[int, int]]:
    """Ranges of texts of PART_CHARS characters together, or one longer text, so that little is held at a time."""
    begin, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t or "") > PART_CHARS:
            yield begin, i
            begin, chars = i, 0
        chars += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def _sign(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, (factors, shifts) = WordHashes(), _multipliers()
        for batch in batches:
            for lo, hi in _parts(batch["text"]):
                sets, sizes = shingle_sets(batch["text"].iloc[lo:hi], cache, k)
                end = np.cumsum(sizes)
                digests = [xxhash.xxh3_128_digest(sets[e - n : e].tobytes()) for e, n in zip(end.tolist(), sizes.tolist(), strict=True)]
                hi_lo = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                full = np.flatnonzero(sizes)
                own = signatures_of(sets, sizes[full], factors, shifts)
                signature, keys = np.full(hi - lo, None, object), np.full(hi - lo, None, object)
                for i, one, some in zip(full.tolist(), own, chunk_keys(own).view(np.int64), strict=True):
                    signature[i], keys[i] = one.tobytes(), some
                ids = batch["doc_id"].iloc[lo:hi].reset_index(drop=True).astype("Int64")
                yield pd.DataFrame({"doc_id": ids, "n_shingles": sizes, "set_hi": hi_lo[:, 0], "set_lo": hi_lo[:, 1], "signature": signature, "keys": keys})

    return run


def _by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each cell. Rows come sorted by gram and cell; a cell has two blocks at most, so little is held at a time."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        new = {c: batch[c].to_numpy() for c in batch.columns if c != "signature"}
        new["signature"] = np.frombuffer(b"".join(batch["signature"]), np.uint16).reshape(len(batch), COMPONENTS)
        rows = {c: np.concatenate([*(h[c] for h in held), v]) for c, v in new.items()}
        edges = np.flatnonzero((np.diff(rows["gram"]) != 0) | (np.diff(rows["cell"]) != 0)) + 1
        edges = [0, *edges.tolist(), len(rows["gram"])]
        for lo, hi in zip(edges, edges[1:-1], strict=False):
            yield {c: v[lo:hi] for c, v in rows.items()}
        held = [{c: v[edges[-2] :] for c, v in rows.items()}]
    yield from held


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of a cell whose signatures are near, across components, as sizes and ``most`` allow."""
    for cell in _by_cell(batches):
        if len(cell["id"]) < 2:
            continue
        names, place, size = np.unique(cell["component"], return_inverse=True, return_counts=True)
        if len(names) == 1:
            continue
        # the largest component last: its members need no pass of their own
        order = np.argsort(place == size.argmax(), kind="stable")
        ids, comp, n, most, block, sig = (cell[c][order] for c in ("id", "component", "n", "most", "block", "signature"))
        # pairs within a block have a cell of their own
        one, found = (block == block[0]).all(), []
        for i in range(len(ids) - int(size.max())):
            fit = (comp[i + 1 :] != comp[i]) & (n[i + 1 :] <= most[i]) & (most[i + 1 :] >= n[i])
            j = i + 1 + np.flatnonzero(fit if one else fit & (block[i + 1 :] != block[i]))
            if len(j):
                j = j[(sig[j] != sig[i]).sum(1) <= DISTANCE]
                found.append(np.stack([np.minimum(ids[j], ids[i]), np.maximum(ids[j], ids[i])], 1))
        if found and sum(map(len, found)):
            yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(COUNTERS)).astype(np.int64)


def _tally(k: int):
    """(slice, place, n): how often the counters of each slice are hit by the texts of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, counts = WordHashes(), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(counts, _counter(shingle_set(text, cache, k)), 1)
        width = COUNTERS // SLICES
        for i in range(SLICES):
            part = counts[i * width : (i + 1) * width]
            at = np.flatnonzero(part).astype(np.uint32)
            if len(at):
                yield pd.DataFrame({"slice": [i], "place": [at.tobytes()], "n": [part[at].tobytes()]})

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of each slice, which come sorted by it; a count of two or more matters, up to 2^32."""
    now, total = None, np.zeros(0)
    for batch in batches:
        for i, at, n in zip(batch["slice"], batch["place"], batch["n"], strict=True):
            if i != now:
                if now is not None:
                    yield pd.DataFrame({"slice": [now], "n": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})
                now, total = i, np.zeros(COUNTERS // SLICES, np.uint64)
            total[np.frombuffer(at, np.uint32)] += np.frombuffer(n, np.uint32)
    if now is not None:
        yield pd.DataFrame({"slice": [now], "n": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})


def _filed(k: int, percent: int, held):
    """(gram, before, id, component, n, most, signature) for the rare shingles that a set is filed under; ``before`` is the one filed before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, (factors, shifts) = WordHashes(), _multipliers()
        names = ["gram", "before", "id", "component", "n", "most", "signature"]
        for batch in batches:
            rows: list[tuple] = []
            for id_, component, text in zip(batch["id"], batch["component"], batch["text"], strict=True):
                s = shingle_set(text, cache, k)
                count, n = held.value[_counter(s)], len(s)
                order = np.lexsort((s, count))
                # sets of m shingles share percent / (100 + percent) of n + m at least; n - place can follow
                most = (100 + percent) * (n - np.arange(n)) // percent - n
                kept = (100 * most >= percent * n) & (count[order] > 1)
                own = signatures_of(s, np.array([n]), factors, shifts).tobytes()
                grams = s[order][kept].view(np.int64).tolist()
                rows += [(g, b, id_, component, n, m, own) for g, b, m in zip(grams, [None, *grams], most[kept].tolist(), strict=False)]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names).astype({"before": "Int64"})
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"before": "Int64"})

    return run


def _linked(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for batch in batches:
            last, keep = (None, None), []
            for a, x, y in zip(batch["a"], batch["text_a"], batch["text_b"], strict=True):
                left = last[1] if last[0] == a else shingle_set(x, cache, k)
                last, right = (a, left), shingle_set(y, cache, k)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both) and both > 0)
            yield batch.loc[keep, ["a", "b"]]

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough, as a written table."""
    with_texts = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return written(with_texts.mapInPandas(_linked(k, percent), "a long, b long"), name)


def _in_cells(rows: DataFrame, by: str) -> DataFrame:
    """Deal the rows of each group to cells of at most two blocks, so that each pair across components shares one.

    A group within one block is one cell. Groups of one component are dropped; pairs within the largest need no cell.
    """
    counts = rows.groupBy(by, "component").agg(F.count("*").alias("n_rows"))
    sizes = counts.groupBy(by).agg(
        F.max("n_rows").alias("n_giant"), F.sum("n_rows").alias("total"), F.max_by("component", F.struct("n_rows", "component")).alias("giant")
    )
    placed = rows.join(sizes.where("total > n_giant"), by)
    placed = placed.withColumn("rest_blocks", F.ceil((F.col("total") - F.col("n_giant")) / F.lit(BLOCK)))
    placed = placed.withColumn("giant_blocks", F.ceil(F.col("n_giant") / F.lit(BLOCK)))
    block = "if(component = giant, rest_blocks + pmod(xxhash64(id), giant_blocks), pmod(xxhash64(id), rest_blocks))"
    placed = placed.withColumn("block", F.expr(f"if(total <= {BLOCK}, 0L, {block})"))
    cells = F.expr(f"""case when total <= {BLOCK} then array(0L)
        when component = giant then transform(sequence(0L, rest_blocks - 1), x -> x * 1000000000L + block)
        else transform(sequence(0L, rest_blocks + giant_blocks - 1), x -> least(block, x) * 1000000000L + greatest(block, x)) end""")
    return placed.select(*rows.columns, "block", F.explode(cells).alias("cell"))


def _compared(filed: DataFrame) -> DataFrame:
    """(a, b) of the filings under a gram that are near by signature and in different components."""
    # a number of its own, since few bytes can mean much work
    parts = int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = _in_cells(filed, "gram").repartition(parts, "gram", "cell").sortWithinPartitions("gram", "cell")
    return cells.mapInPandas(_compare, "a long, b long").distinct()


def rare_filings(hot: DataFrame, k: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Rows (gram, before, id, component, n, most, signature), of which those of each similar pair share a gram.

    ``hot`` has (id, component, text). A text is filed under a quarter of its shingles at most, whatever
    the size of its group, and not under those that it alone has. The counters that order
    them are one table of COUNTERS numbers, whatever the input.
    """
    tallied = hot.select("text").mapInPandas(_tally(k), "slice int, place binary, n binary")
    sums = tallied.repartition(SLICES, "slice").sortWithinPartitions("slice").mapInPandas(_summed, "slice int, n binary")
    counts, width = np.zeros(COUNTERS, np.uint32), COUNTERS // SLICES
    for row in sums.collect():
        counts[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["n"], np.uint32)
    held = hot.sparkSession.sparkContext.broadcast(counts)
    return hot.mapInPandas(_filed(k, percent, held), "gram long, before long, id long, component long, n long, most long, signature binary")


def possible(filed: DataFrame) -> DataFrame:
    """Without the filings that no other one under the gram can be a partner of.

    A gram whose members all have the same one filed before is left out too: they meet there, so a passage that
    many share is compared under one of its shingles.
    """
    limits = filed.groupBy("gram").agg(
        F.min("n").alias("least_n"),
        F.max("most").alias("greatest"),
        (F.min("component") != F.max("component")).alias("several"),
        ((F.count("before") < F.count("*")) | (F.min("before") != F.max("before"))).alias("first"),
    )
    limits = limits.where("several and first").drop("several", "first")
    return filed.drop("before").join(limits, "gram").where("most >= least_n and n <= greatest").drop("least_n", "greatest")


def _open_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, component) of the members of keys whose members are in several components."""
    placed = buckets.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return placed.join(several, "key", "left_semi").select("id", "component").distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs`` (doc_id, text, ...).

    Documents are linked where 100 * |intersection| >= percent * |union| of their shingle sets.
    Null or wordless texts have an empty set and are linked with nothing. A row without doc_id
    cannot be named by a component: its component_id is null and it is kept. Rows that repeat a
    doc_id are one document with all their links. An empty table gives no rows. Texts of any length
    are read whole; a task holds one at a time, and its set. The distance is fit for similarities of
    0.75 or more.
    """
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    signed = written(docs.mapInPandas(_sign(k), _SIGNED), "signed")
    classes = (
        signed.where("doc_id is not null and n_shingles > 0")
        .groupBy("set_hi", "set_lo")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    classes = written(classes, "classes")
    leaders = written(
        signed.where("n_shingles > 0")
        .join(classes, ["set_hi", "set_lo", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("id"), "n_shingles", "signature", "keys"),
        "leaders",
    )
    rows = leaders.select("id", F.explode("keys").alias("key"))
    groups = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    buckets = written(rows.join(groups, "key"), "buckets")
    texts = written(docs.withColumnRenamed("doc_id", "id").join(buckets.select("id").distinct(), "id", "left_semi"), "texts")
    star = (
        buckets.select(F.col("low").alias("a"), F.col("id").alias("b"))
        .union(buckets.select("id", "high"))
        .where("a <> b")
        .distinct()
    )
    signatures = leaders.select("id", F.col("n_shingles").alias("n"), "signature")
    links = confirmed(near_by_signature(star, signatures, percent), texts, k, percent, "links")
    labels = connected_components(links, "first")
    remove(spark, links)
    hot = written(_open_members(buckets, labels).join(texts, "id"), "hot")
    filed = written(rare_filings(hot, k, percent), "filed")
    more = confirmed(_compared(possible(filed)), texts, k, percent, "more-links")
    components = connected_components(more.union(labels.select("id", "component")), "all")
    remove(spark, leaders, buckets, texts, labels, hot, filed, more)
    by_class = classes.join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "set_hi", "set_lo", F.coalesce("component", "doc_id").alias("component")
    )
    out = signed.select("doc_id", "n_shingles", "set_hi", "set_lo").join(by_class, ["set_hi", "set_lo"], "left")
    component = F.expr("if(doc_id is null, null, if(n_shingles = 0, doc_id, component))")
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def near_by_signature(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose signatures differ in few enough places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), -1) for c in ("sig_a", "sig_b"))
                yield batch.loc[(x != y).sum(1) <= DISTANCE, ["a", "b"]]

    side = lambda c: signatures.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"sig_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    fit = joined.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return fit.select("a", "b", "sig_a", "sig_b").mapInPandas(run, "a long, b long")
