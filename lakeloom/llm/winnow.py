"""Document fingerprints by winnowing, in DataFrame operations alone.

A text is cut into tokens, lower-cased: words of at most LONG characters; single characters of scripts that
are written without blanks; and pieces of longer runs (encoded lines), which end where the text itself says so,
at certain letters and digits, so that equal passages have equal tokens wherever they stand in a run. Each
run of K tokens has a rolling hash (by doubling, modulo a Mersenne prime), and of every
window of W such hashes the smallest is kept, the rightmost where several are equal. Two texts that
share K + W - 1 tokens in a row share a fingerprint. Positions count tokens. Hash and position are packed into one number
whose order makes the smallest hash, then the largest position, come first, so a window's
choice is a plain minimum, taken by doubling as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

LONG = 24
_BLANK = r"\x20\x09-\x0D"
# Thai to Tibetan, Burmese, Khmer, kana and Chinese, as ranges: classes by script are several times slower
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORDLY = f"[^{_BLANK}{_UNSPACED}]"
#: In a longer run a piece ends at one of these; where none comes, after so many characters as a word may have.
_ENDS = "[aeiouy13579+/]"
TOKEN = f"(?<!{_WORDLY}){_WORDLY}{{1,{LONG}}}(?!{_WORDLY})|[{_UNSPACED}]|{_WORDLY}{{0,{LONG - 1}}}?{_ENDS}|{_WORDLY}{{1,{LONG}}}"
#: Tokens of a gram and grams of a window, powers of two.
K, W = 4, 8
PRIME = (1 << 31) - 1
BASE = 1_000_003
#: Stands for a null doc_id.
NO_ID = -(1 << 63)


def _with_next(array: str, by: int, f) -> Column:
    """f of each element, the one ``by`` places on (null beyond the end) and the place."""
    return F.transform(array, lambda x, i: f(x, F.get(F.col(array), i + by), i))


def _rolled(power: int):
    return lambda x, y, i: (x * F.lit(power) + y) % PRIME


def _packed(power: int):
    return lambda x, y, i: (x * F.lit(power) + y) % PRIME * F.lit(1 << 31) + (F.lit(PRIME) - i)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with packed fingerprints (hash << 31 | PRIME - position) of ``text``, by position.

    Null and wordless texts have none; fewer tokens than K make one gram of them all, fewer grams
    than W one window. Each step is a column of its own, so nothing is computed twice. What reaches
    beyond the last gram is null, which a minimum passes over; windows that do so are cut off at the end.
    """
    h, packed, n, power = f"{name}_h", f"{name}_p", 1, BASE
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN), F.lit(0))
    df = df.withColumn(h, F.transform(tokens, lambda t: F.crc32(t.cast("binary")) % PRIME))
    whole = F.aggregate(h, F.lit(7).cast("long"), lambda a, x: (a * BASE + x) % PRIME)
    df = df.withColumn(h, F.when(F.size(h) < K, F.when(F.size(h) > 0, F.array_repeat(whole, F.lit(K))).otherwise(F.col(h))).otherwise(F.col(h)))
    gram = h
    while 2 * n < K:
        df = df.withColumn(f"{h}{n}", _with_next(gram, n, _rolled(power)))
        gram, n, power = f"{h}{n}", 2 * n, power * power % PRIME
    df = df.withColumn(packed, _with_next(gram, n, _packed(power)))
    low, n = packed, 1
    while n < W:
        df = df.withColumn(f"{packed}{n}", _with_next(low, n, lambda x, y, i: F.least(x, y)))
        low, n = f"{packed}{n}", 2 * n
    windows = F.size(h) - (K + W - 2)
    one = F.when(F.size(h) > 0, F.array(F.array_min(packed))).otherwise(F.slice(packed, 1, 0))
    df = df.withColumn(name, F.when(windows > 0, F.array_distinct(F.slice(F.col(low), F.lit(1), windows))).otherwise(one))
    return df.drop(*[c for c in df.columns if c.startswith((f"{name}_h", f"{name}_p"))])


def as_text(packed: Column) -> Column:
    """hash:position, comma-joined, by position."""
    one = lambda p: F.concat(F.shiftright(p, 31).cast("string"), F.lit(":"), (F.lit(PRIME) - p.bitwiseAND(F.lit(PRIME))).cast("string"))
    return F.array_join(F.transform(packed, one), ",")


def hash_set(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, 31).cast("int")))


def likeness(a: str, b: str, both: str) -> Column:
    """Shared share of two hash sets, ``both`` being the size of their intersection; 1 for two empty ones."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.col(both) / (F.size(a) + F.size(b) - F.col(both))).cast("double")


def followers(keys: DataFrame) -> DataFrame:
    """``keys`` (id, text_hash, ...) with ``next``, the next key in ascending order; the first follows the last.

    Keys, unique and not null, are dealt by range, so that each partition looks up its next keys by
    itself; the first key of each partition is passed to the partition before.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("id", "text_hash")
    dealt = written(keys.repartitionByRange(parts, "id", "text_hash").withColumn("part", F.spark_partition_id()), "ranges")
    # one row for each partition: a number set by the session
    first = dealt.groupBy("part").agg(F.min(key).alias("first"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = first.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.first("first").over(whole)).alias("then"))
    near = F.lead(key).over(Window.partitionBy("part").orderBy("id", "text_hash"))
    return dealt.withColumn("near", near).join(F.broadcast(ends), "part").withColumn("next", F.coalesce("near", "then")).drop("part", "near", "then")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): its text's fingerprint and its edited text's.

    The edited text has its last floor(n_chars / 4) code points replaced by the first ones of the
    next document. Documents follow each other by doc_id, those with the same one by a hash of their texts; rows alike
    in both are one document, whose row is repeated. A null text counts as empty, a null doc_id as the
    least id. A single document follows itself. An empty table gives no rows; texts of any length are read whole.
    """
    docs = pick(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    docs, key = docs.select("id", F.xxhash64("text").alias("text_hash"), "text"), ["id", "text_hash"]
    # the one shuffle of whole texts, with their fingerprints; both joins below read it
    texts = with_fingerprint(docs, "text", "own").groupBy(*key).agg(F.min(F.struct("text", "own")).alias("least")).select(*key, "least.text", "least.own")
    asked = followers(docs.groupBy(*key).agg(F.max(F.length("text")).alias("n"), F.count("*").alias("times")))
    asked = asked.select(F.struct(*key).alias("for"), "times", F.col("next.id").alias("id"), F.col("next.text_hash").alias("text_hash"), F.expr("n div 4").cast("int").alias("most"))
    lent = texts.join(asked, key).select("for.*", "times", F.expr("left(text, most)").alias("lent"), hash_set(F.col("own")).alias("next"))
    rows = texts.join(lent, key).withColumn("n_chars", F.length("text").cast("long"))
    tail = F.expr("cast(n_chars div 4 as int)")
    rows = rows.withColumn("edited", F.concat(F.expr("left(text, cast(n_chars as int) - cast(n_chars div 4 as int))"), F.left(F.col("lent"), tail)))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows, "edited", "changed")
    rows = rows.withColumn("own_set", hash_set(F.col("own"))).withColumn("changed_set", hash_set(F.col("changed")))
    rows = rows.withColumn("both_edited", F.size(F.array_intersect("own_set", "changed_set"))).withColumn("both_next", F.size(F.array_intersect("own_set", "next")))
    out = rows.select(
        "times",
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness("own_set", "changed_set", "both_edited").alias("near_edited"),
        likeness("own_set", "next", "both_next").alias("near_next"),
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
