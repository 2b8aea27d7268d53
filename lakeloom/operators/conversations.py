"""Turns, transcripts and tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assembled(turns: DataFrame, conversation: str, order: list[str], text: Column, separator: str = "\n") -> DataFrame:
    """One row for each conversation: its turns' text in order, and how many there are. Null texts count as empty."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__text"))))
    joined = F.array_join(F.transform(parts, lambda p: p["__text"]), separator)
    return turns.groupBy(conversation).agg(joined.alias("conversation_text"), F.count("*").alias("n_turns"))


def numbered(turns: DataFrame, conversation: str, order: list[str], keep: Column | None = None) -> DataFrame:
    """Turns that ``keep`` admits, numbered from 1, with ``is_opening`` on the first."""
    along = Window.partitionBy(conversation).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = turns if keep is None else turns.where(keep)
    return rows.withColumn("turn_number", F.row_number().over(along)).withColumn("is_opening", F.col("turn_number") == 1)


def without_repeats(messages: DataFrame, thread: str, order: list[str], same: list[str]) -> DataFrame:
    """The first of equal messages of a thread, and ``message_number`` anew."""
    first = Window.partitionBy(thread, *same).orderBy(*order)
    kept = messages.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")
    return kept.withColumn("message_number", F.row_number().over(Window.partitionBy(thread).orderBy(*order)))


def dominant(tags: DataFrame, conversation: str, tag: str) -> DataFrame:
    """The tag of each conversation that is the most frequent in the corpus, by name among equals."""
    corpus = tags.groupBy(tag).agg(F.count("*").alias("__n"))
    rows = tags.select(conversation, tag).distinct().join(corpus, tag)
    least = F.min(F.struct((-F.col("__n")).alias("n"), F.col(tag).alias("tag")))
    return rows.groupBy(conversation).agg(least.alias("__best")).select(conversation, F.col("__best.tag").alias("dominant_tag"))


def exploded_tags(df: DataFrame, tags: str, tag: str) -> DataFrame:
    """One row for each tag of an array column, trimmed and lower-cased; blank ones go."""
    rows = df.withColumn(tag, F.explode(tags)).withColumn(tag, F.nullif(F.lower(F.trim(F.col(tag))), F.lit("")))
    return rows.where(F.col(tag).isNotNull()).drop(tags)
