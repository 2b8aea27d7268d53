"""Tolerant readers of delimited text and JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso8601, json_text
from ..functions.keys import row_hash


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, multiline: bool = False) -> DataFrame:
    """Tab-separated text, every column a string; lines with too few or too many fields go.

    A quote doubles within quotes. Lines end at a newline alone, so a bare carriage return stays in
    its field; with ``multiline`` quoted fields may hold newlines, at the price that files are not split.
    """
    reader = spark.read.schema(_strings([*columns, "__bad"])).options(
        sep="\t", quote='"', escape='"', header=header, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="__bad", multiLine=multiline
    )
    if not multiline:
        reader = reader.option("lineSep", "\n")
    return reader.csv(path).where("__bad is null").drop("__bad")


def with_origin(df: DataFrame, **literals: str) -> DataFrame:
    """``df`` with ``extracted_<name>`` literals and ``row_hash`` over its own columns."""
    own = df.columns
    return df.withColumns({f"extracted_{k}": F.lit(v) for k, v in literals.items()}).withColumn("row_hash", row_hash(*own))


def rewritten_tsv(spark: SparkSession, path: str, columns: Sequence[str], out: str, **literals: str) -> int:
    """Tab-separated files as CSV with their origin and row hash; returns the rows. Files of a header alone leave none."""
    with_origin(read_tsv(spark, path, columns), **literals).write.mode("overwrite").option("header", True).option("escape", '"').csv(out)
    return spark.read.option("header", True).option("escape", '"').csv(out).count()


def read_json_lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One JSON object a line, its first level as strings (nested values as JSON text), and the file's name; lines that are none go."""
    lines = spark.read.text(path).withColumn("file_name", F.input_file_name())
    parsed = F.from_json("value", "map<string,string>").alias("m")
    rows = lines.select(parsed, "file_name").where("m is not null")
    return rows.select(*[F.try_element_at("m", F.lit(c)).alias(c) for c in columns], "file_name")


def unescaped(text: Column) -> Column:
    """JSON that was put into a JSON string a second time loses a level; objects in quotes or with stray escapes are repaired."""
    inner = F.get_json_object(F.concat(F.lit('{"x":'), text, F.lit("}")), "$.x")
    return F.coalesce(F.when(text.startswith('"') & text.endswith('"'), inner), json_text.repaired(text))


def event_time(text: Column) -> Column:
    """ISO text of an event's time, be it ISO or seconds since 1970; null if it is neither."""
    epoch = F.timestamp_seconds(text.try_cast("double"))
    return iso8601.to_iso8601(F.when(text.rlike(r"^\d{9,11}(\.\d+)?$"), epoch).otherwise(iso8601.parse_iso8601(text)))


def normalised_log(raw: DataFrame, json_columns: Sequence[str] = ("context", "event"), time: str = "time") -> DataFrame:
    """Tracking logs in one shape: strings throughout, JSON once encoded, time in ISO form."""
    return raw.withColumns({c: unescaped(F.col(c)) for c in json_columns} | {time: event_time(F.col(time))})


def read_database(spark: SparkSession, url: str, name: str, key: str | None = None, cursor: str | None = None, since=None, excluded: Sequence[str] = (), partitions: int = 1, bounds: tuple[int, int] | None = None, **options: str) -> DataFrame:
    """A table by JDBC, in parallel over an integer key if ``bounds`` are given; rows after ``since`` alone if there is a cursor.

    ``excluded`` columns are never asked for.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, fetchsize="50000", **options)
    if key and bounds and partitions > 1:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    rows = reader.load()
    rows = rows.select(*[c for c in rows.columns if c not in set(excluded)])
    return rows.where(F.col(cursor) > F.lit(since)) if cursor and since is not None else rows
