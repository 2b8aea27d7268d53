"""Structured Streaming forms of the incremental batches."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import keep_latest
from ..sources.versioned import VersionedTable


def file_stream(spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder; the checkpoint remembers which have been taken."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(path)


def without_repeats(stream: DataFrame, keys: list[str], at: str, late: str = "7 days") -> DataFrame:
    """The first row of each key; keys older than ``late`` behind the newest row are forgotten, so state is bounded."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, at: str, width: str, by: list[str], late: str = "1 hour") -> DataFrame:
    """Counts of each window of event time, complete once the watermark has passed it."""
    rows = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return rows.groupBy(F.window(at, width).alias("span"), *by).agg(F.count("*").alias("n")).select("span.start", "span.end", *by, "n")


def merge_into(stream: DataFrame, path: str, keys: list[str], recency: list[str], checkpoint: str, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Keep a table's newest row of each key, over what has arrived; a batch that is late or repeated does no harm.

    With partition columns ``by`` that are part of the keys, a batch rewrites its own partitions alone.
    """

    def put(batch: DataFrame, _: int) -> None:
        keep_latest(batch, path, keys, recency, by)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a table of Parquet files, each row once."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_once(stream: DataFrame, table: VersionedTable, name: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived, each batch once: its number is noted in the same commit as its rows.

    ``name`` stands for this query in the table's ledger. A batch that runs again, after a stop at any
    place or with an old checkpoint, is passed over if the table has it; rows written and not committed belong to no version.
    """

    def put(batch: DataFrame, number: int) -> None:
        table.append(batch, batch=(name, number))

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_once(stream: DataFrame, table: VersionedTable, keys: list[str], recency: tuple[str, ...], name: str, checkpoint: str) -> StreamingQuery:
    """Like :func:`append_once`, keeping the newest row of each key; only files that hold keys of a batch are written anew."""

    def put(batch: DataFrame, number: int) -> None:
        table.keep_latest(batch, keys, recency, batch=(name, number))

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def whole_groups_once(stream: DataFrame, rows: VersionedTable, groups: VersionedTable, group: list[str], keys: list[str], render: Callable[[DataFrame], DataFrame], name: str, checkpoint: str) -> StreamingQuery:
    """Rows of groups that may come late, and each group rendered again, whole, whenever rows of it arrive.

    ``rows`` keeps what has arrived, one row of each of ``keys``; ``render`` makes the rows of ``groups`` from all rows of the groups that
    a batch touches, read from there, so no state is held for groups that wait and none is lost to a time limit. Groups
    without news stay as they are. Each table notes the batch in its own commit: after a stop between the two, the batch
    runs again, passes over the first and makes good the second. Rows whose group is null are a group.
    """

    def put(batch: DataFrame, number: int) -> None:
        rows.upsert(batch, keys, batch=(name, number))
        touched = batch.select(*[F.col(c).alias(f"__{c}") for c in group]).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group])
        groups.upsert(render(rows.read().join(touched, same, "left_semi")), group, batch=(name, number))

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
