"""Writers: guarded replacement, merge by key, partitioned and bucketed tables, one export for each key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.dedup import latest_by_state
from ..operators.incremental import delete_insert


class TruncationError(ValueError):
    """The new version has far fewer rows than the old one."""


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _paths(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    new, old, place = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new, old, place


def settled(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; a swap that was broken off is finished first.

    Writers call it, and so may readers. Between the two renames of a swap the old version lies beside the complete new one.
    """
    store, new, old, place = _paths(spark, path)
    if not store.exists(place):
        if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new, "_SUCCESS")):
            store.rename(new, place)
        elif store.exists(old):
            store.rename(old, place)
    return store.exists(place)


def _written_beside(df: DataFrame, path: str, by: tuple[str, ...]) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}.new")


def _put_in_place(spark: SparkSession, path: str) -> None:
    """The version beside the table takes its place: readers of the old plan are not cut off midway."""
    store, new, old, place = _paths(spark, path)
    store.delete(old, True)
    if store.exists(place):
        store.rename(place, old)
    store.rename(new, place)
    store.delete(old, True)


def _swapped(spark: SparkSession, df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    _written_beside(df, path, by)
    _put_in_place(spark, path)


def replace(df: DataFrame, path: str, floor: float = 0.5, by: tuple[str, ...] = ()) -> int:
    """Replace the table at ``path``; an error if the new one has less than ``floor`` of the old one's rows. Returns the rows.

    The new version is computed once: it is written beside the old one, counted there and then kept or dropped.
    """
    spark = df.sparkSession
    before = spark.read.parquet(path).count() if settled(spark, path) else 0
    _written_beside(df, path, by)
    n = spark.read.schema(df.schema).parquet(f"{path}.new").count()
    if n < floor * before:
        store, new, _, _ = _paths(spark, path)
        store.delete(new, True)
        raise TruncationError(f"{n} rows would replace {before}")
    _put_in_place(spark, path)
    return n


def _read(spark: SparkSession, path: str, like: StructType | None = None) -> DataFrame:
    """The table at ``path``; columns that its folders are named by have the type that they have in ``like``, or are text.

    Spark would take '0012' in a folder's name for the number 12.
    """
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        rows = spark.read.parquet(path)
        files = rows.inputFiles()
        folders = {step.partition("=")[0] for step in files[0].split("/")[:-1] if "=" in step} if files else set()
    finally:
        spark.conf.set(name, before)
    known = {f.name: f.dataType for f in like or []}
    schema = StructType([StructField(f.name, known.get(f.name, f.dataType) if f.name in folders else f.dataType) for f in rows.schema])
    return spark.read.schema(schema).parquet(path)


def _updated(df: DataFrame, path: str, keys: list[str], by: tuple[str, ...], combined) -> None:
    """Rewrite the table with ``combined(old, df)``: only the partitions that ``df`` has rows in, if ``by`` is part of the keys.

    Then no row of another partition can have one of its keys, and a dynamic overwrite leaves the others alone.
    """
    spark = df.sparkSession
    if not settled(spark, path):
        _swapped(spark, combined(None, df), path, by)
        return
    old = _read(spark, path, df.schema)
    if by and set(by) <= set(keys):
        touched = df.select(*by).distinct()
        # literals, so that the scan of the table is of these partitions alone
        values = [[F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, r, strict=True)] for r in touched.collect()]
        if not values:
            return
        here = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, v) for v in values])
        rows = combined(old.where(here), df)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    else:
        _swapped(spark, combined(old, df), path, by)


def merge(df: DataFrame, path: str, keys: list[str], by: tuple[str, ...] = ()) -> None:
    """Rows of ``df`` replace those of their keys; new columns are added, absent ones are null.

    Of rows of ``df`` that repeat a key, the one whose other columns are greatest stays. A stop while partitions are
    overwritten can lose them; :class:`lakeloom.sources.versioned.VersionedTable` has no such moment. Give partition columns that are part of the keys as ``by``: a batch then rewrites its own partitions alone.
    """
    _updated(df, path, keys, by, lambda old, new: latest_by_state(new, keys) if old is None else delete_insert(old, latest_by_state(new, keys), keys))


def keep_latest(df: DataFrame, path: str, keys: list[str], recency: list[str], by: tuple[str, ...] = ()) -> None:
    """The newest row of each key of the table and ``df`` together, so batches may come late or twice; ``by`` as for :func:`merge`."""
    _updated(df, path, keys, by, lambda old, new: latest_by_state(new if old is None else old.unionByName(new, allowMissingColumns=True), keys, *recency))


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """A table whose joins and groupings on ``keys`` need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def export_csv(df: DataFrame, path: str, by: str) -> None:
    """CSV files under a folder for each value of ``by``; rows are dealt by it, large values over several files."""
    df.repartition(F.col(by), F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("overwrite").partitionBy(by).option("header", True).csv(path)


def export_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in a folder for each value of ``by`` if it is named; fields without a value are left out."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def analysed(spark: SparkSession, name: str) -> None:
    """Statistics of a saved table and of all its columns, for the optimizer's choice of joins."""
    spark.sql(f"analyze table {name} compute statistics for all columns")


def data_version(df: DataFrame) -> str:
    """A digest of all rows, whatever their order."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in df.columns])
    facts = df.agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(row % (1 << 31)).alias("s"))
    return facts.select(F.sha2(F.concat_ws(":", "n", "x", "s").cast("binary"), 256)).first()[0]


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that a table's folders are named by."""
    files = spark.read.parquet(path).inputFiles()
    return [step.partition("=")[0] for step in files[0].split("/")[:-1] if "=" in step] if files else []


def compact(spark: SparkSession, path: str, file_mb: int = 512) -> int:
    """Rewrite a table's small files to about ``file_mb`` each, in its own partitions; returns how many files it has then."""
    settled(spark, path)
    store, _, _, place = _paths(spark, path)
    files = max(1, round(store.getContentSummary(place).getLength() / (file_mb << 20)))
    rows, by = _read(spark, path), partition_columns(spark, path)
    if by:
        # rows of a partition go together, and a large one to several tasks
        name, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set(name, f"{file_mb}m")
        try:
            _written_beside(rows.hint("rebalance", *by), path, tuple(by))
        finally:
            spark.conf.set(name, before)
        _put_in_place(spark, path)
    else:
        _swapped(spark, rows.repartition(files), path)
    return len(spark.read.parquet(path).inputFiles())
