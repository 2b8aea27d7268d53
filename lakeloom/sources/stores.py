"""Files and folders through Hadoop's file systems, so that any store that Spark reads will do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def store_of(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return store_of(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """The names of a folder's files and folders, with their bytes; none if there is no such folder."""
    if not exists(spark, folder):
        return {}
    return {f.getPath().getName(): f.getLen() for f in store_of(spark, folder).listStatus(_path(spark, folder))}


def read_text(spark: SparkSession, path: str) -> str:
    stream = store_of(spark, path).open(_path(spark, path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = store_of(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with all of its text at once, unless there is one of the name already.

    The text is written under another name and renamed without overwriting, so no reader sees a part of it.
    """
    jvm = spark.sparkContext._jvm
    if exists(spark, path):
        return False
    beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    where = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        where.rename(_path(spark, beside), _path(spark, path), none)
        return True
    except Exception as e:
        if "AlreadyExists" not in str(e):
            raise
        return False
    finally:
        if exists(spark, beside):
            delete(spark, beside)


def delete(spark: SparkSession, path: str) -> None:
    store_of(spark, path).delete(_path(spark, path), True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the one that ``spark.checkpoint.dir`` names; on one machine without it, in a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        held = context._jsc.sc().getCheckpointDir()
        if not held.isDefined():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
            held = context._jsc.sc().getCheckpointDir()
        shared = held.get()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
