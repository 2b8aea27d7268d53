"""Tables in versions: immutable data files, and one manifest a version that names them.

A version comes to be by a single step, its manifest's renaming to the next number. What was written before that step is seen by
nobody, and two writers can't both take a number. Rows that change cost the files that hold them, not the table: the files
that a batch's keys lie in are found by a scan of the key columns, and those alone are written anew.

A manifest holds the table's schema, so values are never read as another type, the names of its files, and a ledger
of the batches that each streaming query has committed, so that a batch and the note of it are one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import latest_by_state
from . import stores
from .sinks import TruncationError


class ConflictError(RuntimeError):
    """Another writer has taken the version that a change was made for."""


@dataclass(frozen=True)
class Version:
    """One state of the table: its files by name, with their bytes."""

    number: int
    schema: str
    files: dict[str, int] = field(default_factory=dict)
    ledger: dict[str, int] = field(default_factory=dict)
    operation: str = "create"

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema, "files": self.files, "ledger": self.ledger, "operation": self.operation})


def _same(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__{k}") for k in keys])


class VersionedTable:
    """A table of the folder ``path``. Writers may run side by side; one of two that change the same version tries again."""

    def __init__(self, spark: SparkSession, path: str, tries: int = 5) -> None:
        self.spark, self.path, self.tries = spark, path.rstrip("/"), tries

    # what there is

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in stores.names_in(self.spark, f"{self.path}/_versions") if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or the one of a number; None if there is no table yet."""
        known = self.versions()
        if not known:
            return None
        number = known[-1] if number is None else number
        if number not in known:
            raise ValueError(f"no version {number}; there are {known[0]} to {known[-1]}")
        return Version(**json.loads(stores.read_text(self.spark, f"{self.path}/_versions/{number:020d}.json")))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one."""
        found = self.version(number)
        if found is None:
            raise ValueError(f"there is no table at {self.path}")
        return self._rows(found, found.files)

    def _rows(self, of: Version, files) -> DataFrame:
        schema = StructType.fromJson(json.loads(of.schema))
        paths = [f"{self.path}/data/{f}" for f in files]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """The rows that differ between two versions, with ``__sign``: 1 for new ones, -1 for those that went.

        Only files that are in one of the two versions are read. Rows that were merely moved to another file come with both signs, so
        sums over signs are right; :func:`net_changes` takes them out.
        """
        old, new = self.version(since), self.version(until)
        gone, come = self._rows(old, sorted(old.files.keys() - new.files.keys())), self._rows(new, sorted(new.files.keys() - old.files.keys()))
        return come.withColumn("__sign", F.lit(1)).unionByName(gone.withColumn("__sign", F.lit(-1)), allowMissingColumns=True)

    # how it changes

    def _commit(self, base: Version | None, schema: str, files: dict[str, int], operation: str, batch: tuple[str, int] | None, noted: dict[str, int] | None = None) -> Version:
        ledger = (dict(base.ledger) if base else {}) | (noted or {})
        if batch:
            ledger[batch[0]] = batch[1]
        new = Version(base.number + 1 if base else 0, schema, files, ledger, operation)
        if not stores.put_if_absent(self.spark, f"{self.path}/_versions/{new.number:020d}.json", new.to_json()):
            raise ConflictError(f"version {new.number} of {self.path} is another writer's")
        return new

    def _written(self, df: DataFrame) -> dict[str, int]:
        """Data files of ``df`` under a name that nothing else has."""
        folder = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{folder}")
        return {f"{folder}/{n}": size for n, size in stores.names_in(self.spark, f"{self.path}/data/{folder}").items() if n.endswith(".parquet")}

    def _changed(self, operation: str, change: Callable[[Version | None], tuple[str, dict[str, int]] | None], batch: tuple[str, int] | None, noted: dict[str, int] | None = None) -> Version | None:
        """Apply ``change`` to the newest version; again to the version after it if another writer was first."""
        for left in reversed(range(self.tries)):
            base = self.version()
            if batch and base and base.ledger.get(batch[0], -1) >= batch[1]:
                return base
            made = change(base)
            if made is None:
                return base
            try:
                return self._commit(base, *made, operation, batch, noted)
            except ConflictError:
                if not left:
                    raise

    def _schema(self, base: Version | None, df: DataFrame) -> str:
        """The table's columns and then new ones of ``df``, all nullable; an error if a column is of another type."""
        old = StructType.fromJson(json.loads(base.schema)) if base else StructType()
        for f in df.schema:
            if f.name not in old.names:
                old = StructType([*old.fields, f])
            elif old[f.name].dataType != f.dataType:
                raise TypeError(f"{f.name} is {old[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the batch")
        return StructType([type(f)(f.name, f.dataType, True) for f in old]).json()

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> Version:
        """Add rows. ``batch`` is (query, number): a number that the query has committed, or one before it, does nothing."""
        return self._changed("append", lambda base: (self._schema(base, df), (base.files if base else {}) | self._written(df)), batch)

    def replace(self, df: DataFrame, floor: float = 0.5, batch: tuple[str, int] | None = None, ledger: dict[str, int] | None = None) -> Version:
        """All rows anew; an error, and the old version stays, if there are fewer than ``floor`` of its number.

        ``ledger`` is set whatever it held before, so that a table may be made anew at the same batch.
        """

        def change(base: Version | None):
            files = self._written(df)
            if base:
                before, now = self.read(base.number).count(), self._rows(Version(0, df.schema.json()), files).count()
                if now < floor * before:
                    raise TruncationError(f"{now} rows would replace {before}")
            return self._schema(None, df), files

        return self._changed("replace", change, batch, ledger)

    def _holding(self, base: Version, keys: list[str], of: DataFrame) -> list[str]:
        """The files that hold any of the keys of ``of``: a scan of the key columns, of which as many rows come back as there are files."""
        rows = self._rows(base, base.files).select(*keys, F.col("_metadata.file_path").alias("__file"))
        found = rows.join(_named(of, keys).distinct(), _same(keys), "left_semi").select("__file").distinct().collect()
        return ["/".join(r["__file"].rsplit("/", 2)[1:]) for r in found]

    def _merged(self, base: Version, schema: str, df: DataFrame, keys: list[str], rows: Callable[[DataFrame], DataFrame]) -> tuple[str, dict[str, int]]:
        touched = self._holding(base, keys, df)
        old = self._rows(Version(0, schema), touched)
        kept = {f: n for f, n in base.files.items() if f not in set(touched)}
        return schema, kept | self._written(rows(old))

    def upsert(self, df: DataFrame, keys: list[str], recency: tuple[str, ...] = (), batch: tuple[str, int] | None = None, keep: Column | None = None) -> Version:
        """Rows of ``df`` take the place of those of their keys; null keys equal each other.

        Repeats of a key within ``df`` are folded first: the newest by ``recency`` stays, nulls oldest, and of rows that tie on it the one
        whose other columns are greatest, so the outcome is the same in every run. Columns that the table lacks are added, those that
        ``df`` lacks are null. Files without any of the keys stay as they are. Keys whose row does not meet ``keep`` are only taken out.
        """
        folded = latest_by_state(df, keys, *recency)
        folded = folded if keep is None else folded.where(keep)

        def change(base: Version | None):
            schema = self._schema(base, df)
            if base is None:
                return schema, self._written(folded)
            gone = _named(df, keys).distinct()
            return self._merged(base, schema, df, keys, lambda old: old.join(gone, _same(keys), "left_anti").unionByName(folded, allowMissingColumns=True))

        return self._changed("upsert", change, batch)

    def keep_latest(self, df: DataFrame, keys: list[str], recency: tuple[str, ...], batch: tuple[str, int] | None = None) -> Version:
        """The newest row of each key of the table and ``df`` together, so that late or repeated batches do no harm."""

        def change(base: Version | None):
            schema = self._schema(base, df)
            if base is None:
                return schema, self._written(latest_by_state(df, keys, *recency))
            return self._merged(base, schema, df, keys, lambda old: latest_by_state(old.unionByName(df, allowMissingColumns=True), keys, *recency))

        return self._changed("keep_latest", change, batch)

    def delete(self, of: DataFrame, keys: list[str], batch: tuple[str, int] | None = None) -> Version | None:
        """Without the rows that have the keys of ``of``; null keys equal each other."""

        def change(base: Version | None):
            if base is None:
                return None
            gone = _named(of, keys).distinct()
            return self._merged(base, base.schema, of, keys, lambda old: old.join(gone, _same(keys), "left_anti"))

        return self._changed("delete", change, batch)

    # upkeep

    def compact(self, file_mb: int = 512) -> Version | None:
        """Files of less than half of ``file_mb`` are put together; larger ones stay as they are."""

        def change(base: Version | None):
            small = {f: n for f, n in base.files.items() if n < file_mb << 19} if base else {}
            if len(small) < 2:
                return None
            rows = self._rows(base, sorted(small)).repartition(max(1, round(sum(small.values()) / (file_mb << 20))))
            return base.schema, {f: n for f, n in base.files.items() if f not in small} | self._written(rows)

        return self._changed("compact", change, None)

    def vacuum(self, keep: int = 2) -> int:
        """Drop all versions but the newest ``keep``, and data that none of those names; how many files went.

        Not while a writer is at work: what it has written and not committed is named by no version yet.
        """
        known = self.versions()
        kept = known[-keep:]
        named = set().union(*[self.version(n).files for n in kept])
        for n in known[:-keep]:
            stores.delete(self.spark, f"{self.path}/_versions/{n:020d}.json")
        gone = 0
        for folder in stores.names_in(self.spark, f"{self.path}/data"):
            files = [n for n in stores.names_in(self.spark, f"{self.path}/data/{folder}") if n.endswith(".parquet")]
            left = [n for n in files if f"{folder}/{n}" in named]
            gone += len(files) - len(left)
            for n in set(files) - set(left) if left else []:
                stores.delete(self.spark, f"{self.path}/data/{folder}/{n}")
            if not left:
                stores.delete(self.spark, f"{self.path}/data/{folder}")
        return gone


def net_changes(changes: DataFrame) -> DataFrame:
    """Changed rows with how often each has come (positive ``__sign``) or gone (negative); rows merely moved are left out.

    Rows are compared whole, so columns must be of types that can be grouped.
    """
    columns = [c for c in changes.columns if c != "__sign"]
    return changes.groupBy(*columns).agg(F.sum("__sign").alias("__sign")).where("__sign <> 0")
