"""Versioned tables: upserts, readers while a writer stops, writers side by side, exactly-once batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import stores, versioned
from lakeloom.sources.sinks import TruncationError
from lakeloom.sources.versioned import ConflictError, VersionedTable, net_changes

SCHEMA = "p string, k long, v string, at long"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, f"{tmp_path}/table")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_text_that_looks_like_numbers_stays_text(spark, table):
    table.upsert(frame(spark, ("0012", 1, "a", 1), ("0012", 2, "b", 1), ("12", 1, "c", 1)), ["p", "k"])
    table.upsert(frame(spark, ("0012", 1, "new", 2)), ["p", "k"])
    assert rows(table.read()) == [("0012", 1, "new", 2), ("0012", 2, "b", 1), ("12", 1, "c", 1)]
    table.compact()
    assert rows(table.read()) == [("0012", 1, "new", 2), ("0012", 2, "b", 1), ("12", 1, "c", 1)]


def test_repeats_in_a_batch_are_folded(spark, table):
    table.upsert(frame(spark, ("x", 1, "a", 1), ("x", 1, "b", 3), ("x", 1, "c", 2)), ["k"], ("at",))
    assert rows(table.read()) == [("x", 1, "b", 3)]
    table.upsert(frame(spark, ("x", 1, "d", 0), ("x", 1, "e", None), ("x", 2, "f", None), ("x", 2, "g", None)), ["k"], ("at",))
    assert rows(table.read()) == [("x", 1, "d", 0), ("x", 2, "g", None)]


def test_null_keys_are_one_key(spark, table):
    table.upsert(frame(spark, ("x", None, "a", 1), ("x", 1, "b", 1)), ["k"])
    table.upsert(frame(spark, ("x", None, "c", 1)), ["k"])
    assert rows(table.read()) == [("x", 1, "b", 1), ("x", None, "c", 1)]
    table.delete(spark.createDataFrame([(None,)], "k long"), ["k"])
    assert rows(table.read()) == [("x", 1, "b", 1)]


def test_files_without_the_keys_stay(spark, table):
    table.append(spark.range(1000).selectExpr("'p' as p", "id as k", "'old' as v", "0L as at").repartitionByRange(8, "k"))
    before = table.version().files
    assert len(before) == 8
    table.upsert(frame(spark, ("p", 3, "new", 1), ("p", 5000, "more", 1)), ["k"])
    after = table.version().files
    assert len(before.keys() & after.keys()) == 7
    assert table.read().count() == 1001 and table.read().where("v = 'old'").count() == 999


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["data", "manifest", "rename"])
def test_a_writer_that_stops_leaves_the_old_version(spark, table, monkeypatch, step):
    table.upsert(frame(spark, ("x", 1, "old", 1), ("x", 2, "old", 1)), ["k"])
    old = rows(table.read())

    def stop(*_, **__):
        raise Stopped

    if step == "data":
        written = VersionedTable._written
        monkeypatch.setattr(VersionedTable, "_written", lambda self, df: (written(self, df), stop()))
    elif step == "manifest":
        monkeypatch.setattr(versioned.stores, "put_if_absent", stop)
    else:
        # the manifest is written beside, its renaming is never reached
        text = stores.write_text
        monkeypatch.setattr(stores, "write_text", lambda *a: (text(*a), stop()))
    with pytest.raises(Stopped):
        table.upsert(frame(spark, ("x", 1, "new", 2)), ["k"])
    assert rows(table.read()) == old and table.versions() == [0]
    monkeypatch.undo()
    table.upsert(frame(spark, ("x", 1, "new", 2)), ["k"])
    assert rows(table.read()) == [("x", 1, "new", 2), ("x", 2, "old", 1)]
    # what was left behind goes
    table.vacuum(1)
    assert set(table.version().files) == {f"{d}/{n}" for d in stores.names_in(spark, f"{table.path}/data") for n in stores.names_in(spark, f"{table.path}/data/{d}") if n.endswith(".parquet")}


def test_readers_keep_the_version_that_they_began_with(spark, table):
    table.upsert(frame(spark, ("x", 1, "old", 1)), ["k"])
    reader = table.read()
    table.upsert(frame(spark, ("x", 1, "new", 2)), ["k"])
    assert rows(reader) == [("x", 1, "old", 1)] and rows(table.read(0)) == rows(reader)
    with pytest.raises(ValueError):
        table.read(7)


def test_writers_side_by_side(spark, table):
    table.upsert(frame(spark, ("x", 1, "a", 1)), ["k"])
    other = VersionedTable(spark, table.path)
    commit, met = VersionedTable._commit, []

    def late(self, base, *rest):
        # the other one commits between this one's reading and its commit
        if not met:
            met.append(1)
            commit(other, base, *other_change(base))
        return commit(self, base, *rest)

    def other_change(base):
        return base.schema, base.files | other._written(frame(spark, ("x", 2, "theirs", 1))), "append", None

    table._commit = late.__get__(table)
    table.upsert(frame(spark, ("x", 1, "ours", 2), ("x", 2, "ours", 2)), ["k"])
    assert rows(table.read()) == [("x", 1, "ours", 2), ("x", 2, "ours", 2)]
    assert [table.version(n).operation for n in table.versions()] == ["upsert", "append", "upsert"]
    with pytest.raises(ConflictError):
        commit(table, table.version(0), *other_change(table.version(0)))


def test_a_batch_is_committed_once(spark, table):
    batch = frame(spark, ("x", 1, "a", 1), ("x", 1, "a", 1))
    table.append(batch, ("query", 0))
    table.append(batch, ("query", 0))
    assert table.read().count() == 2
    table.append(batch, ("query", 1))
    table.append(batch, ("another", 0))
    table.append(batch, ("query", 0))
    assert table.read().count() == 6 and table.version().ledger == {"query": 1, "another": 0}


def test_columns_are_added_and_never_retyped(spark, table):
    table.upsert(frame(spark, ("x", 1, "a", 1)), ["k"])
    table.upsert(frame(spark, ("x", 2, "b", 1)).withColumn("more", F.lit(5)).drop("v"), ["k"])
    assert table.read().columns == ["p", "k", "v", "at", "more"]
    assert rows(table.read()) == [("x", 1, "a", 1, None), ("x", 2, None, 1, 5)]
    with pytest.raises(TypeError):
        table.append(frame(spark, ("x", 2, "b", 1)).withColumn("k", F.lit("text")))


def test_keep_latest_takes_late_batches(spark, table):
    table.keep_latest(frame(spark, ("x", 1, "b", 5)), ["k"], ("at",))
    table.keep_latest(frame(spark, ("x", 1, "late", 3), ("x", 2, "c", 1)), ["k"], ("at",))
    assert rows(table.read()) == [("x", 1, "b", 5), ("x", 2, "c", 1)]


def test_truncation_is_refused(spark, table):
    table.replace(frame(spark, *[("x", i, "a", 1) for i in range(10)]))
    with pytest.raises(TruncationError):
        table.replace(frame(spark, ("x", 1, "a", 1)))
    assert table.read().count() == 10
    table.replace(frame(spark, ("x", 1, "a", 1)), floor=0)
    assert table.read().count() == 1


def test_changes_between_versions(spark, table):
    table.append(spark.range(100).selectExpr("'p' as p", "id as k", "'old' as v", "0L as at").repartitionByRange(4, "k"))
    table.upsert(frame(spark, ("p", 3, "new", 1), ("p", 500, "more", 1)), ["k"])
    table.delete(spark.createDataFrame([(7,)], "k long"), ["k"])
    found = {(r["k"], r["v"], r["__sign"]) for r in net_changes(table.changes(0)).collect()}
    assert found == {(3, "old", -1), (3, "new", 1), (500, "more", 1), (7, "old", -1)}
    assert net_changes(table.changes(2)).isEmpty()
    table.compact(1)
    assert net_changes(table.changes(2)).isEmpty() and len(table.version().files) == 1


def test_empty_batches_and_tables(spark, table):
    with pytest.raises(ValueError):
        table.read()
    assert table.delete(frame(spark), ["k"]) is None
    table.upsert(frame(spark), ["k"])
    assert table.read().count() == 0
    table.upsert(frame(spark, ("x", 1, "a", 1)), ["k"])
    table.upsert(frame(spark), ["k"])
    assert rows(table.read()) == [("x", 1, "a", 1)]
