from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import conversations
from lakeloom.sources import database
from lakeloom.sources.sinks import TruncationError
from lakeloom.sources.versioned import VersionedTable
from lakeloom.streaming.ingest import file_stream, whole_groups_once

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
SCHEMA = "id long, name string, at long"


def rows_of(held: VersionedTable) -> list[tuple]:
    return sorted((tuple(r) for r in held.read().collect()), key=repr)


@pytest.fixture
def put(spark):
    url = "jdbc:derby:memory:loads;create=true"

    def write(rows, schema=SCHEMA):
        spark.createDataFrame(rows, schema).coalesce(1).write.format("jdbc").options(url=url, dbtable="people", driver=DRIVER).mode("overwrite").save()
        return url

    return write


def test_a_database_table_is_merged_by_cursor(spark, tmp_path, put):
    held = VersionedTable(spark, str(tmp_path / "t"))
    load = lambda url: database.load_database(spark, held, url, "people", ["ID"], "AT", driver=DRIVER)
    names = "ID long, NAME string, AT long"
    load(put([(1, "a", 10), (2, "b", 20), (3, "c", None)], names))
    # 1 changed behind the mark and is not asked for; 2 changed at the mark; 3 has no mark; 4 is new, twice; 5 shares the mark
    load(put([(1, "z", 10), (2, "y", 20), (3, "x", None), (4, "old", 30), (4, "new", 40), (5, "e", 20)], names))
    expected = [(1, "a", 10), (2, "y", 20), (3, "x", None), (4, "new", 40), (5, "e", 20)]
    assert rows_of(held) == expected
    # the same source again changes nothing, and a key that left stays
    load(put([(4, "new", 40)], names))
    assert rows_of(held) == expected


def test_the_mark_reaches_the_source(spark, tmp_path, put):
    held = VersionedTable(spark, str(tmp_path / "t"))
    url = put([(1, "a", 10)], "ID long, NAME string, AT long")
    database.load_database(spark, held, url, "people", ["ID"], "AT", driver=DRIVER)
    rows = database.due(database.read_database(spark, url, "people", driver=DRIVER), "AT", database.newest(held, "AT"))
    assert "GreaterThanOrEqual(AT,10)" in rows._jdf.queryExecution().executedPlan().toString()


def test_without_a_cursor_the_table_is_replaced(spark, tmp_path, put):
    held = VersionedTable(spark, str(tmp_path / "t"))
    database.load(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), held)
    database.load(spark.createDataFrame([(2, "c", 2), (3, "d", 0)], SCHEMA), held)
    assert rows_of(held) == [(2, "c", 2), (3, "d", 0)]
    with pytest.raises(TruncationError):
        database.load(spark.createDataFrame([], SCHEMA), held)
    assert len(rows_of(held)) == 2


def test_a_cursor_needs_a_key(spark, tmp_path):
    with pytest.raises(ValueError):
        database.load(spark.createDataFrame([], SCHEMA), VersionedTable(spark, str(tmp_path / "t")), cursor="at")


def test_empty_sources_and_new_columns(spark, tmp_path):
    held = VersionedTable(spark, str(tmp_path / "t"))
    empty = spark.createDataFrame([], SCHEMA)
    database.load(empty, held, ["id"], "at")
    assert database.newest(held, "at") is None and rows_of(held) == []
    database.load(spark.createDataFrame([(1, "a", 1)], SCHEMA), held, ["id"], "at")
    database.load(spark.createDataFrame([(2, "b", 2)], SCHEMA).withColumn("more", F.lit("x")), held, ["id"], "at")
    database.load(empty, held, ["id"], "at")
    assert rows_of(held) == [(1, "a", 1, None), (2, "b", 2, "x")]


TURNS = "conv long, turn long, text string"


def test_a_late_turn_renders_its_conversation_again(spark, tmp_path):
    turns, whole = VersionedTable(spark, str(tmp_path / "turns")), VersionedTable(spark, str(tmp_path / "whole"))
    rendered = []

    def render(rows):
        rendered.append({r["conv"] for r in rows.select("conv").distinct().collect()})
        return conversations.assembled(rows, "conv", ["turn"], F.col("text"), " ")

    def run(checkpoint="c", rows=None):
        if rows:
            spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = file_stream(spark, str(tmp_path / "in"), TURNS)
        whole_groups_once(stream, turns, whole, ["conv"], ["conv", "turn"], render, "q", str(tmp_path / checkpoint)).awaitTermination()

    run(rows=[(1, 1, "b"), (2, 0, "x"), (None, 0, "n")])
    run(rows=[(1, 0, "a"), (None, 1, "m")])
    expected = [(1, "a b", 2), (2, "x", 1), (None, "n m", 2)]
    assert rows_of(whole) == expected
    assert rendered[1] == {1, None}
    # a turn sent again takes its place, once
    run(rows=[(2, 0, "y"), (2, 0, "y")])
    assert rows_of(whole) == [expected[0], (2, "y", 1), expected[2]]
    # a new checkpoint sends all as batch 0, which both tables have
    before = (turns.version().number, whole.version().number)
    run("again")
    assert (turns.version().number, whole.version().number) == before


def test_a_stop_between_the_two_commits_is_made_good(spark, tmp_path):
    turns, whole = VersionedTable(spark, str(tmp_path / "turns")), VersionedTable(spark, str(tmp_path / "whole"))
    spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], TURNS).write.parquet(str(tmp_path / "in"))
    stops = [True]

    def render(rows):
        if stops.pop() if stops else False:
            raise RuntimeError("stopped")
        return conversations.assembled(rows, "conv", ["turn"], F.col("text"), " ")

    def run():
        stream = file_stream(spark, str(tmp_path / "in"), TURNS)
        whole_groups_once(stream, turns, whole, ["conv"], ["conv", "turn"], render, "q", str(tmp_path / "c")).awaitTermination()

    with pytest.raises(Exception, match="stopped"):
        run()
    assert turns.version().number == 0 and whole.version() is None
    run()
    assert turns.version().number == 0 and rows_of(whole) == [(1, "a b", 2)]
