"""Batches exactly once, digests between runs, and the sinks' and joins' measured errors of the round before."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import joins, quality
from lakeloom.sources import digests, sinks, versioned
from lakeloom.sources.digests import DigestStore
from lakeloom.sources.versioned import VersionedTable
from lakeloom.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# streams


@pytest.fixture
def arrivals(spark, tmp_path):
    source = f"{tmp_path}/in"
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, numPartitions=1).selectExpr("id", f"id % 4 as k", f"{i} as at").write.mode("append").parquet(source)
    return lambda: ingest.file_stream(spark, source, "id long, k long, at int", files_per_trigger=1)


def test_a_replayed_batch_leaves_one_copy(spark, tmp_path, arrivals):
    table, checkpoint = VersionedTable(spark, f"{tmp_path}/t"), f"{tmp_path}/c"
    ingest.append_once(arrivals(), table, "events", checkpoint).awaitTermination()
    assert rows(table.read().select("id")) == sorted([(i,) for i in range(30)], key=repr) and table.version().ledger == {"events": 2}
    # the note of the last batch is lost with the checkpoint's newest commit, so it runs again
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.strip(".").startswith("2"):
            os.remove(f"{checkpoint}/commits/{name}")
    ingest.append_once(arrivals(), table, "events", checkpoint).awaitTermination()
    assert table.read().count() == 30 and table.version().number == 2
    # another query appends of its own
    ingest.append_once(arrivals(), table, "copy", f"{tmp_path}/c2").awaitTermination()
    assert table.read().count() == 60


def test_a_stop_between_write_and_commit_leaves_one_copy(spark, tmp_path, arrivals, monkeypatch):
    table, checkpoint = VersionedTable(spark, f"{tmp_path}/t"), f"{tmp_path}/c"
    put, calls = versioned.stores.put_if_absent, []

    def stops_once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return put(*args)

    monkeypatch.setattr(versioned.stores, "put_if_absent", stops_once)
    with pytest.raises(Exception, match="stopped"):
        ingest.append_once(arrivals(), table, "events", checkpoint).awaitTermination()
    assert table.read().count() == 10
    ingest.append_once(arrivals(), table, "events", checkpoint).awaitTermination()
    assert rows(table.read().select("id")) == sorted([(i,) for i in range(30)], key=repr)


def test_merged_batches(spark, tmp_path, arrivals):
    table = VersionedTable(spark, f"{tmp_path}/t")
    ingest.merge_once(arrivals(), table, ["k"], ("at", "id"), "events", f"{tmp_path}/c").awaitTermination()
    assert rows(table.read()) == [(26, 2, 2), (27, 3, 2), (28, 0, 2), (29, 1, 2)]


# digests


def test_the_second_run_drops_what_the_first_had(spark, tmp_path):
    store = DigestStore(spark, str(tmp_path))
    first = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("b", ""), (None, None)], "k string, v string")
    assert len(rows(store.unseen(first, ["k", "v"], 0))) == 4
    second = spark.createDataFrame([("a", "1"), ("b", None), ("c", "1"), ("", None), ("ab", "")], "k string, v string")
    assert rows(store.unseen(second, ["k", "v"], 1)) == [("", None), ("ab", ""), ("c", "1")]
    # a run that is repeated
    assert rows(store.unseen(second, ["k", "v"], 1)) == [("", None), ("ab", ""), ("c", "1")]
    assert store.digests.read().count() == 7
    assert rows(store.unseen(second, ["k", "v"], 2)) == []


def test_only_hit_buckets_are_read(spark, tmp_path):
    store = DigestStore(spark, str(tmp_path))
    store.unseen(spark.range(20_000).selectExpr("cast(id as string) as k"), ["k"], 0)
    new = spark.range(50_000, 51_000).selectExpr("cast(id as string) as k")
    assert store.unseen(new, ["k"], 1).count() == 1000
    assert len(store.buckets_read) < 20
    assert store.unseen(spark.createDataFrame([("77",), ("x",)], "k string"), ["k"], 2).count() == 1
    assert 1 <= len(store.buckets_read) <= 2
    store.compact()
    assert store.filters.read().groupBy("bucket").count().where("count > 1").isEmpty()
    assert store.unseen(new, ["k"], 3).count() == 0


def test_filters_do_not_travel_with_every_digest(spark, tmp_path, monkeypatch):
    """Of two runs, the larger one moved each bucket's filter beside each of its rows: bytes that grew as the square of the rows."""
    seen, asked = f"{tmp_path}/seen", digests._asked

    def counting(batches):
        def counted():
            for batch in batches:
                with open(seen, "a") as f:
                    f.write(f"{sum(len(b) for c in batch.columns for b in batch[c] if isinstance(b, bytes))} {sum(len(x) for c in batch.columns for b in batch[c] if isinstance(b, np.ndarray) for x in b if isinstance(x, bytes))}\n")
                yield batch

        return asked(counted())

    monkeypatch.setattr(digests, "_asked", counting)
    store = DigestStore(spark, f"{tmp_path}/store")
    rows_ = spark.range(30_000).selectExpr("cast(id as string) as k", "id % 3 as v")
    assert store.unseen(rows_.union(rows_), ["k", "v"], 0).count() == 30_000
    again = spark.range(20_000, 50_000).selectExpr("cast(id as string) as k", "id % 3 as v")
    assert store.unseen(again.union(again), ["k", "v"], 1).count() == 20_000
    moved = sum(int(x) for line in open(seen) for x in line.split())
    assert 0 < moved < 30_000 * digests.BITS // 8 + 256 * 8


# sinks


def test_text_partitions_that_look_like_numbers(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = lambda *data: spark.createDataFrame(list(data), "p string, k long, v string")
    sinks.merge(frame(("0012", 1, "a"), ("0012", 2, "b"), (None, 3, "n")), path, ["p", "k"], ("p",))
    sinks.merge(frame(("0012", 1, "new"), ("0012", 1, "again")), path, ["p", "k"], ("p",))
    assert sorted(n for n in os.listdir(path) if n.startswith("p=")) == ["p=0012", "p=__HIVE_DEFAULT_PARTITION__"]
    expected = [("0012", 1, "new"), ("0012", 2, "b"), (None, 3, "n")]
    read = lambda: rows(spark.read.schema("p string, k long, v string").parquet(path).select("p", "k", "v"))
    assert read() == expected
    sinks.compact(spark, path)
    assert read() == expected and "p=0012" in os.listdir(path)
    sinks.keep_latest(frame(("0012", 2, "c")), path, ["p", "k"], ["v"], ("p",))
    assert ("0012", 2, "c") in read() and len(read()) == 3


def test_repeats_in_a_merged_batch(spark, tmp_path):
    frame = lambda *data: spark.createDataFrame(list(data), "k long, v string")
    sinks.merge(frame((1, "a"), (1, "b")), f"{tmp_path}/t", ["k"])
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, "b")]
    sinks.merge(frame((1, "c"), (1, "d"), (2, "e")), f"{tmp_path}/t", ["k"])
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, "d"), (2, "e")]


# null keys


def test_differences_with_null_and_repeated_keys(spark):
    frame = lambda *data: spark.createDataFrame(list(data), "k long, v string, w double")
    a = frame((1, "a", 1.0), (None, "n", None), (2, "x", 0.0), (2, "x", 0.0), (2, "y", 1.0), (3, None, 1.0))
    assert quality.difference(a, a, ["k"]).verdict() == "match"
    assert quality.difference(a, a.orderBy(F.desc("v")), ["k"]).verdict() == "match"
    b = frame((1, "a", 1.0), (None, "m", None), (2, "x", 0.0), (2, "z", 1.0), (4, None, 1.0))
    found = quality.difference(a, b, ["k"])
    assert rows(found.rows) == [(2, "changed"), (2, "removed"), (3, "removed"), (4, "added"), (None, "changed")]
    assert {r["column"]: r["n_differing"] for r in found.columns.collect()}["v"] == 2


def test_differences_are_found_at_any_size_of_ranges(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice(["a", "b", None])) for i in range(3000)]
    other = [(i, v if i % 500 else "changed") for i, v in data if i != 1234] + [(9999, "a")]
    a, b = (spark.createDataFrame(x, "k long, v string") for x in (data, other))
    expected = sorted([(i, "changed") for i in range(0, 3000, 500)] + [(1234, "removed"), (9999, "added")])
    for ranges in ((), (4,), (16, 256)):
        assert sorted(map(tuple, quality.difference(a, b, ["k"], ranges).rows.collect())) == expected


def test_equal_relations_shuffle_no_rows(spark, tmp_path):
    spark.range(20_000).selectExpr("id as k", "cast(id as string) as v").write.parquet(f"{tmp_path}/t")
    a, b = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/t")
    before = shuffled(spark)
    assert quality.difference(a, b, ["k"]).rows.collect() == []
    # two levels of digests, a row a task and range; the rows themselves would be several times as much
    assert shuffled(spark) - before < 300_000
    before = shuffled(spark)
    assert quality.difference(a, b, ["k"], ()).rows.collect() == []
    assert shuffled(spark) - before > 600_000


def shuffled(spark):
    summaries = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(summaries.apply(i).totalShuffleWrite() for i in range(summaries.size()))


def test_a_null_group_has_its_sums(spark):
    events = spark.createDataFrame([(None, 1, 5), (None, 3, 7), ("a", 2, 1)], "g string, at int, v int")
    spine = spark.createDataFrame([(2,), (4,)], "until int")
    found = joins.cumulative(events, spine, "at", "until", ["g"], {"n": F.lit(1), "s": F.col("v")})
    assert rows(found) == [("a", 2, 0, 0), ("a", 4, 1, 1), (None, 2, 1, 5), (None, 4, 2, 12)]


@pytest.mark.parametrize("spans", [None, "day"])
def test_null_keys_have_no_state_and_ties_are_settled(spark, spans):
    moment = lambda d, h=0: f"2024-01-{d:02d} {h:02d}:00:00"
    events = spark.createDataFrame([(1, None, moment(5)), (2, "a", moment(5)), (3, "a", moment(9))], "i int, k string, t string").selectExpr("i", "k", "cast(t as timestamp_ntz) as at")
    states = spark.createDataFrame([(None, moment(1), 1), ("a", moment(1), 2), ("a", moment(1), 9), ("a", moment(1), None), ("a", moment(1), 4)], "k string, t string, v int").selectExpr("k", "cast(t as timestamp_ntz) as since", "v")
    found = joins.as_of(events, states, ["k"], "at", "since", ["v"], spans=spans)
    assert rows(found.select("i", "v")) == [(1, None), (2, 9), (3, 9)]


def test_like_at_either_end_at_any_place(spark):
    titles = ["Circuits and Electronics", "MITx: Circuits and Electronics", "Circuits", "electronics", None, "", "100%_x", "abc100%_x", "CircuitsCircuits"]
    left = spark.createDataFrame(list(enumerate(titles)), "i int, title string")
    parts = ["Circuits", "Electronics", "%", "100%_x", None, "ics", ""]
    right = spark.createDataFrame(list(enumerate(parts)), "j int, part string")
    for prefix, suffix in (("part", "part"), ("part", None), (None, "part")):
        found = joins.like_either(left, right, "title", prefix, suffix, ["i"], ["j"])
        expected = {(i, j) for i, t in enumerate(titles) for j, p in enumerate(parts) if t is not None and p is not None and ((prefix and t.startswith(p)) or (suffix and t.endswith(p)))}
        assert {(r["i"], r["j"]) for r in found.collect()} == expected and found.count() == len(expected)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and plan.count("BroadcastNestedLoopJoin") <= 2 * 2
