"""Views refreshed by what has changed, against recomputation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.views import AggregateView
from lakeloom.sources.versioned import VersionedTable

SCHEMA = "id long, g string, h int, x long, y decimal(10, 2)"


@pytest.fixture
def view(spark, tmp_path):
    return AggregateView(VersionedTable(spark, f"{tmp_path}/source"), VersionedTable(spark, f"{tmp_path}/view"), ["g", "h"], {"sx": "x", "sy": "y"}, {"low": "x"}, {"high": "y"})


def expected(view):
    rows = view.source.read().groupBy("g", "h").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.min("x").alias("low"), F.max("y").alias("high"))
    return sorted(map(tuple, rows.select("g", "h", "n", F.col("sx").cast("decimal(38, 6)"), F.col("sy").cast("decimal(38, 6)"), "low", "high").collect()), key=repr)


def shown(view):
    return sorted(map(tuple, view.read().collect()), key=repr)


def batch(spark, rnd, ids):
    from decimal import Decimal

    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), rnd.choice([None, rnd.randrange(-50, 50)]), rnd.choice([None, Decimal(rnd.randrange(1000)) / 100])) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def test_any_changes_give_what_recomputation_gives(spark, view):
    rnd = random.Random(4)
    view.source.append(batch(spark, rnd, range(60)))
    view.refresh()
    assert shown(view) == expected(view)
    for step in range(3):
        view.source.upsert(batch(spark, rnd, rnd.sample(range(90), 20)), ["id"])
        view.source.delete(spark.createDataFrame([(i,) for i in rnd.sample(range(90), 10)], "id long"), ["id"])
        if step:
            view.source.compact()
        view.refresh()
        assert shown(view) == expected(view) and not view.drifted()
    assert {view.target.version(n).operation for n in view.target.versions()} == {"replace", "upsert"}


def test_groups_without_rows_go(spark, view):
    view.source.append(batch(spark, random.Random(1), range(30)))
    view.refresh()
    view.source.delete(view.source.read().where("g = 'a'").select("id"), ["id"])
    view.refresh()
    assert shown(view) == expected(view) and "a" not in {r[0] for r in shown(view)}


def test_only_touched_groups_are_written(spark, view):
    view.groups, view.sums, view.least, view.greatest = ["id"], {"sx": "x"}, {}, {}
    view.source.append(spark.range(1000).selectExpr("id", "'a' as g", "1 as h", "id as x", "cast(null as decimal(10, 2)) as y"))
    view.target.replace(view._all(0).repartitionByRange(8, "id"), ledger={"source": 0})
    before = view.target.version().files
    view.source.upsert(spark.createDataFrame([(3, "a", 1, 100, None), (2000, "a", 1, 1, None)], SCHEMA), ["id"])
    view.refresh()
    assert len(before) == 8 and len(before.keys() & view.target.version().files.keys()) == 7
    rows = {r["id"]: r["sx"] for r in view.read().collect()}
    assert len(rows) == 1001 and rows[3] == 100 and rows[2000] == 1 and rows[4] == 4


def test_nothing_new_makes_no_version(spark, view):
    view.source.append(batch(spark, random.Random(1), range(10)))
    assert view.refresh().number == view.refresh().number == 0


def test_drift_is_found_and_mended(spark, view):
    view.source.append(batch(spark, random.Random(1), range(30)))
    view.refresh()
    view.target.delete(view.target.read().limit(1).select("g", "h"), ["g", "h"])
    assert view.drifted() and shown(view) != expected(view)
    view.refresh(check=True)
    assert shown(view) == expected(view) and not view.drifted()


def test_a_version_that_is_gone_means_anew(spark, view):
    view.source.append(batch(spark, random.Random(1), range(30)))
    view.refresh()
    view.source.upsert(batch(spark, random.Random(2), range(10, 40)), ["id"])
    view.source.vacuum(1)
    view.refresh()
    assert shown(view) == expected(view) and view.target.version().operation == "replace"
