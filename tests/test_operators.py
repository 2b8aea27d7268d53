from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import conversations, dedup, hierarchy, identity, incremental, joins, quality, reports
from lakeloom.plans import registry


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_places_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c"), (None, 1, "d")], "k int, at int, v string")
    assert got(dedup.latest(df, ["k"], "at")) == got(dedup.latest_by_state(df, ["k"], "at")) == [(1, 5, "b"), (2, None, "c"), (None, 1, "d")]
    assert got(dedup.distinct_by(df, ["k", "missing"])) == got(df)


def test_delete_insert_and_new_columns(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(None, "B", 1), (4, "d", 2)], "k int, v string, w int")
    assert got(incremental.delete_insert(old, new, ["k"])) == [(1, "a", None), (3, "c", None), (4, "d", 2), (None, "B", 1)]


def test_empty_target_means_all(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "k int, at int")
    assert incremental.after_watermark(df, df.limit(0), "at").count() == 2
    assert got(incremental.after_watermark(df, df.where("k = 1"), "at", inclusive=True)) == [(1, 10), (2, 20)]
    assert got(incremental.after_watermark(df, df.where("k = 1"), "at", by=["k"])) == [(2, 20)]


def test_scd2_of_equal_rows_is_empty(spark):
    now = F.expr("timestamp_ntz'2024-02-01'")
    rows = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    live = rows.select("*", F.expr("timestamp_ntz'2024-01-01'").alias("effective_date"), F.lit(None).cast("timestamp_ntz").alias("end_date"), F.lit(True).alias("is_current"))
    assert incremental.scd2(rows, live, ["k"], ["v"], now).isEmpty()
    changed = incremental.scd2(rows.withColumn("v", F.lit("y")), live, ["k"], ["v"], now)
    assert sorted((r["k"], r["is_current"]) for r in changed.collect()) == [(1, False), (1, True), (2, False), (2, True)]


def test_disjunctive_outer(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "y"), (3, "q", "q")], "i int, p string, r string")
    b = spark.createDataFrame([(7, "x", "y"), (8, "x", "z")], "j int, s string, t string")
    found = joins.disjunctive(a, b, [("p", "s"), ("r", "t")], ["i"], ["j"], outer=True)
    assert sorted((r["i"], r["j"]) for r in found.where("j is not null").collect()) == [(1, 7), (1, 8), (2, 7)]
    assert [r["i"] for r in found.where("j is null").collect()] == [3]


def test_disjunctive_keeps_repeated_rows_and_does_not_move_what_it_found(spark):
    a = spark.createDataFrame([(1, "x", "y"), (1, "x", "y"), (2, None, None)], "i int, p string, r string")
    b = spark.createDataFrame([(7, "x", "y"), (8, "z", "y")], "j int, s string, t string")
    pairs = [("p", "s"), ("r", "t")]
    found = joins.disjunctive(a, b, pairs, outer=True)
    assert sorted((r["i"], r["j"] or 0) for r in found.collect()) == [(1, 7), (1, 7), (1, 8), (1, 8), (2, 0)]
    plan = joins.disjunctive(a, b.hint("broadcast"), pairs)._jdf.queryExecution().executedPlan().toString()
    # the join's output goes on to no shuffle and no aggregate
    assert "Aggregate" not in plan and plan.index("Union") < plan.index("Exchange")


@pytest.mark.parametrize("together", [1, 5, 4096])
def test_disjunctive_in_blocks_finds_what_the_join_finds(spark, monkeypatch, together):
    for name, rows in (("TOGETHER", together), ("CELL", 2), ("BLOCK", 3)):
        monkeypatch.setattr(joins, name, rows)
    keys = [0.0, -0.0, float("nan"), None, 1.0]
    a = spark.createDataFrame([(i % 30, keys[i % 5] if i % 3 else 2.0) for i in range(40)], "i int, p double")
    b = spark.createDataFrame([(j % 17, [2.0, *keys][j % 6]) for j in range(25)], "j int, q double")
    pairs = [("i", "j"), ("p", "q")]
    for left, right in ((a, b), (a.limit(0), b), (a, b.where("q is null")), (a.where("p is null"), b)):
        plain, blocked = (got(joins.disjunctive(left, right, pairs, outer=True, coarse=coarse).selectExpr("i", "cast(p as string)", "j", "cast(q as string)")) for coarse in ([], pairs[1:]))
        assert plain == blocked
    with pytest.raises(ValueError):
        joins.disjunctive(a, b.withColumn("q", F.col("q").cast("string")), pairs, coarse=pairs[1:])


def test_disjunctive_join_writes_small_files(spark, tmp_path):
    """200 of many customers and 20,000 suppliers of one nation: over a byte a row if suppliers come round once in 20,000 rows."""
    customers = spark.range(60_000).selectExpr("id as c_custkey", "format_string('Customer#%09d', id) as c_name", "if(id < 200, 7, 8) as c_nationkey")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(100, 20_100).selectExpr("id as s_suppkey", "7 as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    registry.QUERIES["disjunctive_join"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    found, rows = spark.read.parquet(f"{tmp_path}/out"), 200 * 20_000 + 19_900
    assert found.count() == found.distinct().count() == rows
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < rows / 2


def test_not_in_with_null(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "x int"), spark.createDataFrame([(1,), (None,)], "y int")
    assert joins.nulls_first_anti(a, b, "x", "y").isEmpty()
    assert got(joins.nulls_first_anti(a, b.where("y = 1"), "x", "y")) == [(2,)]
    assert joins.nulls_first_anti(a, b.limit(0), "x", "y").count() == 3


def test_as_of_takes_equal_times(spark):
    events = spark.createDataFrame([(1, 5), (1, 2), (2, 9)], "k int, at int")
    states = spark.createDataFrame([(1, 5, "five"), (1, 3, "three")], "k int, since int, v string")
    assert got(joins.as_of(events, states, ["k"], "at", "since", ["v"])) == [(1, 2, None), (1, 5, "five"), (2, 9, None)]


def test_hierarchy_level_above_ends_level_below(spark):
    rows = [(1, "chapter"), (2, "sequential"), (3, "problem"), (4, "chapter"), (5, "problem")]
    df = spark.createDataFrame([("c", *r) for r in rows], "course string, i int, kind string")
    found = hierarchy.filled(df, ["course"], "i", "kind", "i", ["chapter", "sequential"]).orderBy("i")
    assert [(r["chapter_id"], r["sequential_id"]) for r in found.collect()] == [(1, None), (1, 2), (1, 2), (4, None), (4, None)]


def test_identity(spark):
    rows = [("a", 1, " Me@X.org"), ("b", 9, "me@x.org "), ("a", 2, None), ("b", None, None), ("a", 3, "")]
    found = identity.resolved(spark.createDataFrame(rows, "s string, i int, e string"), "e", "i", "s", {"b": 1, "a": 2})
    by = {(r["s"], r["i"]): r["user_key"] for r in found.collect()}
    assert by["a", 1] == by["b", 9] and len(set(by.values())) == 4


def test_conversations(spark):
    rows = [(1, 2, "b"), (1, 1, None), (2, 1, "c"), (2, 1, "c")]
    turns = spark.createDataFrame(rows, "c int, n int, t string")
    assert got(conversations.assembled(turns, "c", ["n"], F.col("t"), "|")) == [(1, "|b", 2), (2, "c|c", 2)]
    assert conversations.without_repeats(turns, "c", ["n"], ["t"]).count() == 3


def test_ratio_and_ladder(spark):
    df = spark.createDataFrame([(0, 0, 0), (10, 9, 9), (10, 1, 0)], "seats int, used int, done int")
    ladder = reports.health(F.col("used"), F.col("seats"), F.col("done"), [(80, 75, "good")], "bad")
    assert [r[0] for r in df.select(ladder).collect()] == ["no seats", "good", "bad"]
    assert df.select(reports.rate(F.col("used"), F.col("seats"))).first()[0] is None


def test_severity_and_verdict(spark):
    df = spark.range(20)
    assert [quality.severity(df.limit(n)) for n in (0, 3, 20)] == ["pass", "warn", "error"]
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert quality.difference(a, a, ["k"]).verdict() == "match"
    assert quality.difference(a, a.withColumn("v", F.lit("y")), ["k"]).verdict() == "mismatch"
    assert quality.difference(a, a.withColumn("w", F.lit(1)), ["k"]).verdict() == "schema_divergence"


def test_the_watermark_reaches_the_scan(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) as at", "concat('k', id % 3) as k")
    df.write.parquet(f"{tmp_path}/t")
    source = spark.read.parquet(f"{tmp_path}/t")
    for by in ([], ["k"]):
        newer = incremental.after_watermark(source, source.where("id < 900"), "at", by=by)
        plan = newer._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(at" in plan.split("PushedFilters: ")[1].splitlines()[0] and "Join" not in plan
        assert newer.count() == 100
    many = source.withColumn("k", F.col("id") % 200)
    assert incremental.after_watermark(many, many.where("id < 900"), "at", by=["k"]).count() == 100


def test_quantiles_are_exact(spark):
    import random

    import numpy as np

    rnd = random.Random(1)
    rows = [(k, rnd.choice([rnd.random(), 0.5, float(rnd.randrange(5))])) for k in ("a", "b", None) for _ in range(700)] + [("one", 3.0), ("none", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"p0": 0.0, "p10": 0.1, "p33": 1 / 3, "p50": 0.5, "p100": 1.0}
    got = {r["k"]: [r[n] for n in shares] for r in reports.quantiles(df, ["k"], "v", shares, 8).collect()}
    assert got.keys() == {"a", "b", None, "one", "none"} and got["none"] == [None] * 5
    for k in ("a", "b", None, "one"):
        assert np.allclose(got[k], np.quantile([v for x, v in rows if x == k and v is not None], list(shares.values())))
    assert np.allclose(list(reports.quantiles(df, [], "v", shares, 8).first()), np.quantile([v for _, v in rows if v is not None], list(shares.values())))


def test_a_diff_counts_every_column(spark):
    a = spark.range(3).select("id", *[F.lit(i).alias(f"c{i}") for i in range(40)])
    found = quality.difference(a, a.withColumn("c39", F.lit(0)), ["id"]).columns.collect()
    assert len(found) == 40 and {r["column"]: r["n_differing"] for r in found}["c39"] == 3


def test_a_course_under_no_requirement_stays(spark):
    operators = spark.createDataFrame([(1, "00", "all_of", None, "t")], "operator_id int, path string, rule string, least int, title string")
    courses = spark.createDataFrame([(7, 1, "0001"), (8, 1, "0101")], "course_id int, program_id int, path string")
    found = {r["course_id"]: r for r in hierarchy.requirement_tree(operators, courses, 2).collect()}
    assert (found[7]["kind"], found[7]["n_required"], found[7]["place"]) == ("Core", 1, 1)
    assert (found[8]["kind"], found[8]["requirement_id"], found[8]["place"]) == (None, None, 2)


def test_as_of_by_spans_is_the_same(spark):
    import random

    rnd = random.Random(3)
    moment = lambda: f"2024-01-{rnd.randrange(1, 20):02d} {rnd.randrange(24):02d}:00:00"
    key = lambda: rnd.choice(["hot", "hot", "hot", "b", None])
    events = spark.createDataFrame([(i, key(), moment()) for i in range(400)], "i int, k string, t string").selectExpr("i", "k", "cast(t as timestamp_ntz) as at")
    states = spark.createDataFrame(list({(k, t): (k, t, i) for i, (k, t) in enumerate((key(), moment()) for _ in range(60))}.values()), "k string, t string, v int").selectExpr("k", "cast(t as timestamp_ntz) as since", "v")
    plain, spans = (joins.as_of(events, states, ["k"], "at", "since", ["v"], spans=s) for s in (None, "day"))
    assert got(plain) == got(spans) and sum(r["v"] is not None for r in plain.collect()) > 200


def test_first_rows_are_chosen_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id")
    plan = dedup.first_row(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    # each task passes on one row of a key, so a hot key is no large group
    assert "WindowGroupLimit" in plan and "Partial" in plan
