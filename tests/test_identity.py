from __future__ import annotations

import hashlib

from lakeloom.operators import identity
from lakeloom.sources import feeds

RANKS = {"a": 1, "b": 2, "t": 3}


def elections(spark, rows):
    df = spark.createDataFrame(rows, "email string, source string, account string, global_id string")
    found = identity.elected(df, "email", "source", "account", RANKS, "global_id", ("t",)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = None if r["identity_id"] is None else hashlib.md5(f"{r['identity_source']}-{r['identity_id']}".encode()).hexdigest()
        assert r["user_key"] == text
    return {(r["email"], r["source"], r["account"]): (r["identity_source"], r["identity_id"]) for r in found}


def test_ids_before_ranks_and_global_ids_before_all(spark):
    found = elections(spark, [("x", "a", None, None), ("x", "t", "9", None), ("y", "a", "5", None), ("y", "b", "1", "g1"), ("y", "b", "2", "g0")])
    # an account without id loses to one of a lower system
    assert found["x", "a", None] == ("t", "9")
    # equal rank 0 is settled by the greater global id
    assert {v for k, v in found.items() if k[0] == "y"} == {("global", "g1")}


def test_numbers_and_texts(spark):
    found = elections(spark, [("x", "a", "9", None), ("x", "a", "10", None), ("y", "t", "9", None), ("y", "t", "10", None), ("z", "a", "n1", None), ("z", "a", "1", None)])
    assert found["x", "a", "9"] == ("a", "10") and found["y", "t", "10"] == ("t", "9") and found["z", "a", "n1"] == ("a", "1")


def test_without_ids_or_addresses(spark):
    rows = [("x", "a", None, None), (None, "a", "1", None), (None, "b", "1", None), (None, "a", None, "g"), (None, "a", None, None), (None, None, None, None), ("u", "other", "1", None), ("u", "t", "0", None)]
    found = elections(spark, rows)
    assert found["x", "a", None] == ("email", "x")
    assert (found[None, "a", "1"], found[None, "b", "1"]) == (("a", "1"), ("b", "1"))
    assert found[None, None, None] == (None, None)
    # a system without a rank comes last
    assert found["u", "other", "1"] == ("t", "0")


def test_repeats_and_empty_tables(spark):
    assert elections(spark, [("x", "a", "1", None)] * 3) == {("x", "a", "1"): ("a", "1")}
    df = spark.createDataFrame([], "email string, source string, account string, global_id string")
    assert identity.elected(df, "email", "source", "account", RANKS, "global_id").collect() == []


def test_lines_of_others_go_before_they_are_joined_and_own_ones_are_looked_for_once(spark):
    enrolments = spark.createDataFrame(
        [(1, 0, 5, 1, 1, 10), (2, 1, 5, 1, 1, None), (3, 0, 5, 1, 1, None), (4, 1, 6, 2, 1, 99), (None, 1, 5, 1, 1, None)],
        "enrolment long, platform long, person long, run long, program long, order_id long",
    )
    items = spark.createDataFrame([(10, 1, 0, 7), (11, 1, 1, 8), (12, 1, 1, 9), (13, 1, 1, 8)], "order_id long, line_id int, platform long, product long")
    orders = spark.createDataFrame([(10, 5, 1), (11, 5, 1), (12, 5, 2), (13, 4, 9)], "id long, person long, updated int")
    lines = items.join(orders, items.order_id == orders.id).drop("id")
    products = spark.createDataFrame([(7, 0, 3, 3), (8, 1, 1, None), (9, 1, None, 1)], "product long, platform long, run long, program long")
    found = identity.enrolment_orders(enrolments, lines, products, [0])
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, 10, 1, False), (2, 11, 1, True), (None, 11, 1, True)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and plan.count("LeftSemi") == 2


def test_configured_feeds(spark):
    xml = "<rss><channel><title>T</title></channel></rss>"
    urls = ["https://a", "https://b", "https://c", "https://d"]
    channels = feeds.channels(spark.createDataFrame([(u, xml) for u in urls], "rss_url string, xml string"))
    rows = [("https://a", "w", "Own", "maths"), ("https://b", "w", "", None), ("https://b", "v", "Less", None), ("https://c", None, "Not counted", "x"), (None, "w", "y", "z")]
    found = feeds.configured(channels, spark.createDataFrame(rows, "rss_url string, website string, podcast_title string, topics string"))
    assert found.columns == [*channels.columns, *feeds.CONFIGURED]
    assert sorted((r["rss_url"], r["title"], r["website"], r["topics"], r["offered_by"]) for r in found.collect()) == [
        ("https://a", "Own", "w", "maths", None), ("https://b", "T", "w", None, None), ("https://c", "T", None, None, None), ("https://d", "T", None, None, None),
    ]
