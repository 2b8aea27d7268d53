"""Every operator and stage on tables with the awkward cases, without rows, and with columns whose names clash."""

from __future__ import annotations

import hashlib

import pytest
from helpers import awkward, with_clashes
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import decontaminate, mixing, neardup, pii, quality, secrets, suffixes, toxicity, warc, winnow


def benchmark(spark):
    return spark.createDataFrame([(1, "some benchmark question that is long enough to count as one"), (2, None), (None, "x"), (3, "")], "item_id long, text string")


def labels(spark):
    rows = spark.createDataFrame([(6, 1, 0), (4, 0, 1), (7, 1, None), (None, 1, 1), (8, None, 0)], "doc_id long, quality int, toxic int")
    return rows.select("*", F.lit("clash").alias("DOC_ID"), F.lit("clash").alias("score"))


OPERATORS = {
    "mixing": lambda s, d: mixing.mixed(d),
    "secrets": lambda s, d: secrets.findings(d),
    "pii": lambda s, d: pii.personal_data(d),
    "suffixes": lambda s, d: suffixes.repeated_passages(d),
    "quality": lambda s, d: quality.quality_scores(d, labels(s)),
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, labels(s)),
    "winnow": lambda s, d: winnow.fingerprints(d),
    "neardup": lambda s, d: neardup.near_duplicates(d),
    "decontaminate": lambda s, d: decontaminate.contaminated(d, benchmark(s)),
}


@pytest.fixture(scope="module")
def rows(spark):
    """What each operator gives on the awkward table, by name and then by id."""
    table, found = with_clashes(awkward(spark)), {}

    def of(name):
        if name not in found:
            found[name] = {}
            for r in OPERATORS[name](spark, table).collect():
                found[name].setdefault(r["doc_id"], []).append(r)
        return found[name]

    return of


IDS = {None, 1, 2, 3, 4, 5, 6, 7, 8}
#: Words by id; one row of each but for 6.
SIZES = {None: 11, 1: 0, 2: 0, 3: 0, 4: 40_000, 5: 1, 6: 20, 7: 4, 8: 1}


def whole(found):
    """A row for each row, equal ones for rows alike."""
    assert found.keys() == IDS and all(len(v) == (2 if i == 6 else 1) for i, v in found.items())
    return {i: v[0] for i, v in found.items()}


def test_mixing(rows):
    found = rows("mixing")
    one = whole(found)
    assert {i: r["size"] for i, r in one.items()} == SIZES
    # a document of a null source is of one with the other such
    assert {i: r["source_size"] for i, r in one.items()} == {1: 1, 5: 1, 2: 0} | dict.fromkeys([None, 3, 4, 6, 7, 8], 40_000 + 11 + 2 * 20 + 4 + 1)
    assert all(0 <= r["taken"] <= 2 * r["size"] for v in found.values() for r in v)
    assert abs(sum(r["taken"] for v in found.values() for r in v) - 1.5 * (40_056 + 1)) < 64


def test_pii(rows):
    one = whole(rows("pii"))
    assert {(r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["spans"], r["base_sha256"]) for r in one.values()} == {(0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_near_duplicates(rows):
    found = rows("neardup")
    one = whole(found)
    assert {i: r["n_shingles"] for i, r in one.items()} == {None: 7, 1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 4, 7: 1, 8: 1}
    assert {i: r["component_id"] for i, r in one.items()} == {i: i for i in IDS}
    assert all(r["kept"] for v in found.values() for r in v)


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_classifiers(rows, name):
    found = rows(name)
    one = whole(found)
    assert found[6][0] == found[6][1] and one[None]["held_out"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= (0.3 if name == "quality" else 0.5)) for r in one.values())
    # null, empty: the same score
    assert one[1]["score"] == one[2]["score"]


def test_winnowing(rows):
    found = rows("winnow")
    one = whole(found)
    assert found[6][0] == found[6][1]
    assert {i: r["n_chars"] for i, r in one.items() if i not in (7,)} == {None: 48, 1: 0, 2: 0, 3: 4, 4: 200_000, 5: 100_000, 6: 110, 8: 1}
    assert one[1]["fingerprint"] == one[2]["fingerprint"] == one[3]["fingerprint"] == ""
    assert one[1]["near_edited"] == 1.0 and one[1]["edited_sha256"] == hashlib.sha256(b"").hexdigest()


def test_nothing_to_find(rows):
    assert rows("secrets") == {} and rows("decontaminate") == {}


def test_repeated_passages(rows):
    # a long text that repeats itself; nothing of another document
    assert set(rows("suffixes")) <= {4, 6}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty(spark, name):
    assert OPERATORS[name](spark, awkward(spark).limit(0)).collect() == []


def test_benchmark_without_items(spark):
    empty = benchmark(spark).limit(0)
    assert decontaminate.contaminated(awkward(spark), empty).collect() == []
    assert decontaminate.without_benchmark(awkward(spark), empty).count() == 10


def pages(spark):
    rows = [(1, None, None), (None, "http://n", "no id"), (2, "", ""), (3, "http://l", "é<p>" * 300_000), (4, "http://l", "é<p>" * 300_000), (5, "http://s", "small"), (5, "http://s", "small"), (None, None, "é<p>" * 300_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.select("*", *[F.lit("clash").alias(n) for n in ("digest", "of", "newest", "HTML", "refers_to", "frame")])


def test_warc(spark):
    found = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archived(pages(spark)).collect())
    long = 300_000 * 5
    expected = [("1", 0, "response", None), ("2", 0, "response", None), ("3", long, "revisit", 4), ("4", long, "response", None), ("5", 5, "response", None), ("5", 5, "response", None), ("None", 5, "response", None), ("None", long, "response", None)]
    assert found == expected
    assert warc.archived(pages(spark).limit(0)).collect() == []


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with the two tables that stages read."""
    folder = str(tmp_path_factory.mktemp("tables"))
    labels(spark).toDF("doc_id", "quality", "toxic", "clash", "score").write.parquet(f"{folder}/labels.parquet")
    benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, tables, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = awkward(spark)
    clean = sorted(str(r["doc_id"]) for r in docs.collect())
    found = [r["doc_id"] for r in stage(spark, with_clashes(docs), tables).collect()]
    if name == "near-duplicates":
        # rows alike in id and text are one
        clean.remove("6")
    if name == "toxicity":
        # the only text labelled toxic may go
        clean = [i for i in clean if i != "4"]
        found = [i for i in found if i != 4]
    assert sorted(map(str, found)) == clean
    if name != "mixing":
        assert stage(spark, with_clashes(docs), tables).columns == docs.columns
    again = docs.union(docs.where("doc_id = 6").withColumn("text", F.lit("other words")))
    assert sorted(str(r["doc_id"]) for r in stage(spark, again, tables).collect()).count("6") == (2 if name == "near-duplicates" else 4)
