from __future__ import annotations

import hashlib
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import json_text
from lakeloom.sources import courses, extracts, feeds, files, sinks
from lakeloom.streaming import ingest


def test_tsv_keeps_rows_around_a_ragged_one(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b'id\tbio\n1\tplain\n2\ta\tb\tc\n3\t"said ""x"""\n4\twith\rreturn\n')
    rows = files.read_tsv(spark, str(tmp_path / "a.tsv"), ["id", "bio"]).collect()
    assert {r["id"]: r["bio"] for r in rows} == {"1": "plain", "3": 'said "x"', "4": "with\rreturn"}


def test_row_hash_and_origin(spark):
    df = files.with_origin(spark.createDataFrame([("a", None), ("a", "")], "x string, y string"), course="c")
    assert df.columns == ["x", "y", "extracted_course", "row_hash"]
    assert df.select("row_hash").distinct().count() == 1


def test_tracking_log(spark, tmp_path):
    lines = [{"context": json.dumps({"course_id": "x"}), "time": 1714558830, "event": {"a": 1}}, {"context": {"b": 2}, "time": "2024-05-01T10:20:30"}]
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, lines)) + "\nbroken\n")
    raw = files.read_json_lines(spark, str(tmp_path / "l.json"), ["context", "event", "time"])
    rows = files.normalised_log(raw).orderBy("context").collect()
    assert [r["time"] for r in rows] == ["2024-05-01T10:20:30.000Z"] * 2
    assert {r["context"] for r in rows} == {'{"course_id": "x"}', '{"b":2}'}


def test_course_tree(spark):
    tree = {
        "c": {"category": "course", "children": ["s2", "s1", "gone"], "metadata": {"display_name": "C"}},
        "s1": {"category": "chapter", "children": ["p"]},
        "s2": {"category": "chapter", "children": []},
        "p": {"category": "problem"},
        "stray": {"category": "problem"},
    }
    rows = courses.unnested_structures(spark.createDataFrame([("x", json.dumps(tree)), ("y", "broken"), ("z", None), ("w", "{}")], "course_id string, structure string")).orderBy("block_index").collect()
    assert [(r["block_id"], r["block_index"], r["block_parent"]) for r in rows] == [("stray", 0, None), ("c", 1, None), ("s2", 2, "c"), ("s1", 3, "c"), ("p", 4, "s1")]
    assert {(r["course_title"], r["retrieved_at"]) for r in rows} == {("C", None)}
    flat = spark.createDataFrame([('{"a": {"b": 1, "c": "x"}}',), ("no",)], "j string").select(courses.flattened_json("j")).collect()
    assert flat[0][0] == {"a__b": "1", "a__c": "x"} and flat[1][0] is None


def test_course_archive(spark, tmp_path):
    def tar(name, members):
        with tarfile.open(tmp_path / name, "w") as t:
            for path, text in members.items():
                info = tarfile.TarInfo(path)
                info.size = len(text)
                t.addfile(info, io.BytesIO(text.encode()))

    tar("good.tar", {"r/course.xml": '<course url_name="run" org="o" course="k"/>', "r/video/v.xml": '<video display_name="V"/>', "r/static/s.xml": "<x/>", "r/video/n.txt": "", "r/problem/bad.xml": "<"})
    rows = courses.read_course_archives(spark, str(tmp_path / "good.tar")).collect()
    assert [(r["course"], r["block_type"], r["block_id"], r["display_name"]) for r in rows] == [("course-v1:o+k+run", "video", "v", "V")]
    policy = {"course/run": {"tags": ["x"], "self_paced": True, "certificates": {"certificates": [{"id": 7, "signatories": [{"name": "N", "n": 1}]}]}}, "chapter/c": {}}
    tar("full.tar", {
        "r/course.xml": '<course url_name="run" org="o" course="k"/>',
        "r/course/run.xml": '<course display_name="Title" start="2024-01-01" self_paced="true"/>',
        "r/policies/run/policy.json": json.dumps(policy),
        "r/policies/other/policy.json": json.dumps(policy),
        "r/video/v.xml": '<video url_name="vv" edx_video_id="e1"><video_asset duration="12.5"/></video>',
        "r/problem/p.xml": '<problem max_attempts="3" weight="2"/>',
        "r/static/b.png": "bb",
        "r/static/a.txt": "a",
    })
    full = str(tmp_path / "full.tar")
    blocks = {r["block_id"]: r for r in courses.read_course_archives(spark, full).where("block_type <> 'course'").collect()}
    assert (blocks["vv"]["edx_video_id"], blocks["vv"]["duration"], blocks["vv"]["xml_path"], blocks["vv"]["attributes"]["url_name"]) == ("e1", "12.5", "video/v.xml", "vv")
    assert (blocks["p"]["max_attempts"], blocks["p"]["weight"], blocks["p"]["duration"]) == ("3", "2", None)
    about = courses.read_course_metadata(spark, full).first()
    assert (about["course"], about["org"], about["title"], about["start"], about["end"], about["self_paced"]) == ("course-v1:o+k+run", "o", "Title", "2024-01-01", None, True)
    assert [(r["tags"], r["tabs"], r["self_paced"]) for r in courses.read_policies(spark, full).collect()] == [('["x"]', "[]", True)]
    assert [(r["certificate_id"], r["fields"]) for r in courses.read_signatories(spark, full).collect()] == [("7", {"name": "N", "n": "1"})]
    bundle = courses.read_asset_bundles(spark, full).first()
    assert bundle["data_version"] == hashlib.sha256(b"abb").hexdigest() and [(f["path"], f["size_bytes"]) for f in bundle["files"]] == [("static/a.txt", 1), ("static/b.png", 2)]
    tar("bad.tar", {"r/video/v.xml": "<video/>"})
    with pytest.raises(Exception, match=r"course\.xml"):
        courses.read_course_archives(spark, str(tmp_path / "bad.tar")).collect()


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.replace(spark.range(100), path) == 100
    with pytest.raises(sinks.TruncationError):
        sinks.replace(spark.range(10), path)
    sinks.merge(spark.range(95, 105), path, ["id"])
    assert spark.read.parquet(path).count() == 105
    assert sinks.compact(spark, path) == 1
    df = spark.read.parquet(path)
    assert sinks.data_version(df) == sinks.data_version(df.orderBy(F.desc("id"))) != sinks.data_version(df.limit(5))
    sinks.export_csv(df.withColumn("org", F.col("id") % 3), str(tmp_path / "csv"), "org")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 105


def test_a_merge_rewrites_its_own_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "day string, id long, v string")
    sinks.merge(rows(("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")), path, ["day", "id"], by=("day",))
    before = {f.name for f in (tmp_path / "t" / "day=b").glob("*.parquet")}
    sinks.merge(rows(("a", 2, "y"), ("a", 3, "y")), path, ["day", "id"], by=("day",))
    found = sorted(tuple(r) for r in spark.read.parquet(path).select("day", "id", "v").collect())
    assert found == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b", 1, "x")]
    assert {f.name for f in (tmp_path / "t" / "day=b").glob("*.parquet")} == before
    sinks.keep_latest(rows(("b", 1, "z")), path, ["day", "id"], ["v"], by=("day",))
    assert spark.read.parquet(path).where("day = 'b'").first()["v"] == "z" and spark.read.parquet(path).count() == 4
    assert sinks.compact(spark, path) == 2 and sinks.partition_columns(spark, path) == ["day"]
    assert spark.read.parquet(path).count() == 4


def test_a_swap_that_was_broken_off_is_finished(spark, tmp_path):
    path = tmp_path / "t"
    sinks.replace(spark.range(10), str(path))
    path.rename(tmp_path / "t.old")
    spark.range(12).write.parquet(str(tmp_path / "t.new"))
    assert sinks.settled(spark, str(path)) and spark.read.parquet(str(path)).count() == 12
    assert not sinks.settled(spark, str(tmp_path / "none"))


def test_json_export_and_statistics(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "id long, org string, v double")
    sinks.export_json(df, str(tmp_path / "j"), "org")
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "j")).select("id", "v").collect())) == [(1, None), (2, 2.5)]
    spark.sql("drop table if exists analysed_here")
    df.write.option("path", str(tmp_path / "a")).saveAsTable("analysed_here")
    sinks.analysed(spark, "analysed_here")
    assert any("2 rows" in str(r[1]) for r in spark.sql("describe extended analysed_here").collect() if r[0] == "Statistics")
    spark.sql("drop table analysed_here")


def test_feeds(spark):
    ns = 'xmlns:itunes="http://www.itunes.com/dtds/podcast-1.0.dtd"'
    xml = f"""<rss {ns}><channel><title>T</title><language>en</language><itunes:image href="http://i/c.png"/>
        <item><title>one</title><guid>g1</guid><enclosure url="http://a/1.mp3"/><itunes:duration>10:00</itunes:duration></item>
        <item><title>no audio</title></item>
        <item><title>two</title><link>https://l/two</link><enclosure url="http://a/2.mp3"/><itunes:image href="http://i/2.png"/></item></channel></rss>"""
    df = spark.createDataFrame([("https://host/feed/", xml), ("https://bad", "<rss"), ("https://none", None)], "rss_url string, xml string")
    channel = feeds.channels(df).collect()
    assert [(r["readable_id"], r["title"], r["language"], r["image_url"]) for r in channel] == [("host/feed", "T", "en", "http://i/c.png")]
    found = feeds.episodes(df).collect()
    assert [(r["readable_id"], r["url"], r["duration"], r["image_url"]) for r in found] == [("g1", "http://a/1.mp3", "10:00", "http://i/c.png"), ("l/two", "https://l/two", None, "http://i/2.png")]
    assert {r["channel_readable_id"] for r in found} == {"host/feed"}


def test_damaged_contexts_are_repaired(spark):
    rows = [('{"a": 1}', '{"a": 1}'), ('"{\\"a\\": 1}"', '{"a": 1}'), ('"{"a": 1}"', '{"a": 1}'), ('{\\"a\\": 1}', '{"a": 1}'), ("plain", "plain"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "t string, expected string")
    assert [r[0] for r in df.select(json_text.is_json_object("t")).collect()] == [True, False, False, False, False, False, False]
    assert df.where(~json_text.repaired("t").eqNullSafe(F.col("expected"))).collect() == []


def test_streams(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    for part in (events.where("event_id % 2 = 0"), events):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = lambda: ingest.file_stream(spark, source, events.schema, files_per_trigger=1)
    ingest.merge_into(stream(), table, ["user_id"], ["ts", "event_id"], str(tmp_path / "c1")).awaitTermination()
    newest = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("n")).select("user_id", "n.event_id")
    assert spark.read.parquet(table).select("user_id", "event_id").exceptAll(newest).isEmpty()
    assert spark.read.parquet(table).count() == newest.count()
    once = ingest.without_repeats(stream(), ["event_id"], "ts", "60 days")
    ingest.append_to(once, str(tmp_path / "once"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "once")).count() == events.count()


def test_tsv_files_are_rewritten(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text('id\tbio\n1\t"say ""hi"", you"\n')
    (tmp_path / "in" / "b.tsv").write_text("id\tbio\n")
    assert files.rewritten_tsv(spark, str(tmp_path / "in"), ["id", "bio"], str(tmp_path / "out"), course="c") == 1
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).first()
    assert (row["bio"], row["extracted_course"], row["row_hash"]) == ('say "hi", you', "c", hashlib.sha256(b'1say "hi", you').hexdigest())


def test_a_database_is_read_in_parts(spark):
    url = "jdbc:derby:memory:lakeloom;create=true"
    rows = spark.range(100).selectExpr("id", "concat('n', id) as name", "'secret' as password")
    rows.write.format("jdbc").options(url=url, dbtable="people", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").mode("overwrite").save()
    found = files.read_database(spark, url, "people", key="id", cursor="id", since=89, excluded=["password"], partitions=4, bounds=(0, 100), driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert found.columns == ["id", "name"] and found.rdd.getNumPartitions() == 4 and found.count() == 10
    assert "GreaterThan(id,89)" in found._jdf.queryExecution().executedPlan().toString().replace("ID", "id")


def test_buckets_save_a_shuffle(spark, tmp_path):
    spark.sql("drop table if exists bucketed_here")
    sinks.bucketed(spark.range(100).selectExpr("id", "id % 7 as k"), "bucketed_here", ["k"], 4)
    plan = spark.table("bucketed_here").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("drop table bucketed_here")


def test_extracts(spark):
    users = spark.createDataFrame([(1, "u1"), (2, "u2")], "id int, username string").selectExpr("*", *[f"'x' as {c}" for c in ("first_name", "last_name", "email", "password")], *[f"true as {c}" for c in ("is_staff", "is_active", "is_superuser")], *[f"date'2024-01-01' as {c}" for c in ("last_login", "date_joined")])
    enrolments = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 1, "b")], "id int, user_id int, course_id string").selectExpr("*", "date'2024-01-01' as created", "true as is_active", "'audit' as mode")
    found = extracts.enrolled_users(users, enrolments, ["b"])
    assert sorted((r["id"], r["course_id"]) for r in found.collect()) == [(1, "b"), (2, "b")] and "password" not in found.columns
    assert extracts.enrolments_of(enrolments, ["a", "b"]).count() == 3
    access = spark.createDataFrame([(1, 1, "o", "a", "staff")], "id int, user_id int, org string, course_id string, role string")
    assert extracts.roles(access, ["a"]).count() == 1 and extracts.roles(access, ["b"]).count() == 0
