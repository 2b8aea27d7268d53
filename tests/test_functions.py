from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import codes, course_ids, iso8601, json_text, keys


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_parse_iso8601(spark):
    rows = [("2024-05-01",), ("2024-05-01T10:20:30",), ("2024-05-01T10:20:30+02:00",), ("nonsense",), (None,)]
    found = values(spark, "s string", rows, iso8601.to_iso8601(iso8601.parse_iso8601("s")))
    assert found == ["2024-05-01T00:00:00.000Z", "2024-05-01T10:20:30.000Z", "2024-05-01T08:20:30.000Z", None, None]


def test_keys_of_iso_text(spark):
    rows = [("2024-05-01T10:20:30Z",), ("2024-05-01",), ("2024-05",), ("",), (None,), ("xxxxxxxxxx",)]
    assert values(spark, "s string", rows, iso8601.date_key("s")) == [20240501, 20240501, None, None, None, None]
    assert values(spark, "s string", rows, iso8601.time_key("s")) == [1020, None, None, None, None, None]
    safe = [v and v.isoformat() for v in values(spark, "s string", rows, iso8601.safe_iso8601_date("s"))]
    assert safe == ["2024-05-01T10:20:30", "2024-05-01T00:00:00", None, None, None, None]


def test_mysql_pattern(spark):
    assert iso8601.java_pattern("%Y-%m-%dT%H:%i:%s") == "yyyy-MM-dd'T'HH:mm:ss"
    found = values(spark, "s string", [("2024-05-01T10:20:30",), ("no",)], iso8601.to_iso8601(iso8601.parsed_with("s", "%Y-%m-%dT%H:%i:%s")))
    assert found == ["2024-05-01T10:20:30.000Z", None]


def test_json(spark):
    rows = [('{"a": 1, "b": {"c": [1, 2]}}',), ("[1]",), ("x",), (None,)]
    assert values(spark, "s string", rows, json_text.json_scalar("s", "$.a")) == ["1", None, None, None]
    assert values(spark, "s string", rows, json_text.json_scalar("s", "$.b")) == [None] * 4
    assert values(spark, "s string", rows, json_text.json_string("s", "$.b.c"))[0] == "[1,2]"
    assert values(spark, "s string", rows, json_text.json_string_array("s", "$.b.c"))[0] == ["1", "2"]
    assert values(spark, "s string", rows, json_text.is_json_object("s")) == [True, False, False, False]
    df = spark.createDataFrame(rows, "s string")
    assert {(r["key"], r["value"]) for r in json_text.unnested_map(df, "s").collect()} == {("a", "1"), ("b", '{"c":[1,2]}')}
    assert [(r["n"], r["element"]) for r in json_text.unnested_array(df, "s", ordinal="n").collect()] == [(1, "1")]


def test_null_and_empty_have_other_digests(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a", None)], "a string, b string")
    assert df.select(keys.null_safe_digest("a", "b").alias("d")).distinct().count() == 3
    assert df.select(keys.slugify(F.lit(" Ab--c! ")).alias("s")).first()[0] == "ab_c"
    assert df.select(keys.surrogate_key("a", "b").alias("k")).distinct().count() == 3


def test_course_ids(spark):
    v1 = "course-v1:OrgX+6.00+1T2024"
    rows = [(v1,), ("OrgX/6.00/1T2024",)]
    assert values(spark, "s string", rows, course_ids.to_slashes("s")) == ["OrgX/6.00/1T2024"] * 2
    assert values(spark, "s string", rows, course_ids.to_v1("s")) == [v1] * 2
    assert values(spark, "s string", rows, course_ids.without_run("s")) == ["course-v1:OrgX+6.00", "OrgX/6.00"]
    assert values(spark, "s string", rows, course_ids.run_tag("s")) == ["1T2024"] * 2
    events = [('{"course_id": "%s"}' % v1, "x", "y"), ('{"course_id": ""}', f"/courses/{v1}/about", None), (None, "/courses/a/b/c/x", None), (None, "page", f"http://h/courses/{v1}/?q")]
    found = values(spark, "c string, t string, p string", events, course_ids.course_of_event("c", "t", "p"))
    assert found == [v1, v1, "a/b/c", v1]
    programs = [(4, "Data (Track One)"), (5, "Anything"), (7, "Supply chain management"), (4, "No track")]
    assert values(spark, "n int, s string", programs, course_ids.program_id("n", "s")) == ["Track One", "FIN", "SCM", None]


def test_labels(spark):
    rows = [("m", "http://x/a.PDF", None), ("zz", "http://x/b", None), (None, None, "Kept")]
    assert values(spark, "c string, u string, k string", rows, codes.label("c", codes.GENDER)) == ["Male", None, None]
    assert values(spark, "c string, u string, k string", rows, codes.resource_type("u", "k")) == ["Document", "Other", "Kept"]


def test_departments_and_sizes(spark):
    rows = [("15",), ("RES",), ("SP",), ("??",)]
    assert values(spark, "d string", rows, codes.label("d", codes.OPEN_DEPARTMENT, F.col("d"))) == ["Sloan School of Management", "Supplemental Resources", "SP", "??"]
    assert values(spark, "d string", rows, codes.label("d", codes.COURSE_DEPARTMENT)) == ["Management", None, "Special Programs", None]
    assert values(spark, "n int", [(99,), (7,)], codes.label("n", codes.COMPANY_SIZE, F.col("n").cast("string"))) == ["Small (10-99 employees)", "7"]


def test_is_current(spark):
    rows = [("2024-01-01", None), ("2024-01-01", "2024-01-31"), ("2024-03-01", None), (None, None)]
    found = values(spark, "a string, b string", rows, iso8601.is_current("a", "b", F.lit("2024-02-01")))
    assert found == [True, False, False, False]


def test_every_code_has_its_label(spark):
    for name in ("GENDER", "EDUCATION", "COMPANY_SIZE", "YEARS_EXPERIENCE", "OPEN_DEPARTMENT", "COURSE_DEPARTMENT"):
        table = getattr(codes, name)
        rows = [(k,) for k in table]
        kind = "int" if isinstance(next(iter(table)), int) else "string"
        assert values(spark, f"c {kind}", rows, codes.label("c", table)) == list(table.values()), name
