"""Schema inference over JSON lines and the migration that uses it."""

from __future__ import annotations

import decimal
import random

import pytest
from pyspark.sql.types import StructType

from lakeloom.sources import json_lines
from lakeloom.sources.json_lines import BIG, BOOLEAN, DOUBLE, LIST, LONG, NULL, OBJECT, TEXT, CountError, inferred, migrate, typed, widened
from lakeloom.sources.versioned import VersionedTable


def lines(spark, *texts, parts=3):
    return spark.createDataFrame([(t,) for t in texts], "value string").repartition(parts)


def test_widening_is_a_lattice():
    kinds = [NULL, BOOLEAN, LONG, BIG, DOUBLE, TEXT, OBJECT, LIST]
    assert [widened(NULL | k) for k in kinds] == [widened(k) for k in kinds] == ["string", "boolean", "long", "decimal", "double", "string", "object", "array"]
    assert widened(LONG | BIG) == "decimal" and widened(LONG | DOUBLE) == widened(BIG | DOUBLE) == "double"
    for a in kinds[1:]:
        for b in kinds[1:]:
            if a != b and not {a, b} <= {LONG, BIG, DOUBLE}:
                assert widened(a | b) == "string"


def test_schema_does_not_depend_on_order_or_partitions(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2.5], "d": null}}', '{"a": 2.5, "b": {"c": [], "e": "x"}}', '{"f": [{"g": 1}, {"g": "t", "h": true}]}', '{"a": null, "i": 1}', '{"i": "text"}', '{"j": {"k": 1}}', '{"j": 5}', "", "  "]
    expected = "struct<a:double,b:struct<c:array<double>,d:string,e:string>,f:array<struct<g:string,h:boolean>>,i:string,j:string>"
    for seed in range(3):
        random.Random(seed).shuffle(texts)
        schema, bad = inferred(lines(spark, *texts, parts=seed + 1))
        assert (schema.simpleString(), bad) == (expected, 0)


def test_values_keep_what_they_were(spark):
    texts = ['{"id": 1, "v": 1, "o": {"x": 1}, "big": 12345678901234567890, "last": 9223372036854775807}', '{"id": "b", "v": 2.5, "o": [1, 2], "big": 1}', '{"id": {"n": 1}, "v": null, "o": "t", "big": null, "last": -9223372036854775808}']
    found = lines(spark, *texts)
    rows = {r["id"]: r for r in typed(found, inferred(found)[0]).collect()}
    assert set(rows) == {"1", "b", '{"n":1}'} and rows["1"]["v"] == 1.0 and rows["b"]["v"] == 2.5
    assert rows["1"]["o"] == '{"x":1}' and rows["b"]["o"] == "[1,2]" and rows['{"n":1}']["o"] == "t"
    assert rows["1"]["big"] == decimal.Decimal("12345678901234567890") and rows["1"]["last"] == 2**63 - 1 and rows['{"n":1}']["last"] == -(2**63)


def test_odd_names(spark):
    found = lines(spark, '{"a.b": 1, "c d": {"e`f": true}, "é": "x", "": 5}')
    schema, _ = inferred(found)
    assert sorted(schema.names) == ["", "a.b", "c d", "é"]
    row = typed(found, schema).first()
    assert row["a.b"] == 1 and row["c d"]["e`f"] is True and row["é"] == "x" and row[""] == 5


def test_lines_that_are_no_objects(spark, tmp_path):
    assert inferred(lines(spark, '{"a": 1}', "[1]", "not json", "3"))[1] == 3
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"a": 1}\nbroken\n')
    with pytest.raises(CountError):
        migrate(spark, f"{tmp_path}/in", VersionedTable(spark, f"{tmp_path}/out"))
    assert VersionedTable(spark, f"{tmp_path}/out").version() is None


def test_migration(spark, tmp_path):
    for i in range(3):
        (tmp_path / "in" / f"day={i}").mkdir(parents=True)
        (tmp_path / "in" / f"day={i}" / "x.jsonl").write_text(f'{{"a": {i}, "b": "t"}}\n\n{{"a": {i}.5, "c": [{i}]}}\n')
    table = VersionedTable(spark, f"{tmp_path}/out")
    migrate(spark, f"{tmp_path}/in", table)
    assert table.read().schema.simpleString() == "struct<a:double,b:string,c:array<bigint>>"
    assert sorted(r["a"] for r in table.read().collect()) == [0.0, 0.5, 1.0, 1.5, 2.0, 2.5]
    with pytest.raises(ValueError):
        migrate(spark, f"{tmp_path}/in", table)


def test_a_short_count_stops_the_migration(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    table = VersionedTable(spark, f"{tmp_path}/out")
    whole = json_lines.typed
    monkeypatch.setattr(json_lines, "typed", lambda *a: whole(*a).limit(1))
    with pytest.raises(CountError):
        migrate(spark, f"{tmp_path}/in", table)
    assert table.version() is None


def test_no_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text("")
    table = VersionedTable(spark, f"{tmp_path}/out")
    migrate(spark, f"{tmp_path}/in", table, StructType().add("a", "long"))
    assert table.read().schema.simpleString() == "struct<a:bigint>" and table.read().count() == 0
