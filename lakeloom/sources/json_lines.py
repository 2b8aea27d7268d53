"""JSON lines to typed tables: a schema is inferred by all tasks, merged by widening, and the lines are read with it.

Each task folds its lines to one small table of paths, with a bit for each kind of value met there, so what is shuffled is a row
for each path and task. Bits are united by ``bit_or``, so the outcome depends neither on the order of lines nor on the partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, LongType, StringType, StructField, StructType

from .versioned import VersionedTable, Version

#: The kinds of values, each a bit.
NULL, BOOLEAN, LONG, BIG, DOUBLE, TEXT, OBJECT, LIST = (1 << i for i in range(8))
_NAMES = {BOOLEAN: "boolean", LONG: "long", BIG: "decimal", DOUBLE: "double", TEXT: "string", OBJECT: "object", LIST: "array"}
#: Parts of a path: a member's name behind a mark, or the mark of an element. No JSON text holds either mark unescaped.
MEMBER, ELEMENT = "\x1f", "\x1e"
#: Digits that a decimal holds.
DIGITS = 38


def widened(bits: int) -> str:
    """The narrowest kind that holds all that was met: null below all, long below decimal below double, unlike kinds are text."""
    bits &= ~NULL
    if not bits:
        return "string"
    if bits in _NAMES:
        return _NAMES[bits]
    if not bits & ~(LONG | BIG):
        return "decimal"
    if not bits & ~(LONG | BIG | DOUBLE):
        return "double"
    return "string"


def kind_of(value) -> int:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return BOOLEAN
    if isinstance(value, int):
        return LONG if -(1 << 63) <= value < 1 << 63 else BIG if len(str(abs(value))) <= DIGITS else TEXT
    if isinstance(value, float):
        return DOUBLE
    return TEXT if isinstance(value, str) else OBJECT if isinstance(value, dict) else LIST


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, bits, n, bad) of a task's lines: how many values each path has, and how many lines are no objects."""
    bits: dict[str, int] = {"": 0}
    n: dict[str, int] = {"": 0}
    bad = 0

    def met(path: str, value) -> None:
        bits[path] = bits.get(path, 0) | kind_of(value)
        n[path] = n.get(path, 0) + (value is not None)
        inside = [(f"{path}{MEMBER}{k}", v) for k, v in value.items()] if isinstance(value, dict) else [(path + ELEMENT, v) for v in value] if isinstance(value, list) else []
        for where, v in inside:
            met(where, v)

    for batch in batches:
        for line in batch["value"]:
            if line is None or not line.strip():
                continue
            try:
                value = json.loads(line)
            except ValueError:
                value = None
            if isinstance(value, dict):
                met("", value)
            else:
                bad += 1
    yield pd.DataFrame({"path": list(bits), "bits": list(bits.values()), "n": [n[p] for p in bits], "bad": [bad if p == "" else 0 for p in bits]})


def paths(lines: DataFrame) -> DataFrame:
    """(path, bits, n, bad) of all ``lines`` (value string): one row for each path, "" for the lines themselves."""
    folded = lines.select("value").mapInPandas(_folded, "path string, bits long, n long, bad long")
    return folded.groupBy("path").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def described(lines: DataFrame) -> DataFrame:
    """(path, kind, n): the columns that :func:`inferred` makes, members parted by dots and elements marked by brackets."""
    kind = F.element_at(F.array(*[F.lit(widened(b)) for b in range(2 * LIST)]), F.col("bits").cast("int") + 1)
    shown = F.regexp_replace(F.regexp_replace(F.substring("path", 2, 1 << 30), MEMBER, "."), ELEMENT, "[]")
    return paths(lines).where("path <> ''").select(shown.alias("path"), kind.alias("kind"), "n")


def _type_at(path: str, bits: dict[str, int], inside: dict[str, list[str]]) -> DataType:
    kind = widened(bits[path])
    if kind == "object":
        fields = [StructField(p.rpartition(MEMBER)[2], _type_at(p, bits, inside)) for p in sorted(inside.get(path, [])) if not p.endswith(ELEMENT)]
        # an object without members has no columns to hold
        return StructType(fields) if fields else StringType()
    if kind == "array":
        return ArrayType(_type_at(path + ELEMENT, bits, inside) if path + ELEMENT in bits else StringType())
    return {"boolean": BooleanType(), "long": LongType(), "decimal": DecimalType(DIGITS, 0), "double": DoubleType()}.get(kind, StringType())


def inferred(lines: DataFrame) -> tuple[StructType, int]:
    """The schema of ``lines`` (value string), columns by name, and how many lines are no JSON objects.

    Blank lines count as none. A path that is now an object or array and now something else is text, and so is what has only nulls. As
    many rows reach the driver as the schema has paths.
    """
    found = paths(lines).collect()
    bits = {r["path"]: r["bits"] for r in found}
    inside: dict[str, list[str]] = {}
    for p in bits:
        if p:
            inside.setdefault(p[:-1] if p.endswith(ELEMENT) else p.rpartition(MEMBER)[0], []).append(p)
    schema = _type_at("", bits, inside) if bits.get("") else StructType()
    return schema if isinstance(schema, StructType) else StructType(), sum(r["bad"] for r in found)


def typed(lines: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """``lines`` as columns of ``schema``; values of other kinds in a text column are their JSON text."""
    rows = lines.where(F.length(F.trim(column)) > 0).select(F.from_json(column, schema).alias("__row"))
    return rows.select([F.col("__row").getField(f.name).alias(f.name) for f in schema])


class CountError(ValueError):
    """The table written has other rows than the lines."""


def migrate(spark: SparkSession, folder: str, table: VersionedTable, columns: StructType | None = None) -> Version:
    """Write the JSON lines below ``folder`` as the first version of ``table``; the lines stay.

    Rows are counted in the files written, and only if they are as many as the lines does the version come to be. Without lines the table is
    empty and has ``columns``. Lines that are no objects are an error, as a row of nulls would hide them.
    """
    lines = spark.read.text(folder, recursiveFileLookup=True)
    schema, bad = inferred(lines)
    if bad:
        raise CountError(f"{bad} lines of {folder} are no JSON objects")
    rows = typed(lines, schema) if schema.fields else spark.createDataFrame([], columns or StructType())
    n = lines.where(F.length(F.trim("value")) > 0).count()

    def change(base: Version | None):
        if base is not None:
            raise ValueError(f"there is a table at {table.path} already")
        files = table._written(rows)
        written = table._rows(Version(0, rows.schema.json()), files).count()
        if written != n:
            raise CountError(f"{written} rows of {n} lines")
        return rows.schema.json(), files

    return table._changed("migrate", change, None)
