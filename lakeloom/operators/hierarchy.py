"""Trees kept as ordered rows or as paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def filled(blocks: DataFrame, course: list[str], index: str, kind: str, block: str, levels: list[str]) -> DataFrame:
    """``blocks`` with ``<level>_id`` for each level: the nearest block of that kind at or before, in depth-first order.

    A block of a level above ends the level below.
    """
    along = Window.partitionBy(*course).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks
    for i, level in enumerate(levels):
        own = F.when(F.col(kind) == level, F.struct(F.col(index).alias("at"), F.col(block).alias("id")))
        rows = rows.withColumn(f"__{i}", F.last(own, ignorenulls=True).over(along))
    for i, level in enumerate(levels):
        above = [F.col(f"__{j}.at") for j in range(i)]
        current = F.col(f"__{i}")
        for up in above:
            current = F.when(up.isNull() | (up <= F.col(f"__{i}.at")), current)
        rows = rows.withColumn(f"{level}_id", current["id"])
    return rows.drop(*[f"__{i}" for i in range(len(levels))])


def climbed(blocks: DataFrame, block: str, parent: str, depth: int) -> DataFrame:
    """``blocks`` with ``parent_1`` .. ``parent_depth``: as many self-joins on the parent."""
    up = blocks.select(F.col(block).alias("__block"), F.col(parent).alias("__parent")).dropDuplicates(["__block"])
    rows = blocks.withColumn("parent_1", F.col(parent))
    for i in range(1, depth):
        rows = rows.join(up, F.col(f"parent_{i}") == F.col("__block"), "left").withColumn(f"parent_{i + 1}", F.col("__parent")).drop("__block", "__parent")
    return rows


def requirement_tree(operators: DataFrame, courses: DataFrame, width: int) -> DataFrame:
    """Each program's courses with the requirement that they count for, in display order.

    ``operators`` (operator_id, path, rule, least, title) and ``courses`` (course_id, program_id, path) are nodes of one
    materialised tree with steps of ``width``. A course counts for the operator nearest above it (``requirement_id``),
    which is nested if another one is above that (``parent_id``). ``kind`` is Core under "all_of" and Elective under
    "min_number_of". ``n_required`` is the program's core courses and, of each elective set that is not nested, the
    least number. ``place`` orders a program's courses by path. A course without operator stays.
    """
    steps = F.expr(f"transform(sequence(1, greatest(length(path) div {width} - 1, 1)), i -> left(path, i * {width}))")
    above = courses.withColumn("__prefix", F.explode(steps)).join(operators.withColumnRenamed("path", "__path"), F.col("__prefix") == F.col("__path"))
    one = F.struct(F.length("__path").alias("depth"), "operator_id", F.col("__path").alias("path"), "rule", "least", "title", F.col("path").alias("course_path"))
    # as many operators above a course as the tree is deep
    line = above.groupBy("course_id", "program_id").agg(F.sort_array(F.collect_list(one), asc=False).alias("line"))
    alone = courses.groupBy("course_id", "program_id").agg(F.min("path").alias("course_path"))
    near, next_ = F.get("line", F.lit(0)), F.get("line", F.lit(1))
    kind = F.when(near["rule"] == "min_number_of", "Elective").when(near["rule"] == "all_of", "Core")
    rows = alone.join(line, ["course_id", "program_id"], "left").select(
        "course_id",
        "program_id",
        near["operator_id"].alias("requirement_id"),
        kind.alias("kind"),
        near["title"].alias("title"),
        near["least"].alias("least"),
        F.when(near["path"].startswith(next_["path"]), next_["operator_id"]).alias("parent_id"),
        F.coalesce(near["course_path"], "course_path").alias("course_path"),
    )
    sets = rows.groupBy("program_id", "requirement_id").agg(
        F.count_if(F.col("kind") == "Core").alias("core"),
        F.avg(F.when((F.col("kind") == "Elective") & F.col("parent_id").isNull(), F.col("least"))).alias("elective"),
    )
    counts = sets.groupBy("program_id").agg((F.sum("core") + F.coalesce(F.sum("elective"), F.lit(0))).cast("long").alias("n_required"))
    place = F.row_number().over(Window.partitionBy("program_id").orderBy("course_path", "course_id"))
    return rows.join(counts, "program_id").withColumn("place", place).withColumn("is_nested", F.col("parent_id").isNotNull()).drop("course_path")
