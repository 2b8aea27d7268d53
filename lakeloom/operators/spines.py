"""Calendar dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days(spark: SparkSession, first: str, end: str) -> DataFrame:
    """(date_day) from ``first`` to before ``end``."""
    return spark.sql(f"select explode(sequence(date'{first}', date'{end}' - interval 1 day, interval 1 day)) as date_day")


def months(spark: SparkSession, first: str, end: str) -> DataFrame:
    """(month_start) of each month from ``first`` to before ``end``."""
    return spark.sql(f"select explode(sequence(date'{first}', date'{end}' - interval 1 day, interval 1 month)) as month_start")


def fiscal_year(day: Column, first_month: int = 7) -> Column:
    """The year in which the fiscal year ends."""
    return F.year(day) + F.when(F.month(day) >= first_month, 1).otherwise(0)


def fiscal_quarter(day: Column, first_month: int = 7) -> Column:
    """1 to 4, counted from the first month of the fiscal year."""
    return (F.floor((F.month(day) + 12 - first_month) % 12 / 3) + 1).cast("int")


def months_and_today(spark: SparkSession, first: str, today: str) -> DataFrame:
    """(moment) of each month's start from ``first`` on, and of ``today`` beside them, so that reports end with the day they are run."""
    return spark.sql(f"select explode(array_union(sequence(date'{first}', date'{today}', interval 1 month), array(date'{today}'))) as moment")


def date_dimension(spark: SparkSession, first: str = "2010-01-01", end: str = "2031-01-01") -> DataFrame:
    """One row a day: key, parts, ISO week and weekday, fiscal and academic year (that in which it begins)."""
    d = F.col("date_day")
    iso_day = F.weekday(d) + 1
    term = F.when(F.month(d) >= 9, "Fall").when(F.month(d) == 1, "IAP").when(F.month(d) <= 5, "Spring").otherwise("Summer")
    return days(spark, first, end).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "date_day",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        F.weekofyear(d).alias("iso_week"),
        iso_day.alias("iso_day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso_day >= 6).alias("is_weekend"),
        fiscal_year(d).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
        (fiscal_year(d, 9) - 1).alias("academic_year"),
        term.alias("term"),
    )


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row for each minute of the day."""
    hour, minute = F.expr("cast(id div 60 as int)"), F.expr("cast(id % 60 as int)")
    part = F.when(F.col("hour").between(5, 11), "Morning").when(F.col("hour").between(12, 16), "Afternoon").when(F.col("hour").between(17, 20), "Evening").otherwise("Night")
    rows = spark.range(1440).select((hour * 100 + minute).alias("time_key"), hour.alias("hour"), minute.alias("minute"))
    return rows.withColumn("part_of_day", part).withColumn("hour_12", F.when(F.col("hour") % 12 == 0, 12).otherwise(F.col("hour") % 12))
