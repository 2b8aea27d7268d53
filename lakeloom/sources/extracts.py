"""Extracts of a learning platform's tables for courses asked for: who is enrolled, what they handed in, which roles they have.

The tables come from :func:`lakeloom.sources.files.read_database` or from files; the courses are a short list, so they
become a filter that the database or the scan applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrolled_users(users: DataFrame, enrolments: DataFrame, courses: Sequence[str]) -> DataFrame:
    """The users with an enrolment in any of the courses, with it."""
    asked = enrolments.where(F.col("course_id").isin(list(courses))).select("user_id", "course_id", "created", "is_active", "mode")
    people = users.select("id", "username", "first_name", "last_name", "email", "is_staff", "is_active", "is_superuser", "last_login", "date_joined")
    people = people.withColumnRenamed("is_active", "user_is_active")
    return people.join(asked, F.col("id") == F.col("user_id")).drop("user_id")


def submissions(modules: DataFrame, courses: Sequence[str]) -> DataFrame:
    """The states of learners' modules in the courses."""
    return modules.where(F.col("course_id").isin(list(courses))).select("id", "module_type", "module_id", "student_id", "state", "grade", "created", "modified", "max_grade", "done", "course_id")


def enrolments_of(enrolments: DataFrame, courses: Sequence[str]) -> DataFrame:
    return enrolments.where(F.col("course_id").isin(list(courses))).select("id", "user_id", "course_id", "created", "is_active", "mode")


def roles(access: DataFrame, courses: Sequence[str]) -> DataFrame:
    return access.where(F.col("course_id").isin(list(courses))).select("id", "user_id", "org", "course_id", "role")
