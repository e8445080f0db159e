"""Gold star schema: five dimensions and the fact of one row per grade."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.functions.dates import date_parts
from scorelake.functions.numbers import PASS_MARK, weighted_points
from scorelake.functions.text import full_name


def dim_course(courses: DataFrame) -> DataFrame:
    return courses.select("course_id", "course_name", "grade_level", "academic_year")


def dim_subject(subjects: DataFrame) -> DataFrame:
    return subjects.select("subject_id", "subject_name", "course_id", "department")


def dim_period(periods: DataFrame) -> DataFrame:
    return periods.select("period_id", "period_name", "weight")


def dim_student(students: DataFrame) -> DataFrame:
    return students.select(
        "student_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"), "first_name", "last_name",
        "document_number", "gender", "email", "course_id", "enrollment_date", "status",
    )


def dim_date(*dates: tuple[DataFrame, str]) -> DataFrame:
    """Every day seen in the given (frame, column) pairs, once.

    Distinct runs map-side first, so each task shuffles a day once.
    """
    seen = [df.select(F.col(c).alias("dt")).filter("dt is not null") for df, c in dates]
    days = reduce(DataFrame.union, seen).distinct()
    return days.select(*[c.alias(n) for n, c in date_parts(F.col("dt")).items()])


def fact_grades(grades: DataFrame, assessments: DataFrame, students: DataFrame, pass_mark=PASS_MARK) -> DataFrame:
    """Grades with both parents, the weighted points and the pass flag.

    The course is the assessment's, or else the student's.
    """
    ev = assessments.select(
        F.col("assessment_id").alias("_ev"), "subject_id", F.col("course_id").alias("_ev_course"), "period_id",
        "assessment_name", "assessment_type", "weight_percentage",
    )
    st = students.select(F.col("student_id").alias("_st"), F.col("course_id").alias("_st_course"))
    g = grades.select("grade_id", "student_id", "assessment_id", "submission_date", "score", "feedback")
    joined = g.join(ev, F.col("assessment_id") == F.col("_ev")).join(st, F.col("student_id") == F.col("_st"))
    return joined.select(
        "grade_id", "student_id", "subject_id", F.coalesce("_ev_course", "_st_course").alias("course_id"), "period_id",
        "submission_date", "assessment_id", "assessment_name", "assessment_type", "weight_percentage", "score",
        weighted_points(F.col("score"), F.col("weight_percentage")).alias("weighted_points"),
        (F.col("score") >= F.lit(pass_mark)).alias("is_passing"), "feedback",
    )
