"""Dashboard measures over the fact, the final grades and the dimensions.

The fact is read once, into slices of sums and student bitmaps by course and subject; any measure
by any slicer is a merge of those. Bitmaps of numbered students make distinct counts exact and mergeable.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.numbers import PASS_MARK, half_up, hundredths, mean_2
from scorelake.operators.ordinals import number_rows
from scorelake.operators.skew import group_left_join

SUMS = ["total_grades", "score_sum", "score_n", "weighted", "final_sum", "final_n"]
BITMAPS = {"seen": "students_evaluated", "approved": "students_approved"}


def with_dimensions(df: DataFrame, courses: DataFrame, subjects: DataFrame) -> DataFrame:
    """Adds the slicer columns: course_name, grade_level, academic_year,
    subject_name, department. Slicers already there are replaced."""
    co = courses.select(F.col("course_id").alias("_co"), "course_name", "grade_level", "academic_year")
    su = subjects.select(F.col("subject_id").alias("_su"), "subject_name", "department")
    bare = df.drop("course_name", "grade_level", "academic_year", "subject_name", "department")
    return (
        bare.join(co, F.col("course_id") == F.col("_co"), "left").join(su, F.col("subject_id") == F.col("_su"), "left").drop("_co", "_su")
    )


def number_students(students: DataFrame) -> DataFrame:
    """(student_id, student_no): every student's place in the bitmaps, from 1."""
    return number_rows(students.select("student_id").distinct(), [F.col("student_id")], "student_no")


def fact_slices(fact: DataFrame, numbers: DataFrame, pass_mark=PASS_MARK) -> DataFrame:
    """One row per course, subject and bucket of 32,768 students: grades, scores, weighted points and final
    grades as sums, and who was evaluated and who passed as bitmaps.

    The fact is summed to one row per final grade before anything joins it. ``numbers`` holds every student of
    the fact. A row is 8 KB of bitmaps, so this pays where a course and subject has many students of a
    bucket, not where it has a handful. Store the frame: every slicer reads it.
    """
    finals = fact.groupBy("student_id", "course_id", "subject_id", "period_id").agg(
        F.count(F.lit(1)).alias("total_grades"), F.sum(hundredths(F.col("score"))).alias("score_sum"), F.count("score").alias("score_n"),
        F.sum(F.col("score") * F.col("weight_percentage") * F.lit(Decimal("0.01"))).cast("decimal(24,6)").alias("weighted"),
        F.round(F.sum("weighted_points"), 2).cast("decimal(5,2)").alias("final"),
    )
    placed = finals.join(numbers, "student_id", "left")
    spot = F.bitmap_bit_position("student_no")
    return placed.groupBy("course_id", "subject_id", F.bitmap_bucket_number("student_no").alias("bucket")).agg(
        *[F.sum(c).alias(c) for c in ("total_grades", "score_sum", "score_n", "weighted")],
        F.sum(hundredths(F.col("final"))).alias("final_sum"), F.count("final").alias("final_n"),
        F.bitmap_construct_agg(spot).alias("seen"), F.bitmap_construct_agg(F.when(F.col("final") >= F.lit(pass_mark), spot)).alias("approved"),
    )


def _measures(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Sums over the buckets of a slice, and the rates: pass and fail rate are 0 and 1 on an empty slice."""
    whole = merged.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *[F.coalesce(F.sum(F.bitmap_count(b)), F.lit(0)).alias(n) for b, n in BITMAPS.items()])
    rate = F.coalesce(F.try_divide(F.col("students_approved"), F.col("students_evaluated")), F.lit(0.0))

    def mean(total: str, n: str) -> Column:
        return half_up(F.col(total), F.col(n) * 100, 2, "decimal(5,2)")

    return whole.select(
        *keys, F.coalesce("total_grades", F.lit(0)).alias("total_grades"), mean("score_sum", "score_n").alias("average_score"), "students_evaluated",
        F.col("weighted").cast("decimal(24,6)").alias("weighted_final"), "students_approved", mean("final_sum", "final_n").alias("average_final"),
        rate.alias("pass_rate"), (1 - rate).alias("fail_rate"),
    )


def _merged_cells() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in SUMS], *[F.bitmap_or_agg(b).alias(b) for b in BITMAPS]]


def measure(slices: DataFrame, courses: DataFrame, subjects: DataFrame, by: list[str], where: Column | None = None) -> DataFrame:
    """Every measure per slice: grades, mean score, students, weighted final,
    approved students, mean final, pass and fail rate."""
    rows = with_dimensions(slices, courses, subjects)
    rows = rows if where is None else rows.filter(where)
    return _measures(rows.groupBy(*by, "bucket").agg(*_merged_cells()), by)


def measure_sets(
    slices: DataFrame, courses: DataFrame, subjects: DataFrame, sets: dict[str, list[str]], where: Column | None = None
) -> DataFrame:
    """Every measure for several slicers at once: ``slicer`` names the set, columns that it does not have are NULL.

    Grouping sets over the stored slices: one scan, however many slicers there are.
    """
    rows = with_dimensions(slices, courses, subjects)
    rows = rows if where is None else rows.filter(where)
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    tried = [[*[F.col(c) for c in keys], F.col("bucket")] for keys in sets.values()]
    merged = rows.groupingSets(tried, *columns, "bucket").agg(*_merged_cells(), F.grouping_id().alias("_set"))
    slicer = F.lit(None).cast("string")
    for name, keys in sets.items():
        left_out = int("".join("0" if c in keys else "1" for c in columns) + "0", 2)
        slicer = F.when(F.col("_set") == left_out, F.lit(name)).otherwise(slicer)
    return _measures(merged.withColumn("slicer", slicer), ["slicer", *columns])


def monthly_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean score per calendar month. Days are summed before the dates join."""
    days = fact.filter("submission_date is not null").groupBy("submission_date").agg(
        F.sum((F.col("score") * 100).cast("bigint")).alias("_sum"), F.count("score").alias("_n")
    )
    d = dates.select("date_key", "year", "month")
    joined = days.join(d, F.col("submission_date") == F.col("date_key"))
    months = joined.groupBy("year", "month").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("total_grades"))
    return months.select("year", "month", "total_grades", half_up(F.col("_sum"), F.col("total_grades") * 100, 2, "decimal(5,2)").alias("average_score"))


def subject_spread(final: DataFrame, pass_mark=PASS_MARK) -> DataFrame:
    """Per subject: mean, sample standard deviation, and students at risk.

    A student is at risk when any final grade is below the pass mark.
    """
    grade = F.col("final_grade").cast("double")
    return final.groupBy("subject_id", "subject_name").agg(
        mean_2(F.col("final_grade")).alias("average_final"),
        F.stddev_samp(grade).alias("std_final"),
        F.count_distinct(F.when(F.col("final_grade") < F.lit(pass_mark), F.col("student_id"))).alias("students_at_risk"),
    )


def student_vs_course(final: DataFrame) -> DataFrame:
    """Each final grade beside the mean of its course in the same subject.

    Means and rows both read the final grades: pass a stored frame.
    """
    means = final.groupBy("course_id", "subject_id").agg(mean_2(F.col("final_grade")).alias("course_average"))
    rows = final.select("student_id", "course_id", "subject_id", "period_id", "final_grade")
    joined = group_left_join(rows, means, ["course_id", "subject_id"])
    return joined.withColumn("difference", (F.col("final_grade") - F.col("course_average")).cast("decimal(6,2)"))


def top_failing_subjects(failures: DataFrame, n: int = 5) -> DataFrame:
    """First n of the failure ranking; ties go by subject and course name."""
    return failures.orderBy("failure_rank", "subject_id", "course_name").limit(n)
