"""Gold analytical marts, each a frame derived from the fact or an earlier mart."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.numbers import (
    PASS_MARK, approval_status, half_even, hundredths, mean_2, performance_band, rate_2,
)
from scorelake.functions.text import label_or
from scorelake.operators.ranking import dense_rank_by, dense_rank_by_pair, top_n

NO_COURSE, NO_SUBJECT, GENERAL = "Sin Curso", "Sin Materia", "General"
TOP_LABEL, BOTTOM_LABEL = "Top {n} Cuadro de Honor", "Bottom {n} Plan de Refuerzo"


def _count_where(c: Column) -> Column:
    return F.count_if(c)


def final_grade_by_student_subject(
    fact: DataFrame, students: DataFrame, courses: DataFrame, subjects: DataFrame, pass_mark=PASS_MARK
) -> DataFrame:
    """Final grade per student, course, subject and period.

    The fact is summed by ids first; names join the few summed rows, so the
    fact itself is shuffled once, after map-side sums.
    """
    sums = fact.groupBy("student_id", "course_id", "subject_id", "period_id").agg(
        F.sum("weighted_points").alias("points"),
        F.count("grade_id").alias("total_assessments"),
        F.sum("weight_percentage").alias("weights"),
        F.bool_and("is_passing").alias("passed_all_assessments"),
    )
    st = students.select(F.col("student_id").alias("_st"), "full_name")
    co = courses.select(F.col("course_id").alias("_co"), "course_name")
    su = subjects.select(F.col("subject_id").alias("_su"), "subject_name", "department")
    named = (
        sums.join(st, F.col("student_id") == F.col("_st"))
        .join(co, F.col("course_id") == F.col("_co"), "left")
        .join(su, F.col("subject_id") == F.col("_su"), "left")
    )
    approved = F.col("final_grade") >= F.lit(pass_mark)
    return named.select(
        "student_id", "full_name", "course_id", label_or(F.col("course_name"), NO_COURSE).alias("course_name"),
        "subject_id", label_or(F.col("subject_name"), NO_SUBJECT).alias("subject_name"),
        label_or(F.col("department"), GENERAL).alias("department"), "period_id",
        F.round("points", 2).cast("decimal(5,2)").alias("final_grade"), "total_assessments",
        F.round("weights", 2).cast("decimal(9,2)").alias("total_weight_evaluated"), "passed_all_assessments",
    ).withColumns({"is_approved": approved, "approval_status": approval_status(approved)})


def subject_performance(final: DataFrame) -> DataFrame:
    """Counts are of (student, period) rows; enrolled counts students once."""
    keys = ["subject_id", "subject_name", "course_id", "course_name", "department"]
    counted = final.groupBy(*keys).agg(
        F.count_distinct("student_id").alias("enrolled_students"),
        mean_2(F.col("final_grade")).alias("average_final_grade"),
        F.min("final_grade").alias("min_final_grade"),
        F.max("final_grade").alias("max_final_grade"),
        _count_where(F.col("is_approved")).alias("approved_count"),
        _count_where(~F.col("is_approved")).alias("failed_count"),
        F.count("final_grade").alias("_n"),
    )
    return counted.withColumns(
        {
            "pass_rate_percentage": rate_2(F.col("approved_count"), F.col("_n")),
            "fail_rate_percentage": rate_2(F.col("failed_count"), F.col("_n")),
        }
    ).drop("_n")


def student_performance(final: DataFrame) -> DataFrame:
    """Averages, pass counts, the two dense ranks and the performance band."""
    stats = final.groupBy("student_id", "full_name", "course_id", "course_name").agg(
        F.count_distinct("subject_id").alias("subjects_enrolled"),
        _count_where(F.col("is_approved")).alias("subjects_passed"),
        _count_where(~F.col("is_approved")).alias("subjects_failed"),
        mean_2(F.col("final_grade")).alias("overall_average"),
        F.min("final_grade").alias("lowest_subject_grade"),
        F.max("final_grade").alias("highest_subject_grade"),
    )
    ranked = dense_rank_by(stats, "overall_average", "desc", "academic_ranking_overall")
    ranked = dense_rank_by(ranked, "overall_average", "desc", "academic_ranking_in_course", ["course_id"])
    return ranked.withColumn("performance_category", performance_band(F.col("overall_average")))


def course_performance(students: DataFrame, courses: DataFrame) -> DataFrame:
    """Per course: mean of the students' rounded averages and pass rates."""
    sums = students.filter("course_id is not null").groupBy("course_id").agg(
        F.count_distinct("student_id").alias("total_students"),
        mean_2(F.col("overall_average")).alias("course_gpa"),
        F.sum("subjects_passed").alias("total_subjects_passed"),
        F.sum("subjects_failed").alias("total_subjects_failed"),
    )
    co = courses.select(F.col("course_id").alias("_co"), "course_name", "grade_level", "academic_year")
    taken = F.col("total_subjects_passed") + F.col("total_subjects_failed")
    return sums.join(co, F.col("course_id") == F.col("_co")).select(
        "course_id", "course_name", "grade_level", "academic_year", "total_students", "course_gpa",
        "total_subjects_passed", "total_subjects_failed",
        rate_2(F.col("total_subjects_passed"), taken).alias("overall_pass_rate_percentage"),
        rate_2(F.col("total_subjects_failed"), taken).alias("overall_fail_rate_percentage"),
    )


def assessment_type_performance(fact: DataFrame) -> DataFrame:
    """Grouped by the stored type; the label is put on afterwards."""
    counted = fact.groupBy("assessment_type").agg(
        F.count(F.lit(1)).alias("total_evaluations_taken"),
        mean_2(F.col("score")).alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        _count_where(F.col("is_passing")).alias("passing_count"),
        _count_where(~F.col("is_passing")).alias("failing_count"),
    )
    return counted.withColumns(
        {
            "assessment_type": label_or(F.col("assessment_type"), GENERAL),
            "pass_rate_percentage": rate_2(F.col("passing_count"), F.col("total_evaluations_taken")),
        }
    )


def top_bottom_students(students: DataFrame, n: int = 5) -> DataFrame:
    """The n best and the n weakest averages; ties go by student and course."""
    tie = [F.col("student_id").asc(), F.col("course_id").asc_nulls_last()]

    def cohort(label: str, first: Column) -> DataFrame:
        return top_n(students, n, [first, *tie]).select(
            F.lit(label.format(n=n)).alias("cohort_group"), F.col("academic_ranking_overall").alias("ranking_position"),
            "student_id", "full_name", "course_name", "overall_average",
        )

    both = cohort(TOP_LABEL, F.col("overall_average").desc_nulls_first()).unionByName(
        cohort(BOTTOM_LABEL, F.col("overall_average").asc_nulls_last())
    )
    return both.orderBy(F.col("overall_average").desc_nulls_first())


def subjects_highest_failure(subjects: DataFrame) -> DataFrame:
    """Subjects by failure rate, then by the lower average."""
    ranked = dense_rank_by_pair(
        subjects, ("fail_rate_percentage", "desc"), ("average_final_grade", "asc"), "failure_rank"
    )
    return ranked.select(
        "subject_id", "subject_name", "course_name", "department", "enrolled_students", "failed_count",
        "fail_rate_percentage", "average_final_grade", "failure_rank",
    ).orderBy(F.col("fail_rate_percentage").desc_nulls_first(), F.col("average_final_grade").asc_nulls_last())


def dashboard_kpis(final: DataFrame, students: DataFrame, subjects: DataFrame) -> DataFrame:
    """One row: students, mean average (half-even), pass and fail %, counts."""
    st = students.agg(
        F.count(F.lit(1)).alias("total_students"), F.sum(hundredths(F.col("overall_average"))).alias("_sum")
    ).select(F.struct("total_students", "_sum")).scalar()
    n_subjects = subjects.agg(F.count(F.lit(1))).scalar()
    one = final.agg(
        F.count(F.lit(1)).alias("total_evaluations"), F.count_if("is_approved").alias("_ok")
    ).withColumns({"_st": st, "total_subjects": n_subjects})
    zero = F.lit(0).cast("decimal(5,2)")
    rate = F.coalesce(half_even(F.col("_ok") * 100, F.col("total_evaluations"), 2, "decimal(5,2)"), zero)
    mean = half_even(F.col("_st._sum"), F.col("_st.total_students") * 100, 2, "decimal(5,2)")
    fail = F.when(F.col("total_evaluations") > 0, (F.lit(100) - F.col("pass_rate_percentage")).cast("decimal(5,2)")).otherwise(zero)
    return one.select(
        F.col("_st.total_students").alias("total_students"), F.coalesce(mean, zero).alias("average_gpa"),
        rate.alias("pass_rate_percentage"), "total_evaluations", "total_subjects",
    ).withColumn("fail_rate_percentage", fail)


def report_card(final: DataFrame, students: DataFrame, student_id: str) -> DataFrame:
    """A student's subjects under the header with both ranks and the band.

    The key filter reaches both scans.
    """
    head = students.filter(F.col("student_id") == student_id).select(
        F.col("student_id").alias("_id"), F.col("course_id").alias("_course"), "overall_average", "academic_ranking_overall",
        "academic_ranking_in_course", "performance_category",
    )
    body = final.filter(F.col("student_id") == student_id).select(
        "student_id", "full_name", "course_id", "course_name", "subject_name", "department", "period_id", "final_grade",
        "is_approved", "approval_status",
    )
    same = (F.col("student_id") == F.col("_id")) & F.col("course_id").eqNullSafe(F.col("_course"))
    return body.join(head, same).drop("_id", "_course").orderBy("subject_name", "period_id")
