"""Faults found in review, each with the case that showed it."""
import pytest
from pyspark.sql import functions as F

from scorelake.functions import dates, numbers, text
from scorelake.operators import duplicates, skew
from scorelake.plans import checks, mapping, profile
from scorelake.sources import writers


def catalog_of(spark, headers):
    rows = [("w", "notas", 0, h, i) for i, h in enumerate(headers)]
    return spark.createDataFrame(rows, "workbook string, table_name string, table_position int, column_name string, position int")


@pytest.mark.parametrize("copies", [1, 2, 12])
def test_repeated_headers_lose_no_match(spark, copies):
    catalog = catalog_of(spark, [*["nota"] * copies, "id_not", "estudiante_id", "evaluacion_id"])
    assigned = spark.createDataFrame([("w", "notas", "grades")], "workbook string, table_name string, entity string")
    found = {r["field"]: r["column_name"] for r in mapping.map_columns(catalog, assigned).collect()}
    assert found == {"score": "nota", "grade_id": "id_not", "student_id": "estudiante_id", "assessment_id": "evaluacion_id"}


def test_headers_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("1", "a", "b")], ["student_id", "No. ruta", "tick`"])
    out = mapping.apply_mapping(df, {"student_id": "student_id"}, "students").first()
    assert out["extra"] == '{"No. ruta":"a","tick`":"b"}'
    assert df.filter(text.contains_any(["No. ruta"], "A")).count() == 1


def test_a_last_newline_is_no_digit(spark):
    df = spark.createDataFrame([("3\n", "2025-01-01\n", "3,5\n")], "i string, d string, n string")
    got = df.select(numbers.guarded_int_untrimmed(F.col("i")), dates.guarded_iso_date(F.col("d")), numbers.decimal_comma(F.col("n"))).first()
    assert tuple(got) == (None, None, None)


def test_blank_grade_ids_are_numbered(spark):
    grades = spark.createDataFrame([("", "s1", "a1", "3"), (" ", "s2", "a1", "4")], "nid string, sid string, aid string, n string")
    students = spark.createDataFrame([("s1", "Ana")], "sid string, nm string")
    works = spark.createDataFrame([("a1", "Quiz", "100")], "aid string, nm string, w string")
    out = mapping.apply_proposal({"g": grades, "s": students, "a": works}, {
        "grades": ("g", {"nid": "grade_id", "sid": "student_id", "aid": "assessment_id", "n": "score"}),
        "students": ("s", {"sid": "student_id", "nm": "first_name"}),
        "assessments": ("a", {"aid": "assessment_id", "nm": "name", "w": "weight"})})
    assert sorted(r["grade_id"] for r in out["grades"].collect()) == ["G-000001", "G-000002"]


def test_weights_on_the_edge_fail(spark):
    df = spark.createDataFrame([("a", 99.5), ("b", 99.6), ("c", 100.5)], "k string, w double").withColumn("w", F.col("w").cast("decimal(9,2)"))
    assert checks.check_weights(df, ["k"], "w", "x").first()["violations"] == 2


def test_manifest_tells_equal_file_names_apart(spark, tmp_path):
    for name, rows in (("one a", 2), ("two", 3)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text("x\n" + "1\n" * rows)
    got = writers.file_manifest(spark, [f"{tmp_path}/one a", f"{tmp_path}/two"], "csv")
    assert sorted(r["row_count"] for r in got.collect()) == [2, 3]
    both = writers.file_manifest(spark, [f"{tmp_path}/*"], "csv")
    assert sorted(r["row_count"] for r in both.collect()) == [2, 3]


def test_dates_are_whole_texts(spark):
    df = spark.createDataFrame([("2025-02-03x", "2025-02-03 10:30")], "a string, b string")
    kinds = {r["column_name"]: r["inferred_type"] for r in profile.profile_columns(df, "t").collect()}
    assert kinds == {"a": "string", "b": "date"}


def test_join_with_a_hot_and_a_null_key(spark):
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = skew.group_left_join(rows, groups, ["k"])
    assert got.count() == 9_000 and got.filter("k = 'hot'").agg(F.min("n")).first()[0] == 3_000
    assert got.filter("k IS NULL").agg(F.min("n")).first()[0] == 3_000
    assert duplicates.all_copies(rows, ["k"]).count() == 6_000
