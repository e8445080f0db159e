"""Mergeable slices of the fact, and keyed tables of which a load rewrites a part."""
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorelake.plans import measures
from scorelake.sources.keyed_table import KeyedTable


@pytest.fixture(scope="module")
def star(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 70_000).cast("string").alias("student_id"), (F.col("id") % 3).cast("string").alias("course_id"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("subject_id"), F.lit("1").alias("period_id"),
        (F.col("id") % 51 / 10).cast("decimal(5,2)").alias("score"), F.lit(Decimal("50.00")).cast("decimal(5,2)").alias("weight_percentage"))
    fact = rows.withColumn("weighted_points", (F.col("score") * 2).cast("decimal(6,3)"))
    courses = spark.createDataFrame([("0", "A", 1, 2026), ("1", "B", 1, 2026)], "course_id string, course_name string, grade_level int, academic_year int")
    subjects = spark.createDataFrame([(str(i), f"S{i}", "D1" if i < 3 else "D2") for i in range(1, 5)], "subject_id string, subject_name string, department string")
    numbers = measures.number_students(rows.select("student_id").distinct())
    return fact, courses, subjects, measures.fact_slices(fact, numbers).cache()


def plain(star, by):
    """Distinct students by counting them, for all grades and for passed final grades."""
    fact, courses, subjects, _ = star
    final = fact.groupBy("student_id", "course_id", "subject_id", "period_id").agg(F.round(F.sum("weighted_points"), 2).alias("final"))
    seen = measures.with_dimensions(fact, courses, subjects).groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("student_id").alias("s"))
    done = measures.with_dimensions(final, courses, subjects).groupBy(*by).agg(F.count_distinct(F.when(F.col("final") >= 3, F.col("student_id"))).alias("a"))
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("-")).alias(k) for k in by]
    a = {tuple(r[k] for k in by): (r["n"], r["s"]) for r in seen.select(*keys, "n", "s").collect()}
    b = {tuple(r[k] for k in by): r["a"] for r in done.select(*keys, "a").collect()}
    return {k: (*v, b[k]) for k, v in a.items()}


@pytest.mark.parametrize("by", [["course_id"], ["grade_level", "department"], ["subject_id"], []])
def test_bitmaps_count_students_of_several_buckets(star, by):
    _, courses, subjects, slices = star
    got = measures.measure(slices, courses, subjects, by).collect()
    shown = lambda r: tuple("-" if r[k] is None else str(r[k]) for k in by)
    assert {shown(r): (r["total_grades"], r["students_evaluated"], r["students_approved"]) for r in got} == plain(star, by)
    assert slices.select("bucket").distinct().count() == 3


def test_sets_agree_with_single_slicers(star):
    _, courses, subjects, slices = star
    sets = {"c": ["course_id"], "ld": ["grade_level", "department"], "all": []}
    together = measures.measure_sets(slices, courses, subjects, sets).collect()
    for name, by in sets.items():
        alone = measures.measure(slices, courses, subjects, by)
        cells = [*by, *[c for c in alone.columns if c not in by]]
        assert sorted(repr([r[c] for c in cells]) for r in together if r["slicer"] == name) == sorted(repr([r[c] for c in cells]) for r in alone.collect())


def test_where_and_empty(star):
    _, courses, subjects, slices = star
    none = measures.measure(slices, courses, subjects, [], F.col("department") == "D9").first()
    assert (none["total_grades"], none["students_evaluated"], none["average_score"], none["pass_rate"], none["fail_rate"]) == (0, 0, None, 0.0, 1.0)
    assert measures.measure(slices, courses, subjects, ["course_id"], F.col("department") == "D9").count() == 0


def test_few_exchanges_without_broadcasts(spark, star):
    fact, courses, subjects, _ = star
    numbers = measures.number_students(fact.select("student_id").distinct())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = measures.fact_slices(fact.repartition(2), numbers)
        plans = [made, measures.measure_sets(spark.createDataFrame([], made.schema), courses, subjects, {"c": ["course_id"], "d": ["department"]})]
        counts = [len(re.findall(r"Exchange hash", p._jdf.queryExecution().executedPlan().toString())) for p in plans]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(counts) <= 11


def test_load_writes_only_its_ranges(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), ["k"], ranges=16)
    with pytest.raises(ValueError):
        stored.read()
    first, second, third = (F.lit(f"2026-0{i}-01").cast("date") for i in (1, 2, 3))
    rows = spark.range(10_000).select(F.format_string("g-%06d", "id").alias("k"), F.lit("old").alias("v"))
    assert len(stored.load(rows, first)) == 16
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*.parquet") if "_log" not in str(p)}
    few = spark.createDataFrame([(f"g-{i:06d}", "new") for i in range(9_950, 10_050)] + [("a", "new")], "k string, v string")
    assert len(stored.load(few, second)) <= 3
    assert {p: p.stat().st_mtime_ns for p in untouched} == untouched
    got = {r["k"]: (r["v"], str(r["created_at"])[:7], str(r["updated_at"])[:7]) for r in stored.read().collect()}
    assert len(got) == 10_051 and got["g-000001"] == ("old", "2026-01", "2026-01")
    assert got["g-009960"] == ("new", "2026-01", "2026-02") and got["g-010001"] == got["a"] == ("new", "2026-02", "2026-02")
    assert len(stored.sweep()) >= 1 and stored.sweep() is not None and stored.read().count() == 10_051
    stored.load(rows.limit(0), third)
    assert stored.read().count() == 10_051
    fresh = KeyedTable(spark, str(tmp_path / "other"), ["k"])
    fresh.load(rows.limit(0), first)
    assert fresh.load(few, second) and fresh.read().count() == 101


def test_failed_load_leaves_the_table(spark, tmp_path, monkeypatch):
    stored = KeyedTable(spark, str(tmp_path / "t"), ["k"], ranges=4)
    now = F.lit("2026-01-01").cast("date")
    stored.load(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")), now)
    broken = spark.range(5).select(F.col("id").alias("k"), F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        stored.load(broken, now)
    assert stored.read().agg(F.sum("v"), F.count("*")).first()[:] == (100, 100)
