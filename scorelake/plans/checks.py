"""Data-quality assertions. Each gives (check_name, subject, violations)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.numbers import weighted_points
from scorelake.operators.duplicates import duplicate_keys
from scorelake.operators.group_sums import off_target
from scorelake.operators.references import orphans
from scorelake.operators.skew import null_safe
from scorelake.sources.writers import row_audit


def _one(df: DataFrame, check: str, subject: str, violations: Column) -> DataFrame:
    return df.agg(violations.alias("violations")).select(F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), "violations")


def _wide(df: DataFrame, check: str, cells: dict[str, Column]) -> DataFrame:
    """Several counts in one pass over the frame, one output row each."""
    rows = [F.struct(F.lit(check).alias("check_name"), F.lit(s).alias("subject"), F.count_if(c).alias("violations")) for s, c in cells.items()]
    return df.agg(F.array(*rows).alias("x")).select(F.inline("x"))


def check_unique(df: DataFrame, keys: list[str], subject: str) -> DataFrame:
    return _one(duplicate_keys(df, keys), "unique", subject, F.count(F.lit(1)))


def check_not_null(df: DataFrame, columns: list[str], subject: str) -> DataFrame:
    return _wide(df, "not_null", {f"{subject}.{c}": F.col(c).isNull() for c in columns})


def check_range(df: DataFrame, ranges: dict[str, tuple], subject: str) -> DataFrame:
    """Values outside [low, high] per column; NULL is not a violation."""
    cells = {f"{subject}.{c}": (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)) for c, (lo, hi) in ranges.items()}
    return _wide(df, "range", cells)


def check_reference(child: DataFrame, key: str, parent: DataFrame, parent_key: str, subject: str) -> DataFrame:
    return _one(orphans(child, key, parent, parent_key), "reference", subject, F.count(F.lit(1)))


def check_not_empty(tables: dict[str, DataFrame]) -> DataFrame:
    empty = (F.col("row_count") == 0).cast("bigint")
    return row_audit(tables).select(F.lit("not_empty").alias("check_name"), F.col("table_name").alias("subject"), empty.alias("violations"))


def check_weights(df: DataFrame, keys: list[str], weight: str, subject: str, tolerance: float = 0.5) -> DataFrame:
    """Groups whose weights are ``tolerance`` or more away from 100."""
    sums = df.groupBy(*keys).agg(F.sum(weight).alias("total"))
    return _one(sums.filter(off_target(F.col("total"), 100, tolerance, at_edge=True)), "weights", subject, F.count(F.lit(1)))


def check_recompute(fact: DataFrame, final: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Final grades that differ from their recomputation from the fact."""
    keys = ["student_id", "subject_id", "period_id"]
    again = fact.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.round(F.sum(F.col("score") * F.col("weight_percentage") / 100), 2).alias("_again")
    )
    joined = final.join(again, null_safe([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys]))
    off = joined.filter(F.abs(F.col("final_grade") - F.col("_again")) > F.lit(tolerance).cast("decimal(9,4)"))
    return _one(off, "recompute", "final_grade", F.count(F.lit(1)))


def check_rates(df: DataFrame, passed: str, failed: str, subject: str, tolerance: float = 0.05) -> DataFrame:
    gap = F.abs(F.col(passed) + F.col(failed) - 100)
    return _wide(df, "rates", {subject: gap >= F.lit(tolerance).cast("decimal(9,4)")})


def check_reasons(errors: DataFrame, subject: str) -> DataFrame:
    return _wide(errors, "has_reason", {subject: F.col("error_reason").isNull() | (F.trim("error_reason") == "")})


def check_manifest(manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected files that the manifest does not list."""
    missing = expected.select("file").subtract(manifest.select("file"))
    return _one(missing, "manifest", "files", F.count(F.lit(1)))


def check_seeded(expected: DataFrame, found: DataFrame, subject: str) -> DataFrame:
    """Ids seeded but not found, or found but not seeded."""
    gaps = expected.subtract(found).unionByName(found.subtract(expected))
    return _one(gaps, "seeded", subject, F.count(F.lit(1)))


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
