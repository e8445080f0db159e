"""References between tables: presence flags, semi and anti joins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.operators.skew import group_left_join


def is_empty(df: DataFrame) -> Column:
    """Scalar subquery: true when the frame has no row (reads one at most)."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("_empty")).scalar()


def mark_present(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, out: str = "_present",
    settle: Callable[..., tuple[DataFrame, bool]] | None = None,
) -> DataFrame:
    """Adds a BOOLEAN: does ``key`` occur among the parent's keys? ``settle`` stores those before the join and says if
    they are few."""
    known = parent.select(F.col(parent_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    known, few = settle(known) if settle else (known, False)
    marked = group_left_join(df, known.withColumn(out, F.lit(True)), [key], few)
    return marked.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.filter(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_parent_key"), "left_anti")


def having_parent(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None, settle: Callable[..., tuple[DataFrame, bool]] | None = None,
) -> DataFrame:
    """Child rows whose key has a parent; also the cascade after parents go. ``settle`` stores the parents' keys before
    the join and says if they are few."""
    keys = parent.select(F.col(parent_key or key).alias("_parent_key"))
    if settle:
        keys, few = settle(keys.distinct())
        keys = F.broadcast(keys) if few else keys
    return child.join(keys, F.col(key) == F.col("_parent_key"), "left_semi")


def missing_keys(required: DataFrame, present: DataFrame) -> DataFrame:
    """Set difference of two one-column frames of the same column name."""
    return required.subtract(present)


def same_set(a: DataFrame, b: DataFrame) -> Column:
    """Scalar subquery expression: both frames hold the same distinct rows."""
    return is_empty(a.subtract(b)) & is_empty(b.subtract(a))
