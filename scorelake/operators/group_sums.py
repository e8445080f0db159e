"""Group totals judged against a target and brought back to the rows."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.operators.skew import group_left_join


def off_target(
    total: Column, target: float, tolerance: float, alternative: tuple[float, float] | None = None, at_edge: bool = False
) -> Column:
    """True when the total is outside every accepted band; ``at_edge``: or on the first one's edge."""
    gap, width = F.abs(total - F.lit(target).cast("decimal(18,6)")), F.lit(tolerance).cast("decimal(18,6)")
    off = gap >= width if at_edge else gap > width
    if alternative:
        centre, width = alternative
        off = off & (F.abs(total - F.lit(centre).cast("decimal(18,6)")) > F.lit(width).cast("decimal(18,6)"))
    return off


def group_totals(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Sum and deviation from 100 per group."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total")).withColumn("deviation", F.col("total") - F.lit(100))


def flag_group_sum(
    df: DataFrame,
    keys: list[str],
    value: Column,
    where: Column | None = None,
    target: float = 100,
    tolerance: float = 0.5,
    alternative: tuple[float, float] | None = (1.0, 0.01),
    null_keys: str = "skip",
    out: str = "_bad_total",
    settle: Callable[..., tuple[DataFrame, bool]] | None = None,
) -> DataFrame:
    """Adds the group's total on rows of groups that miss the target, else NULL.

    ``where`` limits both the rows summed and the rows flagged. Rows with a
    NULL key are never judged ("skip") or form a group of their own ("group"). ``settle`` stores the
    totals before the join and says if they are few.
    """
    judged = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if null_keys == "skip":
        for k in keys:
            judged = judged & F.col(k).isNotNull()
    totals = df.filter(judged).groupBy(*keys).agg(F.sum(value).alias(out))
    bad = totals.filter(off_target(F.col(out), target, tolerance, alternative))
    bad, few = settle(bad) if settle else (bad, False)
    return group_left_join(df, bad, keys, few).withColumn(out, F.when(judged, F.col(out)))
