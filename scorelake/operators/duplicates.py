"""Duplicate handling. ``order`` names columns that together order all rows."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.operators.skew import group_left_join
from scorelake.sources.checkpoint import FEW_HASHES


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in ``order``.

    Filtering row_number to 1 lets Spark drop all but the first row of every
    key before the shuffle, so a hot key sends one row per map task. The hash
    in front of the keys makes that sort compare one BIGINT for most pairs.
    """
    w = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _repeated_keys(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    counted = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.count(F.lit(1)).alias("_copies"), *aggs)
    return counted.filter("_copies > 1").drop("_copies", "_hash")


def flag_duplicates(
    df: DataFrame, keys: list[str], order: list[str], where: Column | None = None, out: str = "_duplicate",
    settle: Callable[..., tuple[DataFrame, bool]] | None = None,
) -> DataFrame:
    """Adds a BOOLEAN: true on every copy but the first; NULL keys are equal.

    Only keys met more than once come back to the rows, through a join;
    no window ever holds a whole group. With ``where``, other rows neither
    count nor get flagged. ``settle`` stores the repeated keys before the join and says if they are few;
    their hashes alone are counted first, so that keys met once are seldom shuffled as a whole.
    """
    place = F.struct(*[F.col(c) for c in order])
    seen = df if where is None else df.filter(where)
    if settle:
        hashes, few = settle(seen.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h"), FEW_HASHES)
        if few:
            seen = seen.withColumn("_h", F.xxhash64(*keys)).join(F.broadcast(hashes), "_h", "left_semi").drop("_h")
    first = _repeated_keys(seen, keys, F.min(place).alias("_first"))
    first, few = settle(first) if settle else (first, False)
    marked = group_left_join(df, first, keys, few)
    late = F.coalesce(place > F.col("_first"), F.lit(False))
    return marked.withColumn(out, late if where is None else late & F.coalesce(where, F.lit(False))).drop("_first")


def all_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once, first ones included."""
    many = _repeated_keys(df, keys).withColumn("_many", F.lit(True))
    return group_left_join(df, many, keys).filter("_many").drop("_many")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys met more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
