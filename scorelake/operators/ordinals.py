"""Global row numbers, running totals and exact quantiles without one big task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.sources.checkpoint import materialize


def _shifts(sums: DataFrame) -> DataFrame:
    """Total of the earlier slices per slice. One row per sort task, so its size
    is bounded by spark.sql.shuffle.partitions."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(F.col("_slice").alias("_shift_slice"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))


def running_total(df: DataFrame, order: list, weight: Column, out: str) -> DataFrame:
    """Adds the total of ``weight`` over the rows before this one in ``order``.

    The rows are range-sorted once and written down, which fixes each row's
    slice; slices are then summed in parallel and shifted by the total of the
    slices before them (one row per slice). ``order`` should be unique.
    """
    placed = F.shiftright(F.monotonically_increasing_id(), 33).cast("int")
    weighted = df.withColumn("_w", weight.cast("bigint"))
    ranged = materialize(weighted.orderBy(*order).withColumn("_slice", placed))
    sums = ranged.groupBy("_slice").agg(F.sum("_w").alias("_sum"))
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    joined = local.join(F.broadcast(_shifts(sums)), F.col("_slice") == F.col("_shift_slice"))
    return joined.withColumn(out, F.col("_shift") + F.col("_local")).select(*df.columns, out)


def number_rows(df: DataFrame, order: list, out: str) -> DataFrame:
    """Adds 1, 2, 3 ... in ``order`` over the whole frame.

    One range sort, stored with each row's slice and its place in it; only the
    slice sizes are shuffled after that.
    """
    ranged = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    placed = ranged.withColumn("_slice", F.shiftright("_id", 33).cast("int"))
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_sum"))
    nth = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.join(F.broadcast(_shifts(sizes)), F.col("_slice") == F.col("_shift_slice"))
    return joined.withColumn(out, F.col("_shift") + nth + 1).select(*df.columns, out)


def sequence_id(df: DataFrame, order: list, key: str, pattern: str = "G-%06d") -> DataFrame:
    """Replaces ``key`` by the formatted row number."""
    numbered = number_rows(df, order, "_n")
    return numbered.withColumn(key, F.format_string(pattern, F.col("_n"))).drop("_n")


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float]) -> DataFrame:
    """(probability, quantile) rows, linear between neighbours, NULLs ignored.

    Values are counted first, so the sort handles distinct values only.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, [F.col("_v")], F.col("_n"), "_before")
    total = placed.agg(F.sum("_n")).scalar()
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    spot = F.col("probability") * (F.col("_total") - 1)
    last = F.col("_before") + F.col("_n") - 1
    near = (
        placed.withColumn("_total", total)
        .select("_v", "_n", "_before", "_total", wanted)
        .filter((F.floor(spot) <= last) & (F.ceil(spot) >= F.col("_before")))
    )
    return near.groupBy("probability").agg(
        (F.min("_v") + (F.max("_v") - F.min("_v")) * (F.max(spot) - F.floor(F.max(spot)))).alias("quantile")
    )
