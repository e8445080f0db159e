"""Joining per-group facts back to rows when one group may be huge."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def group_left_join(rows: DataFrame, groups: DataFrame, on: list[str], broadcast: bool = False) -> DataFrame:
    """rows LEFT JOIN groups on null-safe keys; groups has one row per key.

    Both sides enter the join straight from a shuffle on the plain keys. Where a key holds
    a third of all rows, the adaptive skew join cuts the row side of its partition into
    pieces and gives each the one row of its group; no other key pays for it. ``broadcast``
    is for groups of a size bounded by type, or stored and counted.
    """
    payload = [c for c in groups.columns if c not in on]
    small = groups.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(on)], *payload)
    cond = null_safe([F.col(c) for c in on], [F.col(f"_key_{i}") for i in range(len(on))])
    return rows.join(F.broadcast(small) if broadcast else small, cond, "left").select(*rows.columns, *payload)
