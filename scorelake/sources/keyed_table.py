"""A stored table kept in ranges of its key, of which a load rewrites only those it touches."""
from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scorelake.operators.upserts import first_load, upsert
from scorelake.sources.checkpoint import discard, materialize

RANGES = 64
BUCKET = "_range"


class KeyedTable:
    """A table under ``home`` that is loaded again and again by its key.

    The first load cuts the key (its first column) into ranges of about equal size. A later load joins and writes only the
    ranges that its keys fall into; one appended log row then names, for every range, the folder that
    holds it, so that readers see the table before the load or after it, never between.
    """

    def __init__(self, spark: SparkSession, home: str, keys: list[str], ranges: int = RANGES):
        self.spark, self.home, self.keys, self.ranges = spark, home.rstrip("/"), keys, ranges

    def _current(self) -> Row | None:
        try:
            log = self.spark.read.parquet(f"{self.home}/_log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return log.orderBy(F.col("version").desc()).first()

    def _bounds(self, start: int) -> list:
        return [r["low"] for r in self.spark.read.parquet(f"{self.home}/_bounds-{start}").orderBy("low").collect()]

    def _bucket(self, bounds: list) -> Column:
        """Number of the range: how many lower bounds are not above the key."""
        if not bounds:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(self.keys[0])))

    def _open(self, parts: dict[int, str], some: list[int] | None = None) -> DataFrame:
        paths = [f"{folder}/{BUCKET}={b}" for b, folder in sorted(parts.items()) if some is None or b in some]
        return self.spark.read.parquet(*paths)

    def read(self) -> DataFrame:
        current = self._current()
        if current is None:
            raise ValueError(f"nothing was loaded into {self.home}")
        return self._open(current["parts"])

    def load(self, source: DataFrame, now: Column) -> list[int]:
        """Upserts a source of unique, non-null keys; returns the ranges that were written."""
        current = self._current()
        version = time.time_ns()
        folder = f"{self.home}/v-{version}-{uuid.uuid4().hex[:8]}"
        start, parts = (current["start"], dict(current["parts"])) if current else (version, {})
        if current is None:
            slices = source.select(self.keys[0]).repartitionByRange(self.ranges, self.keys[0]).select(F.col(self.keys[0]).alias("key"), F.spark_partition_id().alias("slice"))
            slices.groupBy("slice").agg(F.min("key").alias("low")).select("low").coalesce(1).write.parquet(f"{self.home}/_bounds-{version}")
        bounds = self._bounds(start)
        placed = materialize(source.withColumn(BUCKET, self._bucket(bounds)), "load")
        touched = [r[BUCKET] for r in placed.select(BUCKET).distinct().orderBy(BUCKET).collect()]
        fresh = placed.drop(BUCKET)
        known = [b for b in touched if b in parts]
        rows = upsert(self._open(parts, known), fresh, self.keys, now) if known else first_load(fresh, now)
        # Ranges of a few files each: a large one is split, small files are joined.
        rows.withColumn(BUCKET, self._bucket(bounds)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{folder}")
        parts |= dict.fromkeys(touched, folder)
        entry = self.spark.createDataFrame([(version, start, parts)], "version bigint, start bigint, parts map<int, string>")
        entry.coalesce(1).write.mode("append").parquet(f"{self.home}/_log")
        return touched

    def sweep(self) -> list[str]:
        """Deletes what no range of the current version lies in; for when no load and no reader of an old version runs."""
        current = self._current()
        if current is None:
            return []
        held = self.spark.read.parquet(f"{self.home}/_log").select(F.explode("parts").alias("part", "folder")).distinct().collect()
        old = [f"{r['folder']}/{BUCKET}={r['part']}" for r in held if current["parts"].get(r["part"]) != r["folder"]]
        for path in old:
            discard(self.spark, path)
        return old
