"""Cutting lineage by writing a frame to the shared checkpoint folder."""
from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: Session setting that names the folder of the open `scratch` block, if any.
SCRATCH = "scorelake.scratch"
#: Spark's own setting for dropping shuffle files at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Compression of whole tables that are stored: about half the bytes of Spark's default, at little more time.
COMPACT = "zstd"
#: Up to so many groups are joined by broadcast once they are stored and counted.
FEW_GROUPS = 100_000
#: The same of bare 64-bit hashes.
FEW_HASHES = 1_000_000
_local_roots: dict[str, str] = {}
_freeing: dict[str, tuple[int, str | None]] = {}  # by application: open blocks, the setting before the first
_freeing_lock = threading.Lock()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the session names; only a local session without one gets its own, gone at exit."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="scorelake-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def materialize(df: DataFrame, name: str = "frame", codec: str | None = None) -> DataFrame:
    """Writes the frame as Parquet and reads it back: columnar, and safe from
    executor loss because nothing upstream is ever run again."""
    return _stored(df, _new_path(df.sparkSession, name), codec)


def _new_path(spark: SparkSession, name: str) -> str:
    folder = spark.conf.get(SCRATCH, None) or f"{checkpoint_root(spark)}/scorelake"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, path: str, codec: str | None) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Frames that a longer job stores on its way, deleted when nothing reads them any more.

    A job of several joins holds the shuffle files of all of them until its end; cut into steps, those of one
    join at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: list[str] = []
        self.shuffled = False  # a join since the last frame has groups that are not few

    def store(self, df: DataFrame, name: str = "step") -> DataFrame:
        path = _new_path(self.spark, name)
        self._paths.append(path)
        return _stored(df, path, COMPACT)

    def next(self, df: DataFrame, name: str = "step") -> DataFrame:
        """Stores the frame and deletes all frames before it."""
        earlier, self._paths, self.shuffled = self._paths, [], False
        try:
            return self.store(df, name)
        finally:
            self._drop(earlier)

    def groups(self, df: DataFrame, most: int | None = None) -> tuple[DataFrame, bool]:
        """The frame as stored, and whether it is counted to have few rows."""
        counted = Observation()
        stored = self.store(df.observe(counted, F.count(F.lit(1)).alias("rows")), "groups")
        few = counted.get["rows"] <= (FEW_GROUPS if most is None else most)
        self.shuffled = self.shuffled or not few
        return stored, few

    def clear(self) -> None:
        earlier, self._paths = self._paths, []
        self._drop(earlier)

    def _drop(self, paths: list[str]) -> None:
        for path in paths:
            discard(self.spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of a job begun inside the block once the job has ended, instead of when the
    driver happens to collect its garbage: a stored frame needs them no more.

    The setting is the session's: of blocks open at the same time the first sets it and the last puts it back.
    """
    app = spark.conf.get("spark.app.id", "local")
    with _freeing_lock:
        depth, before = _freeing.get(app) or (0, spark.conf.get(CLEANUP, None))
        _freeing[app] = (depth + 1, before)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            depth, before = _freeing[app]
            if depth > 1:
                _freeing[app] = (depth - 1, before)
            else:
                del _freeing[app]
                spark.conf.set(CLEANUP, before or "false")


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system holds it; one that is gone already is fine."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Frames materialized inside the block are deleted at its end, failed or not.

    What leaves the block must be stored elsewhere. Blocks nest; the session is the
    scope, so threads that submit jobs of the block write to its folder too.
    """
    before = spark.conf.get(SCRATCH, None)
    folder = f"{checkpoint_root(spark)}/scorelake/scratch-{uuid.uuid4().hex}"
    spark.conf.set(SCRATCH, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(SCRATCH)
        else:
            spark.conf.set(SCRATCH, before)
        discard(spark, folder)
