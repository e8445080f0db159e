"""Line dedup over levelled sorted runs of line hashes.

DataFrame functions only. The runs are bucketed, sorted tables in the shared folder, so a
batch meets them bucket by bucket in a merge join and no run is ever shuffled again
until it is compacted.
"""
from __future__ import annotations

import math
import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.sources.checkpoint import checkpoint_root, materialize

#: Bytes stripped at both ends of a line: `[\x20\x09-\x0D]`.
WHITE = " \t\n\x0b\f\r"
#: Lines of a batch, about, and the least number of batches.
BATCH_LINES = 50_000_000
LEAST_BATCHES = 4
#: Slices that a batch is stored in; each is one sorted range of ids.
SLICES = 8
#: So many runs of a level become one run of the next.
FAN_OUT = 3


def lines_of(text: Column) -> Column:
    """The text split at newlines; null counts as empty, and an empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def line_hashes(text: Column, min_chars: int) -> Column:
    """A 64-bit hash per line of at least `min_chars` code points after stripping, else null."""
    return F.transform(lines_of(text), lambda x: F.when(F.char_length(F.btrim(x, F.lit(WHITE))) >= min_chars, F.xxhash64(line_key(x))))


class LineRuns:
    """Levelled runs of (h, n, owner): a line's hash, how many documents of the batches in the
    run hold it, and the largest id that does, set in the one run whose batch brought it first.

    Batches come in descending id order, so a line that no run has yet belongs to the new
    batch's largest holder. Level k + 1 takes the runs of level k when there are FAN_OUT of
    them; an entry is rewritten once a level.
    """

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.base = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.written = 0
        self.place = f"{checkpoint_root(spark)}/scorelake/{self.base}"
        spark.sql(f"CREATE DATABASE {self.base} LOCATION '{self.place}'")

    def _write(self, run: DataFrame) -> str:
        name, self.written = f"{self.base}.run_{self.written}", self.written + 1
        run.write.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, own: DataFrame) -> None:
        """Adds a batch's (h, n, last), one row per hash.

        A merge-anti-join with every run finds what none of them holds; the entries that one does
        hold stay beside them, as their counts are needed, so the anti-join is a left join and a mark.
        """
        rows, older = own, [F.lit(True)]
        for i, run in enumerate(self.runs()):
            rows = rows.join(self.spark.table(run).select(F.col("h").alias(f"h{i}")), F.col("h") == F.col(f"h{i}"), "left")
            older.append(F.col(f"h{i}").isNull())
        fresh = reduce(Column.__and__, older)
        rows = rows.select("h", "n", F.when(fresh, F.col("last")).alias("owner"))
        self._place(self._write(rows), 0)

    def _place(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(full := self.levels[level]) == self.fan_out:
            merged = self._write(self._merged(full))
            for old in full:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._place(merged, level + 1)

    def _merged(self, runs: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a union of bucketed scans for bucketed, which it is not.
        rows = self.spark.read.schema(self.spark.table(runs[0]).schema).parquet(*[f"{self.place}/{run.split('.')[1]}" for run in runs])
        return rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("owner").alias("owner"))

    def totals(self) -> DataFrame:
        """(h, n, owner) over everything that was added."""
        return self._merged(self.runs())

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.base} CASCADE")


def frequent_lines(hashes: DataFrame, id_col: str, min_docs: int, batch_lines: int = BATCH_LINES, fan_out: int = FAN_OUT) -> DataFrame:
    """(h, owner) of the lines of at least `min_docs` rows, from (id, body, keys) rows.

    Rows are range-sorted by descending id, ties by content, into slices that are
    stored; batches are ranges of slices. Each batch counts its lines (map-side first, so that a
    line that all rows hold costs one entry a task) and goes through the runs.
    """
    spark = hashes.sparkSession
    held = hashes.agg(F.sum(F.size("keys"))).first()[0] or 0
    batches = max(LEAST_BATCHES, math.ceil(held / batch_lines))
    ranged = hashes.repartitionByRange(batches * SLICES, F.col(id_col).desc_nulls_last(), "body")
    stored = materialize(ranged.select(id_col, F.array_distinct(F.filter("keys", lambda h: h.isNotNull())).alias("keys"), F.spark_partition_id().alias("slice")), "sliced")
    slices = (stored.agg(F.max("slice")).first()[0] or 0) + 1
    store = LineRuns(spark, fan_out)
    for b in range(batches):
        batch = stored.filter(F.col("slice").between(math.ceil(b * slices / batches), math.ceil((b + 1) * slices / batches) - 1))
        store.add(batch.select(id_col, F.explode("keys").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max(id_col).alias("last")))
    found = materialize(store.totals().filter(F.col("n") >= min_docs).select("h", "owner"), "frequent")
    store.drop()
    return found


def without_lines(lines: Column, gone: Column) -> Column:
    """The lines except those at the ascending places `gone` (from 0), as the stretches between them."""
    cuts = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    kept = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(lines, F.get(cuts, i) + 2, F.get(cuts, i + 1) - F.get(cuts, i) - 1))
    return F.array_join(F.flatten(kept), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
                batch_lines: int = BATCH_LINES, fan_out: int = FAN_OUT) -> DataFrame:
    """(id, n_lines, n_dropped, kept) per input row. A line of at least `min_chars` code points,
    told by its text stripped of ASCII white space with A-Z lower-cased, that at least
    `min_docs` rows hold, stays in the rows of the largest id that holds it and goes everywhere else.

    Lines are known by 64-bit hashes; a collision would add up two lines' counts. A
    row's text is shuffled once, by id and content; everything before moves hashes. A text and
    its lines are one row, so a text must fit a task's memory, as it must to be read at all.

    Null and empty texts have one empty line. Null ids are below all others: a line that
    only rows without an id hold stays in all of them. Repeated rows count as rows of their own and get equal
    results; rows that share the largest id all keep the line. Other columns are not read;
    an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    body = F.xxhash64("text").alias("body")
    hashes = materialize(rows.select("id", body, line_hashes(F.col("text"), min_chars).alias("keys")), "line_hashes")
    known = frequent_lines(hashes, "id", min_docs, batch_lines, fan_out)
    places = hashes.select("id", "body", F.posexplode("keys").alias("at", "h")).filter("h IS NOT NULL")
    gone = places.join(known, "h").filter("NOT (id <=> owner)").groupBy("id", "body").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    told = gone.select(F.col("id").alias("its"), F.col("body").alias("its_body"), "gone")
    joined = rows.select("id", "text", body).join(told, F.col("id").eqNullSafe(F.col("its")) & (F.col("body") == F.col("its_body")), "left")
    lines = lines_of(F.col("text"))
    return joined.select(
        F.col("id").alias(id_col), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNotNull(), without_lines(lines, F.col("gone"))).otherwise(F.coalesce("text", F.lit(""))).alias("kept"))
