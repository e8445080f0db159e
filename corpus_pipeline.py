"""A training corpus from raw documents, in five stages, each an operator of scorelake.llm.

Each stage reads what the one before it wrote. Rows are told apart by their file and their place in
it, which do not depend on how a scan is split, so null and repeated ids, and repeated rows, are handled like any
other. An empty table passes through as an empty table. Extra columns are carried along; helper columns take names that the
table does not have. A text is one value of one row and must fit a task, as the operators say.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, mixing, quality_model, queries, simhash, token_store
from scorelake.sources.checkpoint import materialize

#: Up to so many row keys (some 30 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def spare(docs: DataFrame, name: str) -> str:
    """The name, with underscores after it until no column of the table has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key each, and the key's column.

    Rows that come straight from files have their file and index there. Any other frame is stored once with a number, as a
    second run of it may be split otherwise.
    """
    row = spare(docs, "row_key")
    try:
        place = docs.metadataColumn("_metadata")
        key = F.concat_ws("-", F.hex(F.xxhash64(place["file_path"])), place["row_index"].cast("string"))
        return docs.select("*", key.alias(row)), row
    except AnalysisException:
        return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def without(docs: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """The rows whose key is not in `gone`."""
    gone = materialize(gone.select(row), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, row, "left_anti").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.5 or more."""
    labels, label, score = queries.table(spark, sf_dir, "labels"), spare(docs, "label"), spare(docs, "score")
    model = quality_model.train(queries.quality_training(docs, labels, label), label)
    return quality_model.score(docs, model, keep=docs.columns, score_col=score).filter(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: that of the smallest doc_id, ties and
    null ids by row key."""
    rows, row = numbered(docs)
    found = materialize(simhash.near_duplicates(rows, row).select(row, "component_id"), "found")
    # A group of several rows has a row besides the one it is named after.
    shared = found.filter(F.col(row) != F.col("component_id")).select("component_id").distinct()
    members = found.join(shared, "component_id", "left_semi")
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    kept = members.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(rank)["row"].alias(row))
    return without(rows, members.join(kept.select(row), row, "left_anti"), row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    rows, row = numbered(docs)
    found = decontaminate.contamination(rows, queries.table(spark, sf_dir, "benchmark"), row)
    return without(rows, found.filter("contaminated"), row)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the curriculum takes, a row each. Their order is left to the stage that
    writes them: the token store sorts by its own key, and a sort here would move all texts for nothing."""
    rows, row = numbered(docs)
    copies = mixing.training_copies(mixing.plan_mix(rows, carry=(row,)), [row]).select(row)
    return rows.join(copies, row).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row, written as shards and read back through the index: doc_id, start,
    n_tokens, ids_crc32."""
    return token_store.stored_digest(docs, queries.tokenizer_path()).drop("shard")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixture", mixture), ("tokens", tokens)]
#: SQL has no tokenizer, classifier or SimHash of this kind; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
