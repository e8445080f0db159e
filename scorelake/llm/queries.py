"""The registered queries of this package: each operator over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, html_extract, line_runs, lm, mixing, prefix_trie, quality_model, quality_rules, ranked_search, repeats, simhash, token_store, url_filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Hosts with such a word as a name part have their URLs listed.
LISTED_HOSTS = r"(^|[.-])(adult|bets|casino|spam)([.-]|$)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_digest(table(spark, sf_dir, "documents"), tokenizer_path()).drop("shard")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"), F.round("position_2", 6).alias("position_2"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.select("url").filter(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS))
    return url_filter.filter_urls(pages, listed, RULES)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), order=3)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def quality_training(docs: DataFrame, labels: DataFrame, label: str = "label_") -> DataFrame:
    """Labelled documents outside the held-out third, their mark in the column `label`, which `docs`
    must not have; labels of one id count once."""
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias(label))
    return docs.join(marks, docs["doc_id"] == marks["doc_id"]).select(*[docs[c] for c in docs.columns], label).filter(~held_out())


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(quality_training(docs, table(spark, sf_dir, "labels")), "label_")
    scored = quality_model.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_store, op2_curriculum_mix, op3_html_text, op4_url_filter, op5_lm_score, op6_decontaminate,
        op7_simhash, op8_repeated_bytes, op9_quality_rules, op10_quality_model,
        op11_ranked_search, op12_line_runs, op13_prefix_trie)
}
