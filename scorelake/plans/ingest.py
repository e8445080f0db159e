"""Bringing a set of uploaded tables into the raw layer, with the record of how that was done."""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.plans.mapping import apply_proposal
from scorelake.sources.versions import LayerVersion, read_layer
from scorelake.sources.writers import file_manifest

#: Tables that the record consists of, beside the entities.
RECORD = ["_manifest", "_mapping", "_counts"]


class Ingestion(NamedTuple):
    tables: dict[str, DataFrame]  # by entity
    manifest: DataFrame  # entity, file, columns, size_bytes, sha256, row_count
    mapping: DataFrame  # entity, table_name, column_name, field
    counts: DataFrame  # table_name, entity, raw_rows, stored_rows


def mapping_rows(spark: SparkSession, mapping: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """A confirmed mapping as rows; an entity whose columns were all ignored has one without a column."""
    rows = [(e, t, c, f) for e, (t, fields) in mapping.items() for c, f in (list(fields.items()) or [(None, None)])]
    return spark.createDataFrame(rows, "entity string, table_name string, column_name string, field string")


def mapping_of(rows: DataFrame) -> dict[str, tuple[str, dict[str, str]]]:
    """The mapping that was stored, to be applied again; a few rows per entity."""
    out: dict[str, tuple[str, dict[str, str]]] = {}
    for r in rows.collect():
        fields = out.setdefault(r["entity"], (r["table_name"], {}))[1]
        if r["column_name"] is not None:
            fields[r["column_name"]] = r["field"]
    return out


def ingest(
    spark: SparkSession, tables: dict[str, DataFrame], mapping: dict[str, tuple[str, dict[str, str]]], root: str, layer: str = "ingested",
    row_counts: dict[str, int] | None = None,
) -> Ingestion:
    """Stores the canonical tables of a confirmed mapping, a manifest of their files and the mapping itself as one version.

    Readers see the last whole set until the log row of this one is written: a failure before that, between
    any two writes, leaves tables, manifest and mapping of the earlier load as they were. Rows of the stored tables
    are counted while they are written; ``row_counts``, from the proposal, says how many each upload had.
    """
    version = LayerVersion(spark, root, layer)
    stored = version.store_all(apply_proposal(tables, mapping))
    files = [f"{version.folder}/{entity}" for entity in stored]
    entity = F.element_at(F.split("at", "/"), -2)
    manifest = version.store("_manifest", file_manifest(spark, [f"{f}/*.parquet" for f in files], keep_path=True).select(
        entity.alias("entity"), "file", "columns", "size_bytes", "sha256", "row_count"))
    recorded = version.store("_mapping", mapping_rows(spark, mapping))
    at = {t: e for e, (t, _) in mapping.items()}
    raw = row_counts if row_counts is not None else {t: df.count() for t, df in tables.items()}
    counted = [(t, at.get(t), raw.get(t), version.rows.get(at.get(t))) for t in tables]
    counts = version.store("_counts", spark.createDataFrame(counted, "table_name string, entity string, raw_rows bigint, stored_rows bigint"))
    version.commit()
    return Ingestion(stored, manifest, recorded, counts)


def read_ingestion(spark: SparkSession, root: str, layer: str = "ingested") -> Ingestion | None:
    """The current tables with their record; None if nothing was ever ingested."""
    found = read_layer(spark, root, layer)
    if not found:
        return None
    manifest, mapping, counts = (found.pop(n) for n in RECORD)
    return Ingestion(found, manifest, mapping, counts)


def check_ingestion(spark: SparkSession, root: str, layer: str = "ingested") -> DataFrame:
    """Files of the current tables whose bytes or rows are no longer those of the manifest, and files that it
    does not list: (entity, file, problem), empty if the load is as it was written."""
    current = read_ingestion(spark, root, layer)
    if current is None:
        raise ValueError(f"nothing was ingested into {root}/{layer}")
    folders = [df.select(F.regexp_replace(F.first("_metadata.file_path"), "/[^/]*$", "").alias("f")).first()["f"] for df in current.tables.values() if not df.isEmpty()]
    entity = F.element_at(F.split("at", "/"), -2)
    now = file_manifest(spark, [f"{f}/*.parquet" for f in folders], keep_path=True).select(
        entity.alias("entity"), "file", F.col("sha256").alias("sha256_now"), F.col("row_count").alias("rows_now"))
    joined = current.manifest.filter("row_count > 0").join(now.filter("rows_now > 0"), ["entity", "file"], "full")
    problem = F.when(F.col("sha256_now").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(
        F.col("sha256") != F.col("sha256_now"), "changed").when(F.col("row_count") != F.col("rows_now"), "rows")
    return joined.withColumn("problem", problem).filter("problem IS NOT NULL").select("entity", "file", "problem")
