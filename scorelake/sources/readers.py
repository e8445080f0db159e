"""Reading text tables and named sets of tables."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.functions.text import named

# Cell texts a CSV reader takes for a missing value.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

ORDINAL = "_ord"


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def _missing_path(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def empty_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_text_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, ordinal: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column text. A missing file is an empty table,
    missing columns are NULL, and missing-value words become NULL.

    ``ordinal`` adds ``_ord``, the place of the row in its file, computed in
    the scan so that it stays the same when a task is run again.
    ``multi_line`` is needed for line breaks inside cells and stops files from
    being split.
    """
    try:
        raw = _csv(spark, multi_line).csv(path)
    except AnalysisException as e:
        if not _missing_path(e):
            raise
        raw = empty_table(spark, columns or [])
        return raw.withColumn(ORDINAL, F.lit(None).cast("struct<file:string,block:bigint,row:bigint>")) if ordinal else raw
    names = columns or raw.columns
    cells = [
        (F.when(~named(c).isin(MISSING_CELLS), named(c)) if c in raw.columns else F.lit(None).cast("string")).alias(c)
        for c in names
    ]
    if ordinal:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        cells.append(place.alias(ORDINAL))
    return raw.select(*cells)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer tasks than cores (one row group, one small file) dealt out to all of them before
    costly expressions run on it; any other frame as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if 2 * df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_parquet_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with ``_ord``, their file and index in it."""
    df = spark.read.parquet(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return df.select("*", place.alias(ORDINAL))


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with column types inferred from the cells (one more pass)."""
    return _csv(spark, False).option("inferSchema", True).csv(path)


def read_workbook(spark: SparkSession, folder: str, ordinal: bool = False) -> dict[str, DataFrame]:
    """A folder as a set of tables: one per CSV or Parquet child, named after it.

    Only distinct child names reach the driver; file contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    tail = F.element_at(F.split("path", f"/{folder.rstrip('/').split('/')[-1]}/"), -1)
    names = [r[0] for r in files.select(F.split_part(tail, F.lit("/"), F.lit(1))).distinct().collect()]
    tables = {}
    for child in sorted(names):
        stem, _, kind = child.rpartition(".")
        path = f"{folder.rstrip('/')}/{child}"
        if kind == "csv":
            tables[stem] = read_text_table(spark, path, ordinal=ordinal)
        elif kind == "parquet":
            tables[stem] = read_parquet_ordered(spark, path) if ordinal else spark.read.parquet(path)
    return tables
