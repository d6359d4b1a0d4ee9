"""Documents as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "orc", "csv", "json", "text")


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    *,
    source_format: str = "parquet",
    text_col: str = "text",
    id_col: str | None = "doc_id",
    schema: str | None = None,
    **options: str,
) -> DataFrame:
    """Documents as ``doc_id, text`` from files.

    ``text`` files give one document per file. Without an id column the ids are
    unique and increasing within a partition, but not dense; they cost no shuffle.
    """
    if source_format not in FORMATS:
        raise ValueError(f"source_format must be one of {FORMATS}")
    defaults = {
        "csv": {"header": "true", "multiLine": "true", "escape": '"'},
        "text": {"wholetext": "true"},
    }.get(source_format, {})
    reader = spark.read.options(**{**defaults, **options})
    if schema:
        reader = reader.schema(schema)
    df = reader.format(source_format).load(path)
    text = F.col("value" if source_format == "text" else text_col).cast("string")
    has_id = id_col is not None and id_col in df.columns
    ids = F.col(id_col).cast("long") if has_id else F.monotonically_increasing_id()
    return df.select(ids.alias("doc_id"), text.alias("text"))


def documents_from_list(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A list the caller already holds, numbered from 0."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a small file input over all cores, for work that is heavy per row.

    An input that already scans in more pieces than half the cores is left as
    it is, so this never shuffles a large one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if 2 * df.rdd.getNumPartitions() <= cores else df
