"""Statistics over a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.operators.encoding import EncoderFactory
from sparkvec.sources.store import resolve_store, store_metric

FIELD_LIMIT = 10_000


def metadata_fields(store: DataFrame | str, sample_rows: int | None = None) -> DataFrame:
    """Distinct top-level metadata keys, sorted; rows without a JSON object are skipped.

    All rows are read unless ``sample_rows`` asks for fewer.
    """
    df, _ = resolve_store(store)
    rows = df.select("metadata").filter(F.col("metadata").isNotNull())
    if sample_rows is not None:
        rows = rows.limit(sample_rows)
    keys = F.json_object_keys("metadata")  # NULL, hence no row, unless it is a JSON object
    return rows.select(F.explode(keys).alias("field")).distinct().orderBy("field")


def _fields(store: DataFrame, limit: int) -> list[Column]:
    """The number of keys, and the sorted keys as one array, or NULL if there are more than ``limit``.

    Both are subqueries over one shuffle of distinct keys, which Spark reuses.
    """
    fields = metadata_fields(store)
    some = fields.limit(limit + 1).agg(F.array_sort(F.collect_list("field")).alias("all"))
    listed = some.select(F.when(F.size("all") <= limit, F.col("all")))
    number = fields.agg(F.count(F.lit(1)))
    return [number.scalar().alias("metadata_field_count"), listed.scalar().alias("metadata_fields")]


def search_statistics(
    store: DataFrame | str, *, table_config: str | None = None, field_limit: int = FIELD_LIMIT
) -> DataFrame:
    """One row: count, mean text length, oldest and newest row, metadata keys, metric name.

    More than ``field_limit`` keys are counted but not listed in this one row (NULL):
    :func:`metadata_fields` has them as rows. An empty store gives 0, 0, NULL, NULL. The metric is ``unknown`` for a
    DataFrame without a table behind it.
    """
    known = table_config or (store_metric(store) if isinstance(store, str) else None)
    df, _ = resolve_store(store)
    return df.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.coalesce(F.avg(F.length("document_text")), F.lit(0.0)).alias("avg_text_length"),
        F.min("created_at").alias("oldest_document"),
        F.max("created_at").alias("newest_document"),
    ).select(
        "*",
        *_fields(df, field_limit),
        F.lit(known or "unknown").alias("table_config"),
    )


def rag_statistics(
    store: DataFrame | str,
    *,
    table: str | None = None,
    encoder_factory: EncoderFactory | None = None,
    embedding_model: str | None = None,
    table_config: str | None = None,
) -> DataFrame:
    """Search statistics together with the encoder's name and dimension."""
    dimension = encoder_factory().dimension if encoder_factory else None
    stats = search_statistics(store, table_config=table_config)
    return stats.select(
        F.lit(table or (store if isinstance(store, str) else None)).cast("string").alias("table"),
        "total_documents",
        F.col("avg_text_length").alias("avg_document_length"),
        "metadata_field_count",
        "metadata_fields",
        F.col("table_config").alias("distance_metric"),
        F.lit(embedding_model).cast("string").alias("embedding_model"),
        F.lit(dimension).cast("int").alias("embedding_dimension"),
    )
