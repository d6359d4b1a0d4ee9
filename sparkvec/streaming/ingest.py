"""Incremental form of the embedding job: new document files become store rows.

``embed_stream`` writes files. The file sink keeps its own commit log, so every document
is embedded exactly once across restarts. Chunk ids are made of document id and chunk
number, which needs no state and no look at earlier rows, and holds for document ids below
2^43. ``embed_stream_into`` appends to a store, whose ids run on from its largest, for document
ids of any size; the store remembers the batch with the change that shows its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkvec.functions import text as tx
from sparkvec.operators.chunking import CHUNK_SIZE, OVERLAP
from sparkvec.operators.encoding import BATCH_SIZE, EncoderFactory
from sparkvec.plans.embed import embed_documents, embed_table, packed_id
from sparkvec.sources.store import already_appended

DOCUMENT_SCHEMA = "doc_id long, text string"


def document_stream(
    spark: SparkSession,
    path: str,
    *,
    schema: str = DOCUMENT_SCHEMA,
    source_format: str = "parquet",
    files: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New document files of a folder; ``files`` is a glob on their names. ``path`` may be a glob itself,
    of files or of folders of files."""
    reader = spark.readStream.schema(schema).format(source_format)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("doc_id", "text")


def _rejected(docs: DataFrame) -> DataFrame:
    """The documents that cannot be embedded, with the reason."""
    text = F.col("text")
    reason = F.when(text.isNull(), F.lit("not a string")).otherwise(F.lit("empty"))
    return docs.filter(text.isNull() | tx.is_blank(text)).select("doc_id", "text", reason.alias("reason"))


def reject_stream(
    docs: DataFrame, *, output_path: str, checkpoint_path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the documents that cannot be embedded: ``doc_id``, ``text`` and the ``reason``."""
    return (
        _rejected(docs)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def embed_stream(
    docs: DataFrame,
    encoder_factory: EncoderFactory,
    *,
    output_path: str,
    checkpoint_path: str,
    rejects_path: str | None = None,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query; by default it works off what is there and stops.

    Blank documents have nothing to embed. A stream cannot reject the whole
    input, so they go to ``rejects_path`` with the reason (by default a folder
    beside the output), in a stream of their own that stops first. All paths
    must be on shared storage.
    """
    trigger = trigger or {"availableNow": True}
    rejects = reject_stream(
        docs,
        output_path=rejects_path or f"{output_path.rstrip('/')}-rejects",
        checkpoint_path=f"{checkpoint_path.rstrip('/')}-rejects",
        trigger=trigger,
    )
    if "availableNow" in trigger or "once" in trigger:
        rejects.awaitTermination()
    rows = embed_documents(
        docs.filter(~tx.is_blank(F.col("text"))),
        encoder_factory,
        chunk_size=chunk_size,
        overlap=overlap,
        batch_size=batch_size,
        global_index=False,
        rebalance=False,
    )
    now = F.current_timestamp()
    stored = rows.select(
        packed_id(F.col("doc_id"), F.col("chunk_no")).alias("id"),
        "document_text",
        "metadata",
        "embedding",
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return (
        stored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
        .start()
    )


def embed_stream_into(
    docs: DataFrame,
    table: str,
    encoder_factory: EncoderFactory,
    *,
    checkpoint_path: str,
    rejects_path: str,
    name: str | None = None,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append each batch of documents to a store, as one slice and exactly once.

    A batch that failed before its change of the catalog leaves no row and is done again; one
    that failed after it is known by its number and skipped. ``name`` tells streams into one
    table apart (by default the checkpoint's path); a stream that starts over with a new
    checkpoint needs a new name. Documents with null ids stop the stream. Blank ones go to
    ``rejects_path``, in a folder per batch.
    """
    source = name or checkpoint_path.rstrip("/")

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if already_appended(spark, table, (source, number)):
            return
        _rejected(batch).write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/batch={number}")
        good = batch.filter(~tx.is_blank(F.col("text")))
        if good.isEmpty():
            return
        embed_table(
            spark,
            good,
            table,
            encoder_factory,
            chunk_size=chunk_size,
            overlap=overlap,
            batch_size=batch_size,
            once=(source, number),
        )

    return (
        docs.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
