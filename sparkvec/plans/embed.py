"""Documents to rows of a vector store, as one lazy chain that ends in one write."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.operators.chunking import (
    CHUNK_SIZE,
    OVERLAP,
    chunk_documents,
    require_valid_documents,
)
from sparkvec.operators.encoding import BATCH_SIZE, EncoderFactory, encode_documents
from sparkvec.operators.running import with_running_offsets
from sparkvec.session import ensure_checkpoint_dir
from sparkvec.sources import store as st

PACKED_CHUNK_BITS = 20
#: Chunks of a document that stay together on their way to the encoder.
BLOCK_CHUNKS = 1024


def chunk_metadata(global_index: bool, id_col: str = "doc_id") -> Column:
    """Where a chunk came from, as JSON. Keys without a value are left out."""
    fields = [F.col(id_col).alias("doc_id")]
    if global_index:
        fields += [F.col("original_doc_index"), F.col("chunk_index")]
    fields += [F.col("chunk_no"), F.col("is_chunk"), F.col("chunk_start"), F.col("chunk_end")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


def packed_id(document: Column, chunk_no: Column) -> Column:
    """An id made of the document id and the chunk number: unique, and the same on every run."""
    limit = 1 << PACKED_CHUNK_BITS
    too_many = F.raise_error(F.lit(f"a document has more than {limit} chunks")).cast("long")
    out_of_range = F.raise_error(F.lit("document ids must be in 0..2^43-1")).cast("long")
    document = document.cast("long")
    return (
        F.when(chunk_no >= limit, too_many)
        .when((document < 0) | (document >= (1 << (63 - PACKED_CHUNK_BITS))), out_of_range)
        .otherwise(F.shiftleft(document, PACKED_CHUNK_BITS) + chunk_no)
    )


def numbered_chunks(
    docs: DataFrame,
    *,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``chunk_documents`` with its running numbers, spread evenly, in one shuffle of text.

    The numbers come from ids and lengths alone, which are checkpointed. A document's first
    number meets its chunks in blocks of ``BLOCK_CHUNKS``, so that a long document is
    spread over tasks. Null ids are an error. Ids that stand several times cannot
    be joined on: such documents are numbered where they lie, at the price of another shuffle.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    null_id = F.raise_error(F.lit(f"a document has no {id_col}")).cast("long")
    key = F.col(id_col)
    count = F.coalesce(tx.window_count(F.length(F.col(text_col)), chunk_size, overlap), F.lit(1))
    narrow = docs.select(F.when(key.isNull(), null_id).otherwise(key).alias(id_col), count.cast("long").alias("_count"))
    narrow = narrow.checkpoint()
    options = {"chunk_size": chunk_size, "overlap": overlap, "id_col": id_col, "text_col": text_col}
    if narrow.groupBy(id_col).count().filter("count > 1").head() is not None:
        return chunk_documents(docs, global_index=True, **options).repartition(id_col, "chunk_no")
    first = with_running_offsets(narrow, id_col, {"_base": F.col("_count"), "original_doc_index": F.lit(1)})
    last_block = F.floor((F.col("_count") - 1) / BLOCK_CHUNKS).cast("int")
    first = first.select(
        id_col, "_base", "original_doc_index", F.explode(F.sequence(F.lit(0), last_block)).alias("_block")
    )
    block = F.floor(F.col("chunk_no") / BLOCK_CHUNKS).cast("int")
    chunks = chunk_documents(docs, **options).withColumn("_block", block)
    # hashing the numbers neither sorts the texts nor lets an estimate broadcast them
    numbered = chunks.join(first.hint("shuffle_hash"), [id_col, "_block"])
    return numbered.withColumn("chunk_index", F.col("_base") + F.col("chunk_no")).drop("_base", "_block")


def embed_documents(
    docs: DataFrame,
    encoder_factory: EncoderFactory,
    *,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
    global_index: bool = True,
    rebalance: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Chunk and encode: store rows without timestamps, ``id`` still to be given.

    The stored text is the raw chunk; only the encoder sees it sanitized.
    ``rebalance`` spreads the chunks evenly before encoding, as documents differ
    in length and the encoder is the expensive part.
    """
    options = {"chunk_size": chunk_size, "overlap": overlap, "id_col": id_col, "text_col": text_col}
    if rebalance and global_index:
        chunks = numbered_chunks(docs, **options)
    else:
        chunks = chunk_documents(docs, global_index=global_index, **options)
        if rebalance:
            chunks = chunks.repartition(id_col, "chunk_no")
    keep = [id_col, "chunk_no"] + (["chunk_index"] if global_index else [])
    return encode_documents(
        chunks.select(
            *keep, "document_text", chunk_metadata(global_index, id_col).alias("metadata")
        ),
        encoder_factory,
        batch_size=batch_size,
    )


def embed_table(
    spark: SparkSession,
    docs: DataFrame,
    table: str,
    encoder_factory: EncoderFactory,
    *,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
    dense_ids: bool = True,
    rebalance: bool = True,
    validate_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    once: tuple[str, int] | None = None,
) -> dict:
    """Validate, chunk, encode and append documents to a store; returns the counts and the seconds it took.

    A null or blank document fails the job and nothing is appended. It is found
    while the job runs, without a pass of its own; ``validate_first`` spends
    that pass and names the smallest bad id before any encoding.

    ``dense_ids`` numbers the chunks on from the table's largest id, in document
    order; the numbering reads the texts' lengths first. Without it, ids are made of
    document id and chunk number. ``once`` is that of ``insert_embeddings``.
    """
    started = time.perf_counter()
    if validate_first:
        require_valid_documents(docs, id_col=id_col, text_col=text_col)
    text = F.col(text_col)
    invalid = F.raise_error(F.concat(F.lit(f"invalid document, null or empty: {id_col}="), F.col(id_col)))
    rows = embed_documents(
        docs.withColumn(text_col, F.when(tx.is_blank(text), invalid.cast("string")).otherwise(text)),
        encoder_factory,
        chunk_size=chunk_size,
        overlap=overlap,
        batch_size=batch_size,
        global_index=dense_ids,
        rebalance=rebalance,
        id_col=id_col,
        text_col=text_col,
    )
    if dense_ids:
        rows = rows.withColumn("id", F.lit(st.next_id(spark, table)) + F.col("chunk_index"))
    else:
        rows = rows.withColumn("id", packed_id(F.col(id_col), F.col("chunk_no")))
    whole = Observation()
    counted = rows.observe(whole, F.count_if(F.col("chunk_no") == 0).alias("documents"))
    written = st.insert_embeddings(spark, table, counted, check_ids=not dense_ids, once=once)
    if written == 0:
        raise ValueError("there are no documents")
    return {
        "documents_processed": whole.get["documents"],
        "chunks_created": written,
        "embeddings_generated": written,
        "records_inserted": written,
        "processing_time": time.perf_counter() - started,
        "errors": 0,
    }
