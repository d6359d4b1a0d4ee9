"""Documents to chunks, document validation, processing counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.operators.running import with_running_offsets

CHUNK_SIZE = 500
OVERLAP = 50


def chunk_documents(
    docs: DataFrame,
    *,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    emit_tail: bool = False,
    global_index: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per chunk of every document.

    Columns: the id column, ``chunk_no`` within the document, ``is_chunk``
    (false where the document was short enough to stay whole), ``chunk_start``
    and ``chunk_end`` (NULL for whole documents), ``document_text``; with
    ``global_index`` also ``chunk_index``, the running number over all
    documents in id order, and ``original_doc_index``, the running number of
    the document.

    A NULL text is one row with a NULL ``document_text``, so that it can be seen.

    Without ``global_index`` this is a narrow transformation: no shuffle. The
    running numbers cost one shuffle of the documents.
    """
    tx.check_window(chunk_size, overlap)
    text = F.col(text_col)
    source = docs.select(id_col, text_col)
    extra = []
    if global_index:
        chunks = F.coalesce(tx.window_count(F.length(text), chunk_size, overlap, emit_tail), F.lit(1))
        source = with_running_offsets(
            source, id_col, {"_base": chunks, "original_doc_index": F.lit(1)}
        )
        extra = ["_base", "original_doc_index"]
    step = chunk_size - overlap
    is_chunk = F.coalesce(F.length(text) > chunk_size, F.lit(False)) if chunk_size > 0 else F.lit(False)
    if chunk_size > 0:
        # a text is cut into stretches first, so that a task never holds all windows of a long one
        each = tx.windows_per_stretch(chunk_size, overlap)
        count = F.coalesce(tx.window_count(F.length(text), chunk_size, overlap, emit_tail), F.lit(1))
        pieces = source.select(
            id_col,
            *extra,
            is_chunk.alias("is_chunk"),
            count.alias("_count"),
            F.posexplode(tx.stretches(text, chunk_size, overlap)).alias("_stretch", "_text"),
        )
        first = F.col("_stretch") * F.lit(each)
        left = F.least(F.col("_count") - first, F.lit(each))
        windows = F.when(F.col("is_chunk"), tx.first_windows(F.col("_text"), left, chunk_size, overlap))
        pieces = pieces.filter(left > 0)
    else:
        pieces = source.select(
            id_col, *extra, is_chunk.alias("is_chunk"), F.lit(0).alias("_stretch"), text.alias("_text")
        )
        first, windows = F.lit(0), F.array("_text")
    exploded = pieces.select(
        id_col,
        *extra,
        "is_chunk",
        first.alias("_first"),
        F.posexplode(F.coalesce(windows, F.array("_text"))).alias("_place", "document_text"),
    ).withColumn("chunk_no", F.col("_first") + F.col("_place"))
    start = F.when(F.col("is_chunk"), F.col("chunk_no") * F.lit(step))
    columns = [F.col(id_col), F.col("chunk_no")]
    if global_index:
        columns += [
            (F.col("_base") + F.col("chunk_no")).alias("chunk_index"),
            F.col("original_doc_index"),
        ]
    return exploded.select(
        *columns,
        "is_chunk",
        start.alias("chunk_start"),
        (start + F.length("document_text")).alias("chunk_end"),
        "document_text",
    )


def invalid_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that cannot be embedded, with the reason."""
    text = F.col(text_col)
    reason = F.when(text.isNull(), F.lit("not a string")).when(
        tx.is_blank(text), F.lit("empty")
    )
    return docs.select(F.col(id_col), reason.alias("reason")).filter(F.col("reason").isNotNull())


def validate_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row: ``is_valid``, ``documents``, ``invalid``, ``first_invalid`` and ``reason``.

    A single pass with partial aggregation. An empty table is not valid.
    """
    text = F.col(text_col)
    bad = tx.is_blank(text)
    checked = docs.select(
        F.col(id_col).alias("_id"),
        bad.alias("_bad"),
        F.when(text.isNull(), F.lit("not a string")).otherwise(F.lit("empty")).alias("_why"),
    )
    totals = checked.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("_bad").alias("invalid"),
        F.min(F.when(F.col("_bad"), F.struct("_id", "_why"))).alias("_first"),
    )
    reason = F.when(F.col("documents") == 0, F.lit("no documents")).otherwise(F.col("_first._why"))
    return totals.select(
        ((F.col("documents") > 0) & (F.col("invalid") == 0)).alias("is_valid"),
        "documents",
        "invalid",
        F.col("_first._id").alias("first_invalid"),
        reason.alias("reason"),
    )


def require_valid_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> int:
    """Raise ``ValueError`` naming the smallest bad id; otherwise return the number of documents."""
    report = validate_documents(docs, id_col=id_col, text_col=text_col).head()
    if not report["is_valid"]:
        if report["documents"] == 0:
            raise ValueError("there are no documents")
        raise ValueError(
            f"{report['invalid']} invalid documents; the first is "
            f"{id_col}={report['first_invalid']}: {report['reason']}"
        )
    return report["documents"]


def processing_stats(
    docs: DataFrame,
    *,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of counts for a chunking run, from text lengths alone."""
    text = F.col(text_col)
    count = tx.window_count(F.length(text), chunk_size, overlap)
    return docs.agg(
        F.count(F.lit(1)).alias("documents_processed"),
        F.coalesce(F.sum(count), F.lit(0)).cast("long").alias("chunks_created"),
        F.count_if(tx.is_blank(text)).alias("errors"),
    )
