"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.functions.vectors import distance, vector_from_text, vector_to_text
from sparkvec.operators import cells, chunking, rag, search, simjoin, stats
from sparkvec.operators.encoding import encode_documents, encode_text, hash_weights
from sparkvec.operators.knn import batch_topk
from sparkvec.operators.postings import write_postings
from sparkvec.plans.embed import embed_table
from sparkvec.session import shared_dir
from sparkvec.sources import sample
from sparkvec.sources.documents import read_documents as read_json_documents
from sparkvec.sources import store as st
from sparkvec.streaming.ingest import document_stream, embed_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SIMILAR_TO = 7
TOP_K = 10


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- similar documents (the given vectors) -----------------------------------


@query
def similar_documents_cosine(spark, sf_dir):
    found = search.find_similar_documents(
        sample.embedding_store(spark, sf_dir), SIMILAR_TO, top_k=TOP_K, include_distance=True
    )
    return _rounded(found, "distance")


@query
def similar_documents_euclidean(spark, sf_dir):
    found = search.find_similar_documents(
        sample.embedding_store(spark, sf_dir),
        SIMILAR_TO,
        top_k=TOP_K,
        include_distance=True,
        metric="euclidean",
    )
    return _rounded(found, "distance")


@query
def similar_documents_with_self(spark, sf_dir):
    return search.find_similar_documents(
        sample.embedding_store(spark, sf_dir), SIMILAR_TO, top_k=TOP_K, exclude_self=False
    )


@query
def similar_documents_all(spark, sf_dir):
    """Similar documents of every stored vector."""
    vectors = sample.read(spark, sf_dir, "embeddings")
    found = batch_topk(
        vectors,
        vectors,
        top_k=TOP_K,
        exclude_same_id=True,
        id_col="vec_id",
        qid_col="vec_id",
    )
    return _rounded(found.withColumnRenamed("vec_id", "qid"), "distance")


@query
def similar_documents_all_blocked(spark, sf_dir):
    """The same with a query set beyond the broadcast bound."""
    vectors = sample.read(spark, sf_dir, "embeddings")
    found = batch_topk(
        vectors,
        vectors.withColumnRenamed("vec_id", "qid"),
        top_k=TOP_K,
        exclude_same_id=True,
        id_col="vec_id",
        broadcast_bytes=64 << 10,
        metric="euclidean",
    )
    return _rounded(found, "distance")


@query
def similar_pairs(spark, sf_dir):
    """All pairs of stored vectors with a cosine similarity of 0.35 or more."""
    pairs, _ = simjoin.similar_pairs(sample.read(spark, sf_dir, "embeddings"), 0.35, every_id=True, id_col="vec_id")
    return _rounded(pairs, "similarity")


@query
def adhoc_similarity(spark, sf_dir):
    vectors = sample.read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("index"), F.col("label").cast("string").alias("text"), "embedding"
    )
    target = search.encode_query(sample.first_benchmark_text(spark, sf_dir), sample.ENCODER)
    return _rounded(search.similarity_search(vectors, target, top_k=TOP_K), "distance")


@query
def vector_distances(spark, sf_dir):
    """Distances of every stored vector to the hash vector of its document."""
    stored = sample.embedding_store(spark, sf_dir).filter("metadata <> '{}'")  # those with a document
    both = encode_documents(stored, sample.ENCODER, output="other")
    return both.select(
        "id",
        F.round(distance(F.col("embedding"), F.col("other"), "cosine"), 6).alias("cosine"),
        F.round(distance(F.col("embedding"), F.col("other"), "euclidean"), 6).alias("euclidean"),
    )


@query
def vector_text_roundtrip(spark, sf_dir):
    vector = F.col("embedding")
    back = vector_from_text(vector_to_text(vector))
    return sample.read(spark, sf_dir, "embeddings").select(
        "vec_id", (back == vector).alias("same"), F.size(back).cast("long").alias("dimensions")
    )


# --- semantic search (documents encoded offline) -----------------------------


@query
def semantic_topk(spark, sf_dir):
    return search.semantic_search(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        top_k=TOP_K,
        encoder_factory=sample.ENCODER,
    )


@query
def semantic_topk_distance(spark, sf_dir):
    found = search.semantic_search(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        top_k=TOP_K,
        encoder_factory=sample.ENCODER,
        include_distance=True,
    )
    return _rounded(found, "distance")


@query
def semantic_threshold(spark, sf_dir):
    return search.semantic_search(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        top_k=100,
        encoder_factory=sample.ENCODER,
        distance_threshold=0.55,
    )


@query
def semantic_metric_override(spark, sf_dir):
    found = search.semantic_search(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        top_k=TOP_K,
        encoder_factory=sample.ENCODER,
        include_distance=True,
        metric="EUCLIDEAN",
    )
    return _rounded(found, "distance")


@query
def batch_search(spark, sf_dir):
    """Every benchmark text against all documents."""
    asked = sample.benchmark_questions(spark, sf_dir).select(
        "qid", encode_text(F.col("question"), sample.ENCODER).alias("embedding")
    )
    store = sample.document_store(spark, sf_dir)
    return _rounded(batch_topk(store, asked, top_k=TOP_K), "distance")


@query
def text_score(spark, sf_dir):
    scored = search.text_score(
        sample.document_rows(spark, sf_dir), sample.first_benchmark_text(spark, sf_dir)
    )
    return scored.select("id", F.round("match", 6).alias("match"))


def _postings(spark, rows):
    path = f"{shared_dir(spark)}/sparkvec_postings/{uuid.uuid4().hex}"
    write_postings(rows, path)
    return path


@query
def text_score_postings(spark, sf_dir):
    """The same from postings that were written before."""
    rows = sample.document_rows(spark, sf_dir)
    asked = sample.first_benchmark_text(spark, sf_dir)
    scored = search.text_score(rows.select("id"), asked, postings=_postings(spark, rows))
    return scored.select("id", F.round("match", 6).alias("match"))


@query
def hybrid_search_postings(spark, sf_dir):
    """Hybrid search of a stored table that reads no text but the winners'."""
    table = _new_table(spark, "hybrid")
    st.insert_embeddings(spark, table, sample.document_store(spark, sf_dir))
    found = search.hybrid_search(
        table,
        sample.first_benchmark_text(spark, sf_dir),
        top_k=TOP_K,
        encoder_factory=sample.ENCODER,
        include_distance=True,
        postings=_postings(spark, spark.table(table).select("id", "document_text")),
    )
    return _rounded(found, "combined_score")


@query
def hybrid_search(spark, sf_dir):
    found = search.hybrid_search(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        top_k=TOP_K,
        encoder_factory=sample.ENCODER,
        include_distance=True,
    )
    return _rounded(found, "combined_score")


@query
def metadata_eq_string(spark, sf_dir):
    return search.search_by_metadata(sample.document_rows(spark, sf_dir), {"lang": "de"})


@query
def metadata_eq_number(spark, sf_dir):
    return search.search_by_metadata(sample.event_rows(spark, sf_dir), {"k": 42})


@query
def metadata_in_list(spark, sf_dir):
    return search.search_by_metadata(
        sample.document_rows(spark, sf_dir),
        {"lang": ["fr", "es"], "source": ["src1", "src4", "src9"]},
    )


@query
def metadata_promoted(spark, sf_dir):
    """The same in a store whose keys have columns of their own, so that the filter reaches the scan."""
    table = _new_table(spark, "promoted", promoted={"lang": "string", "source": "string"})
    st.insert_embeddings(spark, table, sample.embedding_store(spark, sf_dir))
    filters = {"lang": ["fr", "es"], "source": ["src1", "src4", "src9"]}
    return search.search_by_metadata(table, filters, top_k=100_000).select("id", "document_text", "metadata")


@query
def ann_topk_all_cells(spark, sf_dir):
    """Approximate search with every cell probed: the exact answer."""
    vectors = sample.read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    index = cells.fit_cells(vectors, cells=8, max_iter=5)
    found = cells.approximate_topk(
        cells.assign_cells(vectors, index),
        vectors.withColumnRenamed("id", "qid"),
        index,
        probes=8,
        top_k=TOP_K,
        exclude_same_id=True,
        checkpoint_store=True,
    )
    return _rounded(found, "distance")


@query
def ann_topk(spark, sf_dir):
    vectors = sample.read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    index = cells.fit_cells(vectors, cells=8, max_iter=5)
    found = cells.approximate_topk(
        cells.assign_cells(vectors, index),
        vectors.withColumnRenamed("id", "qid"),
        index,
        probes=3,
        top_k=TOP_K,
        exclude_same_id=True,
        checkpoint_store=True,
    )
    return _rounded(found, "distance")


@query
def ann_topk_given_cells(spark, sf_dir):
    """The same over cells around given vectors, written and read back, of which a query probes 3."""
    vectors = sample.read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    index = cells.given_cells(vectors, cells=8)
    path = f"{shared_dir(spark)}/sparkvec_cells/{uuid.uuid4().hex}"
    cells.write_cells(vectors, index, path)
    found = cells.approximate_topk(
        cells.read_cells(spark, path),
        vectors.withColumnRenamed("id", "qid"),
        index,
        probes=3,
        top_k=TOP_K,
        exclude_same_id=True,
    )
    return _rounded(found, "distance")


@query
def ann_topk_filled(spark, sf_dir):
    """Small cells, of which a query probes one, and as many more as it takes to find ten rows."""
    vectors = sample.read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    index = cells.given_cells(vectors, cells=100)
    found = cells.approximate_topk(
        cells.assign_cells(vectors, index),
        vectors.withColumnRenamed("id", "qid"),
        index,
        probes=1,
        top_k=TOP_K,
        exclude_same_id=True,
        checkpoint_store=True,
    )
    return _rounded(found, "distance")


# --- text preparation --------------------------------------------------------


def _chunks(spark, sf_dir, **options):
    chunks = chunking.chunk_documents(sample.read(spark, sf_dir, "documents"), **options)
    return chunks.withColumn("chunk_md5", F.md5(F.col("document_text").cast("binary"))).drop(
        "document_text"
    )


@query
def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query
def chunk_documents_tail(spark, sf_dir):
    return _chunks(spark, sf_dir, emit_tail=True)


@query
def chunk_documents_wide_overlap(spark, sf_dir):
    return _chunks(spark, sf_dir, chunk_size=200, overlap=150)


@query
def chunk_global_index(spark, sf_dir):
    return _chunks(spark, sf_dir, global_index=True)


@query
def sanitize_text(spark, sf_dir):
    clean = tx.sanitize_text(F.col("html"))
    return sample.read(spark, sf_dir, "pages").select("page_id", clean.alias("clean"))


@query
def preview_text(spark, sf_dir):
    return sample.read(spark, sf_dir, "documents").select(
        "doc_id",
        tx.preview(F.col("text"), 100).alias("head"),
        tx.preview(F.col("text"), 1000, "...").alias("cut"),
    )


def _partly_blank(spark, sf_dir):
    """All turns of the conversations, and a blank row beside each of the assistant's."""
    turns = sample.read(spark, sf_dir, "conversations")
    place = F.shiftleft("conv_id", 21) + F.col("turn") * 2
    blanks = turns.filter("role = 'assistant'").select((place + 1).alias("doc_id"), F.lit(" \n\t ").alias("text"))
    return turns.select(place.alias("doc_id"), "text").unionByName(blanks)


@query
def empty_placeholder(spark, sf_dir):
    return _partly_blank(spark, sf_dir).select(
        "doc_id", tx.encoder_input(F.col("text")).alias("encoder_text")
    )


@query
def validate_documents(spark, sf_dir):
    return chunking.validate_documents(sample.read(spark, sf_dir, "documents"))


@query
def validate_documents_blank(spark, sf_dir):
    return chunking.validate_documents(_partly_blank(spark, sf_dir))


@query
def invalid_documents(spark, sf_dir):
    return chunking.invalid_documents(_partly_blank(spark, sf_dir))


@query
def processing_stats(spark, sf_dir):
    return chunking.processing_stats(sample.read(spark, sf_dir, "documents"))


# --- encoding ----------------------------------------------------------------


@query
def hash_encode(spark, sf_dir):
    return _rounded(hash_weights(sample.read(spark, sf_dir, "documents")), "weight")


@query
def encode_batch_udf(spark, sf_dir):
    encoded = encode_documents(
        sample.read(spark, sf_dir, "documents"), sample.ENCODER, text_col="text"
    )
    return encoded.select("doc_id", F.posexplode("embedding").alias("bucket", "weight")).select(
        "doc_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


# --- retrieval-augmented generation ------------------------------------------


@query
def rag_context(spark, sf_dir):
    retrieved = rag.retrieve_context(
        sample.document_store(spark, sf_dir),
        sample.benchmark_questions(spark, sf_dir),
        sample.ENCODER,
    )
    return rag.build_context(retrieved).select("qid", "context_text", "context_count")


@query
def rag_prompt(spark, sf_dir):
    questions = sample.benchmark_questions(spark, sf_dir)
    context = rag_context(spark, sf_dir)
    prompt = rag.build_prompt(F.col("question"), F.col("context_text"))
    return questions.join(context, "qid").select("qid", prompt.alias("prompt"))


@query
def rag_batch(spark, sf_dir):
    results = rag.rag_batch(
        sample.document_store(spark, sf_dir),
        sample.benchmark_questions(spark, sf_dir),
        sample.ENCODER,
        rag.ExtractiveGenerator,
    )
    return results.select("qid", "question", "answer", "context_count", "error")


@query
def rag_batch_refused(spark, sf_dir):
    """The same with a blank question for every turn of a user: each is refused alone."""
    turns = sample.read(spark, sf_dir, "conversations").filter("role = 'user'")
    blank = turns.select((-1 - F.shiftleft("conv_id", 21) - F.col("turn")).alias("qid"), F.lit(" \n").alias("question"))
    results = rag.rag_batch(
        sample.document_store(spark, sf_dir),
        sample.benchmark_questions(spark, sf_dir).unionByName(blank),
        sample.ENCODER,
        rag.ExtractiveGenerator,
    )
    return results.select("qid", "answer", "context_count", "error")


@query
def rag_query(spark, sf_dir):
    """One question against all documents."""
    result = rag.rag_query(
        sample.document_store(spark, sf_dir),
        sample.first_benchmark_text(spark, sf_dir),
        sample.ENCODER,
        rag.ExtractiveGenerator,
    )
    row = (result["question"], result["answer"], result["context_count"], [m["id"] for m in result["context_metadata"]])
    found = spark.createDataFrame([row], "question string, answer string, context_count int, ids array<long>")
    return found.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query
def rag_answer_quality(spark, sf_dir):
    metrics = rag.answer_quality(
        sample.question_answer_pairs(spark, sf_dir), ground_truth_col="ground_truth"
    ).drop("question", "answer", "context", "ground_truth")
    return _rounded(
        metrics,
        "answer_to_context_ratio",
        "question_answer_overlap",
        "context_answer_overlap",
        "ground_truth_overlap",
    )


# --- statistics --------------------------------------------------------------


def _fields_as_text(df):
    return df.withColumn("metadata_fields", F.array_join("metadata_fields", ","))


@query
def search_stats(spark, sf_dir):
    found = stats.search_statistics(sample.document_rows(spark, sf_dir))
    return _rounded(_fields_as_text(found), "avg_text_length")


@query
def metadata_fields(spark, sf_dir):
    return stats.metadata_fields(
        sample.document_rows(spark, sf_dir)
        .select("metadata")
        .unionByName(sample.event_rows(spark, sf_dir).select("metadata"))
    )


@query
def rag_stats(spark, sf_dir):
    found = stats.rag_statistics(
        sample.document_rows(spark, sf_dir),
        table="documents",
        encoder_factory=sample.ENCODER,
        embedding_model="hash",
        table_config="cosine",
    )
    return _rounded(_fields_as_text(found), "avg_document_length")


# --- store tables ------------------------------------------------------------


def _new_table(spark, name, **settings):
    table = f"sparkvec_{name}"
    st.create_vector_store(
        spark,
        st.VectorStoreConfig(
            table,
            dimensions=sample.DIMENSIONS,
            drop_if_exists=True,
            location=f"{shared_dir(spark)}/sparkvec_tables",
            **settings,
        ),
    )
    return table


def _filled_table(spark, sf_dir, name):
    table = _new_table(spark, name)
    st.insert_embeddings(spark, table, sample.embedding_store(spark, sf_dir).drop("created_at"))
    return table


@query
def insert_embeddings(spark, sf_dir):
    """Appended with dense ids, in document order."""
    table = _new_table(spark, "insert")
    rows = sample.embedding_store(spark, sf_dir).withColumnRenamed("id", "position")
    st.insert_embeddings(spark, table, rows.drop("created_at"), order_by="position")
    return spark.table(table).select("id", "document_text", "metadata")


@query
def embed_documents(spark, sf_dir):
    """The whole embedding job, from documents to a searchable table."""
    table = _new_table(spark, "embed")
    embed_table(spark, sample.read(spark, sf_dir, "documents"), table, sample.ENCODER)
    return spark.table(table).select(
        "id",
        F.md5(F.col("document_text").cast("binary")).alias("chunk_md5"),
        F.get_json_object("metadata", "$.doc_id").cast("long").alias("doc_id"),
        F.get_json_object("metadata", "$.chunk_start").cast("int").alias("chunk_start"),
        F.size("embedding").alias("dimensions"),
    )


@query
def processing_run(spark, sf_dir):
    """The counts and the time that the whole embedding job reports."""
    table = _new_table(spark, "run")
    report = embed_table(spark, sample.read(spark, sf_dir, "documents"), table, sample.ENCODER)
    timed = report.pop("processing_time") > 0
    fields = ", ".join(f"{name} long" for name in report)
    return spark.createDataFrame([(*report.values(), timed)], f"{fields}, timed boolean")


@query
def embed_documents_stream(spark, sf_dir):
    """The embedding job as a stream that works off the files it finds."""
    base = f"{shared_dir(spark)}/sparkvec_streams/{uuid.uuid4().hex}"
    # as a glob the table may be a file or a folder of files
    docs = document_stream(spark, f"{sf_dir}/documents.parque[t]")
    embed_stream(
        docs,
        sample.ENCODER,
        output_path=f"{base}/rows",
        checkpoint_path=f"{base}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{base}/rows").select(
        "id",
        F.md5(F.col("document_text").cast("binary")).alias("chunk_md5"),
        F.size("embedding").alias("dimensions"),
    )


@query
def drop_table(spark, sf_dir):
    """Two stores; one is dropped, the other keeps its rows."""
    kept, gone = _filled_table(spark, sf_dir, "kept"), _filled_table(spark, sf_dir, "gone")
    dropped = st.drop_table(spark, gone)
    return spark.table(kept).select(
        "id",
        "document_text",
        F.lit(dropped).alias("dropped"),
        F.lit(st.table_exists(spark, gone)).alias("left_over"),
        F.lit(kept in st.list_tables(spark)).alias("other_listed"),
    )


@query
def execute_command(spark, sf_dir):
    """A store filled from another by an INSERT statement, and the rows it reports."""
    source, target = _filled_table(spark, sf_dir, "command_source"), _new_table(spark, "command")
    affected = st.execute_command(spark, f"INSERT INTO {target} SELECT * FROM {source}")
    return spark.table(target).select("id", "document_text", F.lit(affected).cast("long").alias("affected"))


@query
def execute_command_cte(spark, sf_dir):
    """A store filled by a statement that begins with WITH, after a comment; a second time its ids are refused."""
    source, target = _filled_table(spark, sf_dir, "cte_source"), _new_table(spark, "cte")
    command = f"-- copy\nWITH rows AS (SELECT * FROM {source}) INSERT INTO {target} SELECT * FROM rows"
    affected = st.execute_command(spark, command)
    try:
        st.execute_command(spark, command)
        refused = False
    except ValueError:
        refused = True
    return spark.table(target).select(
        "id", "document_text", F.lit(affected).cast("long").alias("affected"), F.lit(refused).alias("refused")
    )


@query
def insert_twice(spark, sf_dir):
    """The same ids a second time are refused, and the table stays as it was."""
    table = _filled_table(spark, sf_dir, "twice")
    try:
        st.insert_embeddings(spark, table, sample.embedding_store(spark, sf_dir).drop("created_at"))
        refused = False
    except ValueError:
        refused = True
    stamped = F.col("created_at").isNotNull() & (F.col("created_at") == F.col("updated_at"))
    return spark.table(table).select("id", "metadata", F.lit(refused).alias("refused"), stamped.alias("stamped"))


@query
def read_documents(spark, sf_dir):
    """All documents written as JSON lines and read again."""
    path = f"{shared_dir(spark)}/sparkvec_sources/{uuid.uuid4().hex}"
    sample.read(spark, sf_dir, "documents").select("doc_id", "text").write.json(path)
    return read_json_documents(spark, path, source_format="json", schema="doc_id long, text string")


@query
def table_info(spark, sf_dir):
    table = _filled_table(spark, sf_dir, "info")
    info = st.table_info(spark, table)
    config = info["vector_config"]
    return info["sample_data"].select(
        "id",
        "preview",
        F.lit(info["row_count"]).cast("long").alias("row_count"),
        F.lit(len(info["columns"])).alias("columns"),
        F.lit(config["dimensions"]).alias("dimensions"),
        F.lit(config["distance_metric"]).alias("distance_metric"),
        F.lit(table in st.list_vector_tables(spark)).alias("is_listed"),
    )


@query
def get_record(spark, sf_dir):
    table = _filled_table(spark, sf_dir, "record")
    return st.get_record(spark, table, SIMILAR_TO).select("id", "document_text", "metadata")


@query
def table_search(spark, sf_dir):
    """Semantic search by table name, with the table's own metric."""
    table = _filled_table(spark, sf_dir, "search")
    found = search.find_similar_documents(table, SIMILAR_TO, top_k=TOP_K, include_distance=True)
    return _rounded(found, "distance")


@query
def delete_records(spark, sf_dir):
    table = _filled_table(spark, sf_dir, "delete")
    condition = "get_json_object(metadata, '$.lang') = :lang"
    deleted = st.delete_records(spark, table, condition, {"lang": "en"})
    return spark.table(table).select(
        "id", "document_text", "metadata", F.lit(deleted).cast("long").alias("deleted")
    )


@query
def update_metadata(spark, sf_dir):
    table = _filled_table(spark, sf_dir, "update")
    labels = sample.read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.to_json(F.struct("quality", "toxic")).alias("metadata")
    )
    st.update_metadata_bulk(spark, table, labels)
    st.update_metadata(spark, table, SIMILAR_TO, {"reviewed": True})
    return spark.table(table).select("id", "document_text", "metadata")


@query
def optimize_table(spark, sf_dir):
    table = _filled_table(spark, sf_dir, "optimize")
    result = st.optimize_table(spark, table)
    return spark.table(table).select(
        "id",
        "document_text",
        "metadata",
        F.lit(result["status"]).alias("status"),
        F.lit(result["row_count"]).cast("long").alias("row_count"),
    )


@query
def execute_query(spark, sf_dir):
    sample.document_rows(spark, sf_dir).createOrReplaceTempView("sparkvec_documents")
    return st.execute_query(
        spark,
        "SELECT id, length(document_text) AS characters FROM sparkvec_documents "
        "WHERE get_json_object(metadata, '$.lang') = ?",
        ["fr"],
    )
