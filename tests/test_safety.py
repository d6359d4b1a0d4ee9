"""Nothing is lost, doubled or left out without a word."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.functions.jsons import metadata_matches
from sparkvec.operators.cells import fit_cells
from sparkvec.operators.chunking import chunk_documents
from sparkvec.operators.encoding import HashEncoder, HashEncoderFactory
from sparkvec.operators.knn import batch_topk
from sparkvec.operators.rag import rag_batch
from sparkvec.sources import store as st
from sparkvec.streaming.ingest import document_stream, embed_stream


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, document_text string, embedding array<float>")


def new_store(spark, table):
    st.create_vector_store(spark, st.VectorStoreConfig(table, dimensions=2, drop_if_exists=True))


def test_tables_of_one_name_in_two_databases(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    config = st.VectorStoreConfig("same_name", dimensions=2, drop_if_exists=True, location=str(tmp_path))
    try:
        st.create_vector_store(spark, config)
        st.insert_embeddings(spark, "same_name", vectors(spark, [(1, "a", [1.0, 0.0])]))
        spark.sql("USE other_db")
        st.create_vector_store(spark, config)
        st.drop_table(spark, "same_name")
    finally:
        spark.sql("USE default")
    assert spark.table("same_name").count() == 1
    st.drop_table(spark, "same_name")


def test_repeated_ids_are_refused(spark):
    new_store(spark, "once")
    rows = vectors(spark, [(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0])])
    st.insert_embeddings(spark, "once", rows)
    with pytest.raises(ValueError, match="twice"):
        st.insert_embeddings(spark, "once", rows)
    with pytest.raises(ValueError, match="twice"):
        st.insert_embeddings(spark, "once", vectors(spark, [(5, "a", [1.0, 0.0])] * 2))
    updates = spark.createDataFrame([(1, "{}"), (1, '{"a":1}')], "id long, metadata string")
    with pytest.raises(Exception, match="two updates for id 1"):
        st.update_metadata_bulk(spark, "once", updates)
    assert spark.table("once").count() == 2
    assert st.execute_command(spark, "INSERT INTO once SELECT id + 10, document_text, metadata, embedding, created_at, updated_at FROM once") == 2
    assert st.delete_records(spark, "once", "rand() < 2") == 4
    st.drop_table(spark, "once")


@pytest.mark.parametrize("bad", [math.inf, -math.inf, math.nan])
def test_vectors_must_be_finite(spark, bad):
    new_store(spark, "finite")
    with pytest.raises(Exception, match="not 2 numbers"):
        st.insert_embeddings(spark, "finite", vectors(spark, [(1, "a", [bad, 0.0])]))
    st.drop_table(spark, "finite")


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_odd_vectors_do_not_hide_others(spark, metric):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(48)]
    rows += [(48, [math.inf, 0.0, 0.0, 0.0]), (49, [1e20, 0.0, 0.0, 0.0])]
    store = spark.createDataFrame(rows, "id long, embedding array<double>")
    asked = store.where("id < 5").withColumnRenamed("id", "qid")
    found = batch_topk(store, asked, top_k=50, metric=metric)
    assert [r["count"] for r in found.groupBy("qid").count().collect()] == [50] * 5
    near = {(r.qid, r.rn): r.id for r in batch_topk(store, asked, top_k=1, metric=metric).collect()}
    assert near == {(i, 1): i for i in range(5)}


def test_null_texts_are_seen(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    for dense in (False, True):
        rows = chunk_documents(docs, global_index=dense).orderBy("doc_id").collect()
        assert [(r.doc_id, r.chunk_no, r.is_chunk, r.document_text) for r in rows] == [(1, 0, False, "abc"), (2, 0, False, None)]


def test_stream_rejects(spark, tmp_path):
    docs = spark.createDataFrame([(1, "abc"), (2, None), (3, " \n")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    stream = document_stream(spark, str(tmp_path / "in"))
    embed_stream(
        stream, HashEncoderFactory(8), output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "state")
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    rejected = spark.read.parquet(str(tmp_path / "out-rejects")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.reason) for r in rejected] == [(2, "not a string"), (3, "empty")]


class Picky(HashEncoder):
    def encode(self, texts, batch_size=32):
        if any("refuse" in t for t in texts):
            raise ValueError("refused")
        return super().encode(texts, batch_size)


class PickyFactory(HashEncoderFactory):
    def __call__(self):
        return Picky(self.dimension)


class EchoFactory:
    def __call__(self):
        return self

    def generate(self, prompts, **_):
        return ["yes" for _ in prompts]


def test_a_refused_question_is_alone(spark):
    store = spark.createDataFrame([(1, "some text", "{}")], "id long, document_text string, metadata string")
    store = store.withColumn("embedding", F.array(*[F.lit(0.5)] * 8))
    questions = spark.createDataFrame([(1, "what?"), (2, "refuse me"), (3, " ")], "qid long, question string")
    rows = {r.qid: r for r in rag_batch(store, questions, PickyFactory(8), EchoFactory(), metric="cosine").collect()}
    assert "refused" in rows[2].error and rows[3].error == "the question is blank"
    assert rows[1].context_count == 1


def test_mixed_lists_of_numbers(spark):
    df = spark.createDataFrame([('{"a": 1.5}',), (f'{{"a": {2**60}}}',), (f'{{"a": {2**60 + 1}}}',)], "m string")
    assert [r[0] for r in df.select(metadata_matches(F.col("m"), "a", [2**60, 1.5])).collect()] == [True, True, False]


def test_cells_train_on_all_rows_and_check_first(spark):
    store = spark.range(40).select("id", F.array(F.rand(1), F.rand(2)).alias("embedding"))
    assert fit_cells(store, cells=3).cells == 3
    with pytest.raises(ValueError, match="fewer cells"):
        fit_cells(store, cells=1 << 23)
