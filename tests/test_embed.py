"""Encoding, the embedding job and its streaming form."""

import json
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkvec.operators import encoding as en
from sparkvec.operators.chunking import chunk_documents
from sparkvec.plans import embed
from sparkvec.plans.embed import embed_table, packed_id
from sparkvec.plans.registered import QUERIES
from sparkvec.sources import store as st
from sparkvec.sources.documents import documents_from_list, spread
from sparkvec.streaming import ingest
from sparkvec.streaming.ingest import document_stream, embed_stream, embed_stream_into

ENCODER = en.HashEncoderFactory(16)
LONG = " ".join(f"word{i}" for i in range(400))


class Broken:
    dimension = 4

    def encode(self, texts, batch_size):
        return np.zeros((1, 4))


def test_encoder_equals_sql_definition(spark):
    docs = documents_from_list(spark, ["one two two", "", "a b A", LONG])
    dense = {
        r.doc_id: r.embedding
        for r in en.encode_documents(docs, ENCODER, text_col="text").collect()
    }
    sparse = np.zeros((4, 16))
    for r in en.hash_weights(docs, dimension=16).collect():
        sparse[r.doc_id, r.bucket] = r.weight
    for i in range(4):
        assert dense[i] == pytest.approx(sparse[i].tolist(), abs=1e-6)
        assert np.linalg.norm(dense[i]) == pytest.approx(1.0, abs=1e-6)


def test_query_encoding(spark):
    docs = documents_from_list(spark, ["One  two"])
    stored = en.encode_documents(docs, ENCODER, text_col="text").head().embedding
    assert en.encode_query(" One\ntwo\x00 ", ENCODER) == pytest.approx(stored)
    with pytest.raises(ValueError):
        en.encode_query("\x00 ", ENCODER)
    assert en.embedding_dimension(en.encode_documents(docs, ENCODER, text_col="text")) == 16


class FewAtATime(en.HashEncoder):
    def encode(self, texts, batch_size=32):
        assert len(texts) <= 512
        return super().encode(texts, batch_size)


@pytest.mark.parametrize("batch_size", [32, 100, 300])
def test_a_batch_is_encoded_a_few_texts_at_a_time(batch_size):
    texts = [f"word{i} and word{i // 2}" for i in range(1300)]
    got = en._encoded(FewAtATime(16), pa.array(texts), batch_size)
    assert np.allclose(got.to_pylist(), en.HashEncoder(16).encode(texts), atol=1e-6)
    assert en._encoded(FewAtATime(16), pa.array([], pa.string()), batch_size).to_pylist() == []


def test_wrong_encoder_output(spark):
    docs = documents_from_list(spark, ["a", "b", "c"]).coalesce(1)
    with pytest.raises(Exception, match="returned shape"):
        en.encode_documents(docs, Broken, text_col="text").collect()


@pytest.mark.parametrize("dense", [True, False])
def test_embed_table(spark, dense):
    st.create_vector_store(spark, st.VectorStoreConfig("embedded", 16, drop_if_exists=True))
    docs = documents_from_list(spark, ["short", LONG, "other  one"])
    counts = embed_table(
        spark, docs, "embedded", ENCODER, chunk_size=500, overlap=50, dense_ids=dense
    )
    rows = spark.table("embedded").orderBy("id").collect()
    chunks = -(-(len(LONG) - 500) // 450) + 1
    assert counts["documents_processed"] == 3
    assert counts["records_inserted"] == len(rows) == chunks + 2
    assert rows[0].document_text == "short" and rows[-1].document_text == "other  one"
    joined = rows[1].document_text + "".join(r.document_text[50:] for r in rows[2:-1])
    assert joined == LONG
    meta = json.loads(rows[2].metadata)
    assert (meta["doc_id"], meta["is_chunk"], meta["chunk_start"], meta["chunk_end"]) == (1, True, 450, 950)
    if dense:
        assert [r.id for r in rows] == list(range(len(rows)))
        assert meta["chunk_index"] == 2 and meta["original_doc_index"] == 1
        embed_table(spark, docs, "embedded", ENCODER)
        assert spark.table("embedded").agg(F.max("id")).head()[0] == 2 * len(rows) - 1
    before = spark.table("embedded").count()
    bad = documents_from_list(spark, ["a", " ", None])
    with pytest.raises(ValueError, match="doc_id=1: empty"):
        embed_table(spark, bad, "embedded", ENCODER, validate_first=True)
    later = bad.withColumn("doc_id", F.col("doc_id") + 100)
    with pytest.raises(Exception, match="invalid document"):
        embed_table(spark, later, "embedded", ENCODER, dense_ids=dense)
    with pytest.raises(ValueError, match="no documents"):
        embed_table(spark, bad.filter("false"), "embedded", ENCODER, dense_ids=dense)
    assert spark.table("embedded").count() == before
    st.drop_table(spark, "embedded")


@pytest.mark.parametrize("block", [7, embed.BLOCK_CHUNKS])
def test_numbered_chunks_move_texts_once(spark, monkeypatch, block):
    monkeypatch.setattr(embed, "BLOCK_CHUNKS", block)
    docs = documents_from_list(spark, [LONG * (i % 3 + 1) for i in range(30)])
    options = {"chunk_size": 20, "overlap": 5}
    expected = chunk_documents(docs, global_index=True, **options)
    numbered = embed.numbered_chunks(docs, **options).select(expected.columns)
    assert sorted(numbered.collect()) == sorted(expected.collect())
    plan = numbered.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in re.search("ShuffledHashJoin.*", plan)[0]
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", plan)) == 2  # texts, and numbers
    assert "REPARTITION" not in plan
    with_null = docs.union(spark.createDataFrame([(None, "x")], docs.schema))
    with pytest.raises(Exception, match="no doc_id"):
        embed.numbered_chunks(with_null, **options).collect()
    twice = embed.numbered_chunks(docs.union(docs), **options)
    numbers = sorted(r.chunk_index for r in twice.collect())
    assert numbers == list(range(2 * expected.count()))
    assert embed.numbered_chunks(docs.filter("false"), **options).count() == 0


def test_packed_ids(spark):
    df = spark.createDataFrame([(3, 5), (0, 0)], "d long, n int")
    got = [r.i for r in df.select(packed_id(F.col("d"), F.col("n")).alias("i")).collect()]
    assert got == [3 * 2**20 + 5, 0]
    for d, n in [(1, 2**20), (-1, 0), (2**43, 0)]:
        bad = spark.createDataFrame([(d, n)], "d long, n int")
        with pytest.raises(Exception, match="document"):
            bad.select(packed_id(F.col("d"), F.col("n"))).collect()


def test_spread_only_touches_small_inputs(spark, tmp_path):
    docs = documents_from_list(spark, [f"t{i}" for i in range(20)])
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    docs.repartition(9).write.parquet(str(tmp_path / "many"))

    def shuffles(path):
        df = spread(spark.read.parquet(str(tmp_path / path)), "doc_id")
        return "Exchange" in df._jdf.queryExecution().executedPlan().toString()

    assert shuffles("one") and not shuffles("many")


def test_stream_embeds_each_document_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs = documents_from_list(spark, ["short", LONG, " ", "other"])

    def run():
        embed_stream(
            document_stream(spark, source, max_files_per_trigger=1),
            ENCODER,
            output_path=out,
            checkpoint_path=state,
        ).awaitTermination()
        return sorted((r.id, r.document_text) for r in spark.read.parquet(out).collect())

    docs.filter("doc_id < 2").coalesce(1).write.mode("append").parquet(source)
    first = run()
    assert run() == first
    docs.filter("doc_id >= 2").coalesce(1).write.mode("append").parquet(source)
    second = run()
    assert set(first) < set(second)
    chunks = -(-(len(LONG) - 500) // 450) + 1
    assert len(second) == chunks + 2 and len({i for i, _ in second}) == len(second)
    assert dict(second)[3 << 20] == "other"


def test_stream_into_a_store(spark, tmp_path, monkeypatch):
    """Hashed 63-bit ids; a batch that fails before or after its change is there once."""
    st.create_vector_store(spark, st.VectorStoreConfig("streamed", 16, drop_if_exists=True))
    source, state, bad = (str(tmp_path / n) for n in ("in", "state", "bad"))
    docs = documents_from_list(spark, ["short", LONG, " ", "other", None, "last"])
    docs = docs.withColumn("doc_id", F.lit((1 << 63) - 1) - F.col("doc_id") * (1 << 43))

    def run():
        stream = document_stream(spark, source, max_files_per_trigger=1)
        embed_stream_into(stream, "streamed", ENCODER, checkpoint_path=state, rejects_path=bad).awaitTermination()
        return sorted((r.id, r.document_text, json.loads(r.metadata)["doc_id"]) for r in spark.table("streamed").collect())

    whole = embed_table

    def breaking(early):
        def job(*args, **kwargs):
            if not early:
                whole(*args, **kwargs)
            raise RuntimeError("lost")

        return job

    chunks = -(-(len(LONG) - 500) // 450) + 1
    docs.orderBy(F.desc("doc_id")).limit(2).coalesce(1).write.mode("append").parquet(source)
    for early in (True, False):
        monkeypatch.setattr(ingest, "embed_table", breaking(early))
        with pytest.raises(Exception, match="lost"):
            run()
        assert spark.table("streamed").count() == (0 if early else chunks + 1)
    monkeypatch.setattr(ingest, "embed_table", whole)
    first = run()
    assert first == run() and [i for i, *_ in first] == list(range(chunks + 1))
    docs.orderBy("doc_id").limit(4).coalesce(1).write.mode("append").parquet(source)
    second = run()
    assert second[: len(first)] == first and [i for i, *_ in second] == list(range(chunks + 3))
    assert {(t, d) for _, t, d in second[len(first) :]} == {
        ("other", (1 << 63) - 1 - (3 << 43)), ("last", (1 << 63) - 1 - (5 << 43))
    }
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["empty", "not a string"]
    st.drop_table(spark, "streamed")


@pytest.mark.parametrize("folder", [False, True])
def test_stream_query_of_a_file_or_a_folder_of_files(spark, tmp_path, folder):
    docs = [(0, "short"), (1, LONG), (2, None), (3, " ")]
    written, target = tmp_path / "written", tmp_path / "in" / "documents.parquet"
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3 if folder else 1).write.parquet(str(written))
    target.parent.mkdir()
    if folder:
        written.rename(target)
    else:
        next(written.glob("*.parquet")).rename(target)
    rows = QUERIES["embed_documents_stream"](spark, str(target.parent)).collect()
    assert len(rows) == 1 + (-(-(len(LONG) - 500) // 450) + 1)
    assert {r.id >> 20 for r in rows} == {0, 1}
