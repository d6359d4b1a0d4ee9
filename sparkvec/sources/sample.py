"""The given tables in the shape of a vector store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvec.operators.encoding import HashEncoderFactory, encode_documents
from sparkvec.sources.documents import spread

DIMENSIONS = 64
ENCODER = HashEncoderFactory(DIMENSIONS)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as store rows without a vector."""
    created = F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, doc_id)")
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("document_text"),
        F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata"),
        created.alias("created_at"),
    )


def document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded by the offline encoder; a small file is spread over the cores for it."""
    return encode_documents(spread(document_rows(spark, sf_dir), "id"), ENCODER)


def embedding_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given vectors, each with the text of its document; an empty text where there is none."""
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    rows = vectors.join(document_rows(spark, sf_dir), "id", "left")
    return rows.withColumns(
        {
            "document_text": F.coalesce("document_text", F.lit("")),
            "metadata": F.coalesce("metadata", F.lit("{}")),
        }
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as store rows without a vector; their properties are the metadata."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("document_text"),
        F.col("props").alias("metadata"),
        F.col("ts").alias("created_at"),
    )


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def first_benchmark_text(spark: SparkSession, sf_dir: str) -> str:
    """One query text for the single-query searches."""
    return read(spark, sf_dir, "benchmark").agg(F.min_by("text", "item_id")).head()[0]


def question_answer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant's next turn.

    The turn after that serves as ground truth and the turn before as context,
    where there is one. Joined on (conversation, turn), which is unique, so that
    a very long conversation is spread over tasks; a window per conversation
    would not be.
    """
    turns = read(spark, sf_dir, "conversations")

    def at(offset: int, name: str) -> DataFrame:
        return turns.select("conv_id", (F.col("turn") - offset).alias("turn"), F.col("text").alias(name))

    answers = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    keys = ["conv_id", "turn"]
    return (
        turns.filter("role = 'user'")
        .select("conv_id", "turn", F.col("text").alias("question"))
        .join(answers, keys)
        .join(at(2, "ground_truth"), keys, "left")
        .join(at(-1, "earlier"), keys, "left")
        .select(
            *keys,
            "question",
            "answer",
            F.array_compact(F.array("earlier", "question")).alias("context"),
            "ground_truth",
        )
    )
