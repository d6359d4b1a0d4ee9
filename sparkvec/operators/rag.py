"""Retrieval-augmented generation over many questions, and answer metrics."""

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.operators.checks import check_top_k
from sparkvec.operators.encoding import EncoderFactory, build_once, try_encode_text, factory_key
from sparkvec.operators.knn import BROADCAST_BYTES, batch_topk
from sparkvec.session import ensure_checkpoint_dir
from sparkvec.sources.store import resolve_store

RAG_TOP_K = 3
TEMPERATURE = 0.2
MAX_TOKENS = 1024
CONTEXT_LENGTH = 1000

# Instruction text and answer phrases that results are compared on.
DEFAULT_SYSTEM_PROMPT = (
    "You are a helpful AI assistant. Answer the question based on the provided context. "
    "If the context doesn't contain enough information to answer the question, say so clearly. "
    "Be concise and accurate in your response."
)
INSUFFICIENT_CONTEXT_PHRASES = [
    "don't have enough information",
    "context doesn't contain",
    "cannot answer",
    "insufficient information",
    "not enough context",
]

# Why a question has no answer.
BLANK_QUESTION = "the question is blank"
NO_CONTEXT = "no relevant context was found"
BLANK_ANSWER = "the generator returned an empty answer"

GeneratorFactory = Callable[[], Any]


def retrieve_context(
    store: DataFrame | str,
    questions: DataFrame,
    encoder_factory: EncoderFactory,
    *,
    top_k: int = RAG_TOP_K,
    metric: str | None = None,
    qid_col: str = "qid",
    question_col: str = "question",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``qid, rn, id, document_text, metadata, distance`` for every question that is not blank."""
    check_top_k(top_k)
    df, metric = resolve_store(store, metric)
    asked = _encoded(questions, encoder_factory, qid_col, question_col)
    return _retrieved(df, asked, top_k, metric, broadcast_bytes)


def _encoded(questions: DataFrame, encoder_factory: EncoderFactory, qid_col: str, question_col: str) -> DataFrame:
    """``qid, embedding, error`` of the questions that are not blank, encoded once."""
    made = questions.filter(~tx.is_blank(F.col(question_col))).select(
        F.col(qid_col).cast("long").alias("qid"),
        try_encode_text(F.col(question_col), encoder_factory).alias("_made"),
    )
    ensure_checkpoint_dir(questions.sparkSession)
    return made.select("qid", F.col("_made.vector").alias("embedding"), F.col("_made.error").alias("error")).checkpoint()


def _retrieved(df: DataFrame, asked: DataFrame, top_k: int, metric: str, broadcast_bytes: int) -> DataFrame:
    asked = asked.filter(F.col("embedding").isNotNull()).select("qid", "embedding")
    return batch_topk(
        df,
        asked,
        top_k=top_k,
        metric=metric,
        keep=("document_text", "metadata"),
        broadcast_bytes=broadcast_bytes,
    )


def context_part(number: Column, text: Column, cut: int | None = CONTEXT_LENGTH) -> Column:
    """``[Context i]: text``, cut at ``cut`` characters; None keeps the whole text."""
    shown = text if cut is None else tx.preview(text, cut, "...")
    return F.concat(F.lit("[Context "), number.cast("string"), F.lit("]: "), shown)


def build_context(retrieved: DataFrame, *, cut: int | None = CONTEXT_LENGTH) -> DataFrame:
    """One row per question: context text, the passages, and where they came from.

    A question's group is bounded by the ``top_k`` of its retrieval.
    """
    rows = retrieved.select(
        "qid",
        F.struct(
            "rn",
            context_part(F.col("rn"), F.col("document_text"), cut).alias("part"),
            F.col("document_text").alias("text"),
            F.struct("id", "distance", "metadata").alias("source"),
        ).alias("hit"),
    )
    grouped = rows.groupBy("qid").agg(
        F.array_sort(F.collect_list("hit")).alias("hits")  # rn comes first and is unique
    )
    return grouped.select(
        "qid",
        F.array_join(F.col("hits.part"), "\n\n").alias("context_text"),
        F.col("hits.text").alias("context"),
        F.col("hits.source").alias("context_metadata"),
        F.size("hits").alias("context_count"),
    )


def build_prompt(question: Column, context: Column, system_prompt: str | None = None) -> Column:
    # Fixed value: the layout of the prompt.
    return F.concat(
        F.lit(system_prompt or DEFAULT_SYSTEM_PROMPT),
        F.lit("\n\nContext:\n"),
        context,
        F.lit("\n\nQuestion: "),
        question,
        F.lit("\n\nAnswer:"),
    )


def generate_answers(
    prompt: Column,
    generator_factory: GeneratorFactory,
    *,
    model: str | None = None,
    temperature: float = TEMPERATURE,
    max_tokens: int = MAX_TOKENS,
) -> Column:
    """``struct<answer, error>`` for each prompt; NULL prompts give NULL.

    The factory returns an object with ``generate(prompt, model=, temperature=,
    max_tokens=)`` and runs once per Python worker. One failing prompt does not
    stop the others.
    """
    key = factory_key(generator_factory)
    options = {"model": model, "temperature": temperature, "max_tokens": max_tokens}

    @F.arrow_udf("answer string, error string")
    def generate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generator = build_once(key, generator_factory)
        for batch in batches:
            answers, errors = [], []
            for text in batch.to_pylist():
                answer = error = None
                if text is not None:
                    try:
                        answer = (generator.generate(text, **options) or "").strip()
                        if not answer:
                            answer, error = None, BLANK_ANSWER
                    except Exception as failure:  # noqa: BLE001 - reported as a row
                        error = str(failure) or type(failure).__name__
                answers.append(answer)
                errors.append(error)
            yield pa.StructArray.from_arrays(
                [pa.array(answers, pa.string()), pa.array(errors, pa.string())],
                ["answer", "error"],
            )

    # Declared nondeterministic so that Catalyst never calls the generator twice.
    return generate.asNondeterministic()(prompt)


class ExtractiveGenerator:
    """Offline stand-in for a language model: answers with the first line of the context."""

    # Marks of the prompt layout.
    START, END = "[Context 1]: ", "\n"

    def generate(self, prompt: str, **_: Any) -> str:
        tail = prompt.partition(self.START)[2]
        return tail.partition(self.END)[0]


def rag_batch(
    store: DataFrame | str,
    questions: DataFrame,
    encoder_factory: EncoderFactory,
    generator_factory: GeneratorFactory,
    *,
    top_k: int = RAG_TOP_K,
    model: str | None = None,
    temperature: float = TEMPERATURE,
    max_tokens: int = MAX_TOKENS,
    system_prompt: str | None = None,
    metric: str | None = None,
    qid_col: str = "qid",
    question_col: str = "question",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Answer every question; a question that fails has an ``error`` instead of an answer."""
    asked = questions.select(
        F.col(qid_col).cast("long").alias("qid"), F.col(question_col).alias("question")
    )
    check_top_k(top_k)
    df, metric = resolve_store(store, metric)
    encoded = _encoded(asked, encoder_factory, "qid", "question")
    retrieved = _retrieved(df, encoded, top_k, metric, broadcast_bytes)
    refused = encoded.filter(F.col("error").isNotNull()).select("qid", F.col("error").alias("_refused"))
    joined = asked.join(build_context(retrieved), "qid", "left").join(refused, "qid", "left")
    prompt = build_prompt(F.col("question"), F.col("context_text"), system_prompt)
    answered = joined.withColumn(
        "_made",
        generate_answers(
            prompt,
            generator_factory,
            model=model,
            temperature=temperature,
            max_tokens=max_tokens,
        ),
    )
    error = (
        F.when(tx.is_blank(F.col("question")), F.lit(BLANK_QUESTION))
        .when(F.col("_refused").isNotNull(), F.col("_refused"))
        .when(F.col("context_text").isNull(), F.lit(NO_CONTEXT))
        .otherwise(F.col("_made.error"))
    )
    return answered.select(
        "qid",
        "question",
        F.col("_made.answer").alias("answer"),
        "context",
        "context_metadata",
        F.lit(model).cast("string").alias("model"),
        F.lit(temperature).cast("double").alias("temperature"),
        F.coalesce("context_count", F.lit(0)).alias("context_count"),
        error.alias("error"),
    )


def answered(results: DataFrame) -> DataFrame:
    """The questions that were answered."""
    return results.filter(F.col("error").isNull()).drop("error")


def failed(results: DataFrame) -> DataFrame:
    """The questions that were not, with the reason."""
    return results.filter(F.col("error").isNotNull()).select("qid", "question", "error")


def rag_query(
    store: DataFrame | str,
    question: str,
    encoder_factory: EncoderFactory,
    generator_factory: GeneratorFactory,
    **options: Any,
) -> dict:
    """One question; raises ``ValueError`` where :func:`rag_batch` reports an error."""
    df, _ = resolve_store(store)
    asked = df.sparkSession.createDataFrame([(0, question)], "qid long, question string")
    row = rag_batch(store, asked, encoder_factory, generator_factory, **options).head()
    if row["error"] is not None:
        raise ValueError(row["error"])
    result = row.asDict(recursive=True)
    del result["qid"], result["error"]
    return result


def answer_quality(
    df: DataFrame,
    *,
    question_col: str = "question",
    answer_col: str = "answer",
    context_col: str = "context",
    ground_truth_col: str | None = None,
) -> DataFrame:
    """Add length and word-overlap metrics of each answer, all inside the JVM.

    ``context_col`` is an array of passages. Without ground truth (no column,
    NULL or empty) ``ground_truth_overlap`` is NULL.
    """
    answer, context = F.col(answer_col), F.col(context_col)
    answer_words = F.col("_answer_words")
    phrases = "|".join(INSUFFICIENT_CONTEXT_PHRASES)  # plain words, no regex characters
    truth = F.col(ground_truth_col) if ground_truth_col else F.lit(None).cast("string")

    def overlap(words: Column, reference: Column) -> Column:
        shared = F.size(F.array_intersect(words, answer_words))
        return shared / F.greatest(F.size(reference), F.lit(1))

    prepared = df.withColumns(
        {
            "_answer_words": tx.word_set(answer),
            "_question_words": tx.word_set(F.col(question_col)),
            "_context_words": tx.word_set(F.array_join(context, " ")),
            "_truth_words": tx.word_set(truth),
            "context_total_length": F.aggregate(
                context, F.lit(0).cast("long"), lambda total, x: total + F.length(x)
            ),
        }
    )
    return prepared.select(
        *df.columns,
        F.length(answer).alias("answer_length"),
        F.size(context).alias("context_count"),
        "context_total_length",
        (F.length(answer) / F.greatest("context_total_length", F.lit(1))).alias(
            "answer_to_context_ratio"
        ),
        F.lower(answer).rlike(phrases).alias("indicates_insufficient_context"),
        overlap(F.col("_question_words"), F.col("_question_words")).alias(
            "question_answer_overlap"
        ),
        overlap(F.col("_context_words"), answer_words).alias("context_answer_overlap"),
        F.when(F.coalesce(F.length(truth), F.lit(0)) > 0, overlap(
            F.col("_truth_words"), F.col("_truth_words")
        )).alias("ground_truth_overlap"),
    )
