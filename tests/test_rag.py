"""Batch question answering and answer metrics."""

import pytest
from pyspark.sql import functions as F

from sparkvec.operators import rag
from sparkvec.operators.encoding import HashEncoderFactory, encode_documents

ENCODER = HashEncoderFactory(32)
TEXTS = ["alpha beta gamma", "delta " * 300, "alpha beta\nsecond line", "zeta eta"]


@pytest.fixture(scope="module")
def store(spark):
    rows = [(i, t, "{}") for i, t in enumerate(TEXTS)]
    return encode_documents(
        spark.createDataFrame(rows, "id long, document_text string, metadata string"), ENCODER
    )


class Flaky:
    def generate(self, prompt, model, temperature, max_tokens):
        if "boom" in prompt:
            raise RuntimeError("the model is down")
        if "silent" in prompt:
            return "  "
        return f" {model} {temperature} {max_tokens} "


def test_context_and_prompt(spark, store):
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "delta")], "qid long, question string")
    found = rag.retrieve_context(store, asked, ENCODER, top_k=2)
    context = {r.qid: r for r in rag.build_context(found).collect()}
    first = context[1]
    assert [m["id"] for m in first.context_metadata] == [2, 0] or first.context_count == 2
    assert first.context_text.startswith("[Context 1]: alpha beta")
    assert "\n\n[Context 2]: " in first.context_text
    long = context[2]
    assert long.context[0] == TEXTS[1]
    assert long.context_text.startswith("[Context 1]: " + TEXTS[1][:1000] + "...")
    whole = rag.build_context(found, cut=None).filter("qid = 2").head()
    assert whole.context_text.startswith("[Context 1]: " + TEXTS[1])
    prompt = spark.range(1).select(
        rag.build_prompt(F.lit("why?"), F.lit("because"), "Be brief.").alias("p")
    ).head().p
    assert prompt == "Be brief.\n\nContext:\nbecause\n\nQuestion: why?\n\nAnswer:"


def test_batch_isolates_errors(spark, store):
    asked = spark.createDataFrame(
        [(0, "alpha"), (1, "boom"), (2, "  "), (3, "silent"), (4, None)],
        "qid long, question string",
    )
    results = rag.rag_batch(store, asked, ENCODER, Flaky, model="m", top_k=2)
    rows = {r.qid: r for r in results.collect()}
    assert len(rows) == 5
    assert rows[0].answer == "m 0.2 1024" and rows[0].error is None and rows[0].context_count == 2
    assert rows[1].error == "the model is down" and rows[1].answer is None
    assert rows[2].error == rag.BLANK_QUESTION and rows[4].error == rag.BLANK_QUESTION
    assert rows[3].error == rag.BLANK_ANSWER
    assert [r.qid for r in rag.answered(results).collect()] == [0]
    assert sorted(r.qid for r in rag.failed(results).collect()) == [1, 2, 3, 4]


def test_no_context(spark, store):
    asked = spark.createDataFrame([(0, "alpha")], "qid long, question string")
    empty = store.filter(F.col("id") < 0)
    assert rag.rag_batch(empty, asked, ENCODER, Flaky).head().error == rag.NO_CONTEXT


def test_single_query(store):
    got = rag.rag_query(store, "alpha beta gamma", ENCODER, rag.ExtractiveGenerator, top_k=1)
    assert got["answer"] == "alpha beta gamma" and got["context"] == ["alpha beta gamma"]
    assert got["context_metadata"][0]["id"] == 0 and got["temperature"] == 0.2
    with pytest.raises(ValueError, match="blank"):
        rag.rag_query(store, " ", ENCODER, rag.ExtractiveGenerator)


def test_answer_quality(spark):
    df = spark.createDataFrame(
        [
            ("what is spark", "spark is fast", ["spark is a fast engine"], "spark is a fast engine"),
            ("q", "I cannot answer this", [], None),
            ("", "", ["x"], ""),
        ],
        "question string, answer string, context array<string>, ground_truth string",
    )
    rows = rag.answer_quality(df, ground_truth_col="ground_truth").collect()
    one = rows[0]
    assert (one.answer_length, one.context_count, one.context_total_length) == (13, 1, 22)
    assert one.answer_to_context_ratio == pytest.approx(13 / 22)
    assert one.question_answer_overlap == pytest.approx(2 / 3)
    assert one.context_answer_overlap == pytest.approx(1.0)
    assert one.ground_truth_overlap == pytest.approx(3 / 5)
    assert one.indicates_insufficient_context is False
    assert rows[1].indicates_insufficient_context is True
    assert rows[1].ground_truth_overlap is None and rows[1].answer_to_context_ratio == 20
    assert rows[2].question_answer_overlap == 0 and rows[2].ground_truth_overlap is None
