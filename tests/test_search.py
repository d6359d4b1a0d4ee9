"""Single-query searches on small stores with known answers."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from sparkvec.operators import cells, knn, postings, search
from sparkvec.operators import stats as ss
from sparkvec.operators.encoding import HashEncoderFactory, encode_documents
from sparkvec.operators.postings import matches, write_postings

ENCODER = HashEncoderFactory(32)
TEXTS = [
    "spark makes large tables small",
    "the cat sat on the mat",
    "large cats and small cats",
    "vectors of words and words of vectors",
    "spark spark spark",
    "the cat sat on the mat",
]
META = [
    '{"lang":"en","n":1,"ok":true,"a":{"b":"deep"}}',
    '{"lang":"de","n":"1","ok":"true"}',
    '{"lang":"en","n":1.0,"a.b":"flat"}',
    '{"lang":"fr","n":2.5}',
    "not json",
    None,
]


@pytest.fixture(scope="module")
def store(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (i, t, m, start + datetime.timedelta(days=i)) for i, (t, m) in enumerate(zip(TEXTS, META))
    ]
    df = spark.createDataFrame(
        rows, "id long, document_text string, metadata string, created_at timestamp"
    )
    return encode_documents(df, ENCODER)


def ids(df):
    return [r.id for r in df.collect()]


def test_semantic_search(store):
    found = search.semantic_search(
        store, "the cat sat on the mat", top_k=3, encoder_factory=ENCODER, include_distance=True
    ).collect()
    assert [r.id for r in found[:2]] == [1, 5]  # the same text: a tie, smaller id first
    assert found[0].distance == pytest.approx(0.0, abs=1e-6)
    assert found[2].distance > 0.01
    plain = search.semantic_search(store, "the cat sat on the mat", top_k=3, encoder_factory=ENCODER)
    assert plain.columns == ["id", "document_text", "metadata"]
    assert ids(plain) == [r.id for r in found]


def test_threshold_applies_without_distances(store):
    near = search.semantic_search(
        store, TEXTS[1], top_k=6, encoder_factory=ENCODER, distance_threshold=0.01
    )
    assert ids(near) == [1, 5]


@pytest.mark.parametrize("query", ["", "  ", None])
def test_blank_queries(store, query):
    with pytest.raises((ValueError, TypeError)):
        search.semantic_search(store, query, encoder_factory=ENCODER)


@pytest.mark.parametrize("k", [0, -1, 1001])
def test_bad_k(store, k):
    with pytest.raises(ValueError):
        search.semantic_search(store, "x", top_k=k, encoder_factory=ENCODER)


def test_other_bad_arguments(store):
    with pytest.raises(ValueError, match="metric"):
        search.semantic_search(store, "x", encoder_factory=ENCODER, metric="dot")
    with pytest.raises(ValueError, match="exist"):
        search.semantic_search("no_such_table", "x", encoder_factory=ENCODER)
    with pytest.raises(ValueError, match="encoder_factory"):
        search.semantic_search(store, "x")
    with pytest.raises(ValueError, match="sum to 1"):
        search.hybrid_search(store, "x", text_weight=0.5, vector_weight=0.6, encoder_factory=ENCODER)


def test_find_similar(store):
    assert ids(search.find_similar_documents(store, 1, top_k=1)) == [5]
    with_self = search.find_similar_documents(
        store, 1, top_k=2, exclude_self=False, include_distance=True
    ).collect()
    assert with_self[0].id == 1 and with_self[0].distance == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError, match="no document"):
        search.find_similar_documents(store, 99)


def test_many_queries_equal_single_queries(spark, store):
    asked = encode_documents(
        spark.createDataFrame(list(enumerate(TEXTS[:4])), "qid long, document_text string"), ENCODER
    )
    many = knn.batch_topk(store, asked, top_k=4, keep=("document_text",)).orderBy("qid", "rn").collect()
    for qid in range(4):
        single = search.semantic_search(store, TEXTS[qid], top_k=4, encoder_factory=ENCODER)
        assert [r.id for r in many if r.qid == qid] == ids(single)
    assert all(r.document_text == TEXTS[r.id] for r in many)


def test_adhoc_similarity(store):
    df = store.select(F.col("id").alias("index"), F.col("document_text").alias("text"), "embedding")
    got = search.similarity_search(df, TEXTS[4], top_k=2, encoder_factory=ENCODER)
    assert got.columns == ["index", "text", "distance"] and got.head()["index"] == 4


def test_text_score(store):
    got = {r.id: r.match for r in search.text_score(store, "Spark the of nothing").collect()}
    spark_idf, the_idf = math.log10(6 / 2) ** 2, math.log10(6 / 2) ** 2
    assert got[0] == pytest.approx(spark_idf) and got[4] == pytest.approx(3 * spark_idf)
    assert got[1] == pytest.approx(2 * the_idf) and got[3] == 0.0  # "of" is too short
    assert {r.match for r in search.text_score(store, "a an").collect()} == {0.0}
    stopped = search.text_score(store, "spark the", stop_words=("the",)).collect()
    assert {r.id for r in stopped if r.match > 0} == {0, 4}


def test_hybrid(store):
    got = search.hybrid_search(
        store, "spark words", top_k=6, encoder_factory=ENCODER, include_distance=True
    ).collect()
    vector = search.encode_query("spark words", ENCODER)
    scored = search.text_score(store, "spark words").select(
        "id", "match", search.distance_to(F.col("embedding"), vector).alias("d")
    )
    want = sorted(
        (round(0.3 * (1 - r.match) + 0.7 * r.d, 9), r.id)
        for r in scored.collect()
        if r.match > 0 or r.d < 1.0
    )
    assert [(round(r.combined_score, 9), r.id) for r in got] == want
    plain = search.hybrid_search(store, "spark words", encoder_factory=ENCODER)
    assert "combined_score" not in plain.columns


@pytest.mark.parametrize(
    "filters,want",
    [
        ({"lang": "en"}, [2, 0]),
        ({"n": 1}, [2, 0]),
        ({"n": "1"}, [1]),
        ({"n": 2.5}, [3]),
        ({"ok": True}, [0]),
        ({"ok": "true"}, [1]),
        ({"lang": ["de", "fr"]}, [3, 1]),
        ({"n": ["1", 2.5]}, [3, 1]),
        ({"lang": "en", "n": [1, 2]}, [2, 0]),
        ({"a.b": "deep"}, [0]),
        ({"missing": "x"}, []),
    ],
)
def test_metadata(store, filters, want):
    got = search.search_by_metadata(store, filters)
    assert got.columns == ["id", "document_text", "metadata", "created_at"]
    assert ids(got) == want


@pytest.mark.parametrize("filters", [{}, {"a": []}, {"a": None}, {"a": {"b": 1}}, {"a": [None]}])
def test_bad_metadata_filters(store, filters):
    with pytest.raises(ValueError):
        search.search_by_metadata(store, filters)


def test_statistics(store):
    got = ss.search_statistics(store).head()
    assert got.total_documents == 6 and got.table_config == "unknown"
    assert got.avg_text_length == pytest.approx(sum(map(len, TEXTS)) / 6)
    assert got.oldest_document < got.newest_document
    assert got.metadata_fields == ["a", "a.b", "lang", "n", "ok"]
    empty = ss.search_statistics(store.filter("false")).head()
    assert tuple(empty)[:4] == (0, 0.0, None, None) and empty.metadata_fields == []
    assert [r.field for r in ss.metadata_fields(store).collect()] == got.metadata_fields
    assert got.metadata_field_count == 5 and empty.metadata_field_count == 0
    many = ss.search_statistics(store, field_limit=4).head()
    assert (many.total_documents, many.metadata_field_count, many.metadata_fields) == (6, 5, None)
    rag = ss.rag_statistics(store, table="t", encoder_factory=ENCODER, embedding_model="hash").head()
    assert (rag.table, rag.embedding_dimension, rag.distance_metric) == ("t", 32, "unknown")


def test_cells(spark, store, tmp_path):
    index = cells.fit_cells(store, cells=3)
    placed = cells.assign_cells(store, index)
    assert placed.count() == 6
    asked = store.select(F.col("id").alias("qid"), "embedding")

    def result(df):
        return sorted((r.qid, r.rn, r.id) for r in df.collect())

    exact = result(knn.batch_topk(store, asked, top_k=3))
    for bound in (1 << 20, 400):
        got = cells.approximate_topk(
            placed, asked, index, probes=3, top_k=3, broadcast_bytes=bound
        )
        assert result(got) == exact
    path = str(tmp_path / "cells")
    cells.write_cells(store, index, path)
    stored = cells.read_cells(spark, path)
    few = cells.approximate_topk(stored, asked, index, probes=1, top_k=1)
    assert [(r.qid, r.id) for r in few.orderBy("qid").collect()][0] == (0, 0)
    with pytest.raises(ValueError):
        cells.approximate_topk(placed, asked, index, probes=4)
    with pytest.raises(ValueError):
        cells.fit_cells(store, cells=1)


def test_given_cells(spark, store):
    index = cells.given_cells(store, cells=3)
    assert index.cells == 3 and index.centroids.tolist() == cells.given_cells(store.repartition(4), cells=3).centroids.tolist()
    asked = store.select(F.col("id").alias("qid"), "embedding")
    got = cells.approximate_topk(cells.assign_cells(store, index), asked, index, probes=3, top_k=3)
    exact = knn.batch_topk(store, asked, top_k=3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.collect()))
    assert cells.given_cells(store, cells=99).cells == 6
    for bad in ({"cells": 1}, {"cells": 2, "metric": "other"}):
        with pytest.raises(ValueError):
            cells.given_cells(store, **bad)
    with pytest.raises(ValueError):
        cells.given_cells(store.limit(0), cells=2)


def test_probed_cells_prune_folders(spark, store, tmp_path):
    index = cells.fit_cells(store, cells=3)
    path = str(tmp_path / "pruned")
    cells.write_cells(store, index, path)
    one = store.filter("id = 1").select(F.col("id").alias("qid"), "embedding")
    found = cells.approximate_topk(cells.read_cells(spark, path), one, index, probes=1, top_k=2)
    plan = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1][:80]
    assert [r.id for r in found.orderBy("rn").collect()] == [1, 5]


def test_distance_is_computed_once(store):
    """A filter on the distance must not repeat the encoder or the kernel."""
    found = search.hybrid_search(store, "spark words", encoder_factory=ENCODER)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("encode(") == 1 and plan.count("kernel(") == 1


def test_postings_score_as_the_texts_do(spark, store, tmp_path):
    """Without a look at the texts, and with files that a word's filter can skip."""
    extra = [(100 + i, f"the spark {i % 3} word{i} " + "often " * (i % 4)) for i in range(60)] + [(200, None), (201, " \n"), (202, "Ünï the THE")]
    rows = store.select("id", "document_text").unionByName(spark.createDataFrame(extra, "id long, document_text string"))
    path = str(tmp_path / "index")
    write_postings(rows, path)
    for query in ("Spark the often", "word7 ünï", "absent words entirely", "a an"):
        want = {r.id: round(r.match, 9) for r in search.text_score(rows, query).collect()}
        indexed = search.text_score(rows.select("id"), query, postings=path)
        assert {r.id: round(r.match, 9) for r in indexed.collect()} == want
    plan = matches(spark, path, ["word7"])._jdf.queryExecution().executedPlan().toString()
    assert "In(word, [word7])" in plan or "EqualTo(word,word7)" in plan
    own = str(tmp_path / "own")
    write_postings(store, own)
    asked = {"top_k": 6, "encoder_factory": ENCODER, "include_distance": True}
    whole = [tuple(r) for r in _rounded(search.hybrid_search(store, "spark words", **asked)).collect()]
    assert [tuple(r) for r in _rounded(search.hybrid_search(store, "spark words", **asked, postings=own)).collect()] == whole
    wide = search.hybrid_search(store, "spark words", **asked | {"top_k": 5000}, postings=own)
    assert [r.id for r in wide.collect()] == [r[0] for r in whole]


def _rounded(found):
    return found.select("id", "document_text", "metadata", F.round("combined_score", 9))


def test_words_are_counted_without_being_moved(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, "b"), (2, "b c"), (3, None)], "id long, document_text string")
    counted = postings._counted(rows, "id", "document_text")
    assert sorted(map(tuple, counted.collect())) == [("a", 1, 2), ("b", 1, 1), ("b", 2, 2), ("c", 2, 1)]
    plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_cells_searched_in_blocks_of_queries(spark, store, monkeypatch):
    index = cells.fit_cells(store, cells=3)
    placed = cells.assign_cells(store, index)
    asked = store.select(F.col("id").alias("qid"), "embedding")

    def found():
        rows = cells.approximate_topk(placed, asked, index, probes=2, top_k=2, exclude_same_id=True)
        return sorted((r.qid, r.rn, r.id) for r in rows.collect())

    whole, blocks = found(), []
    partial = knn._partial_topk
    monkeypatch.setattr(knn, "BLOCK_BYTES", 700)
    monkeypatch.setattr(knn, "_partial_topk", lambda *a, **b: blocks.append(a[2].num_rows) or partial(*a, **b))
    assert found() == whole
    assert len(blocks) > 1 and sum(blocks) == len(TEXTS)
