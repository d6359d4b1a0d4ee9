"""The driver contract, and every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare, connect

LLM = entry.llm.QUERIES.keys() | {"pipeline"} if entry.llm else set()
QUERIES = {name: query for name, query in entry.queries().items() if name not in LLM}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name not in LLM}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "document_text", "metadata", "distance"] and df.count() == 10


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"ann_topk"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    verdict, _ = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_probing_some_cells_finds_most_neighbours(spark, sf_dir):
    def pairs(name):
        return {(r.qid, r.id) for r in QUERIES[name](spark, sf_dir).collect()}

    exact, some = pairs("ann_topk_all_cells"), pairs("ann_topk")
    assert len(exact & some) / len(exact) > 0.5
