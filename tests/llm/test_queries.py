"""The registered queries of the subpackage, and their SQL twins."""

import pytest

import __spark_entry__ as entry
from sparkvec.llm.registered import ORACLES, QUERIES
from tools.check_oracles import compare, connect


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    con = connect(sf_dir)
    verdict, _ = compare(spark, con, name, entry.queries()[name], ORACLES.get(name), sf_dir)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_all_are_there():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
