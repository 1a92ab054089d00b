"""The registered operators against their DuckDB twins, on the smallest tables; those without SQL are tested beside their operators."""

import os

import pytest

from moodtide.llm import queries as llm
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query(spark, duck, name):
    assert compare(llm.QUERIES[name](spark, SF_DIR), duck, llm.ORACLE[name]) == []


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in llm.QUERIES] == list(range(1, 14))
    assert set(llm.ORACLE) <= set(llm.QUERIES)
