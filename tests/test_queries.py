"""Every registered query against its DuckDB twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from moodtide.bindings import queries as registry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    twin = driver.oracle_sql().get(name)
    if twin is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, twin) == []


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plans_stay_in_the_jvm(spark, plan_of, name):
    """Python only behind the pluggable scorer, the vector search and the automaton of all lexicons; no cross joins."""
    batches = {"lexicon_scan", "score_posts_batched", "topk_retrieval", "topk_by_topic", "retrieval_eval", "retrieval_passages"}
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in batches:
        assert "Python" not in plan and "MapIn" not in plan
