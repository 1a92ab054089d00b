"""The shared folder."""

import os
from types import SimpleNamespace

import pytest

from moodtide import session


def fake(master, **settings):
    conf = SimpleNamespace(get=lambda k, default=None: settings.get(k, default), set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_named_folder_is_used():
    named = {"spark.checkpoint.dir": "hdfs://x/shared/"}
    assert session.shared_root(fake("yarn", **named)) == "hdfs://x/shared"


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="shared folder"):
        session.shared_root(fake("spark://host:7077"))


def test_local_session_keeps_one_folder():
    local = fake("local[2]")
    assert session.shared_root(local) == session.shared_root(local)


def test_materialize_cuts_lineage(spark, plan_of):
    written = session.materialize(spark.range(100).selectExpr("id", "id % 3 AS r"), "numbers")
    assert "Range" not in plan_of(written) and written.count() == 100


def test_intermediate_tables_go_with_their_run(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.run_scratch(spark) as folder:
        df = session.materialize(spark.range(5), "numbers")
        with session.run_scratch(spark) as inner:
            assert session.materialize(df, "again").count() == 5 and os.path.isdir(inner)
        assert not os.path.exists(inner)
        assert df.count() == 5 and len(os.listdir(folder)) == 1
        assert session.scratch_dir(spark, "x").startswith(folder)
    assert not os.path.exists(folder)
    assert kept.count() == 3 and "run-" not in session.scratch_dir(spark, "x")
