"""Incremental weekly Gold: equal to a full rebuild, and nothing but the touched weeks is written."""

import datetime as dt
import os

import pytest

from moodtide.operators import gold
from moodtide.plans import weekly_state as W
from moodtide.schemas import GOLD_POSTS


def posts(spark, first, n, week0=0, weeks=4, scored=True):
    rows = []
    for i in range(first, first + n):
        day = dt.date(2020, 1, 6) + dt.timedelta(weeks=week0 + i % weeks, days=i % 7)
        week = day - dt.timedelta(days=day.weekday())
        author = None if i % 13 == 0 else f"a{i % 11}"
        rows.append((f"p{i}", None if i % 29 == 0 else ["sleep", "adhd", "sleep"][i % 3], day, None if i % 31 == 0 else week, author, i, i % 9 + 1,
                     (i % 7 - 3) / 4 if scored and i % 5 else None, "neutral" if scored and i % 5 else None, None, i % 4 == 0 if scored and i % 3 else None))
    return spark.createDataFrame(rows, GOLD_POSTS)


def rows_of(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def files(root, table):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/{table}") for f in names if f.endswith(".parquet")}


def test_equals_a_full_rebuild_and_writes_only_the_touched_weeks(spark, tmp_path):
    root = str(tmp_path)
    one, two = posts(spark, 0, 300, weeks=8), posts(spark, 300, 60, week0=6, weeks=3)
    assert len(W.add_batch(one, root, "b1")) == 8
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one))
    before = {t: files(root, t) for t in ("weekly", "sums", "authors", "posts")}
    touched = W.add_batch(two, root, "b2")
    assert len(touched) == 3
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one.union(two)))
    for table, old in before.items():
        new = files(root, table)
        assert {f for f in old - new} == ({f for f in old if any(f"span={w}/" in f for w in touched)} if table == "weekly" else set())
        assert all(any(f"span={w}/" in f for w in touched) for f in new - old)


def test_a_batch_given_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    one, two = posts(spark, 0, 200), posts(spark, 200, 100, week0=3)
    for batch, rows in (("b1", one), ("b2", two), ("b2", two), ("b1", one)):
        W.add_batch(rows, root, batch)
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one.union(two)))
    fewer = posts(spark, 200, 100, week0=5, weeks=1)
    gone = W.add_batch(fewer, root, "b2")
    assert len(gone) == 4
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one.union(fewer)))


def test_a_run_that_failed_half_way_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    one, two = posts(spark, 0, 200), posts(spark, 200, 100, week0=1)
    W.add_batch(one, root, "b1")
    with monkeypatch.context() as m:
        m.setattr(W, "_rolled", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            W.add_batch(two, root, "b2")
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one))
    W.add_batch(two, root, "b2")
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(one.union(two)))


def test_scores_renew_their_weeks_only(spark, tmp_path):
    root = str(tmp_path)
    one = posts(spark, 0, 240, weeks=6, scored=False)
    W.add_batch(one.where("cast(substring(post_id, 2, 9) as int) < 150"), root, "b1")
    W.add_batch(one.where("cast(substring(post_id, 2, 9) as int) >= 150"), root, "b2")
    week = dt.date(2020, 1, 13)
    scores = one.where(f"week = '{week}'").selectExpr("post_id", "n_words / 10.0D AS sentiment_score", "'positive' AS sentiment_label")
    old = files(root, "weekly")
    assert W.rescore(spark, root, scores, gold.SENTIMENT_COLUMNS) == [week]
    assert all(f"span={week}/" in f for f in files(root, "weekly") ^ old)
    assert rows_of(W.read_weekly(spark, root)) == rows_of(gold.weekly_rollup(gold.apply_scores(one, scores, gold.SENTIMENT_COLUMNS)))
    more = scores.join(one.where("subreddit is not null"), "post_id", "left_semi").orderBy("post_id").limit(3).selectExpr("post_id", "-0.5D AS sentiment_score", "'negative' AS sentiment_label")
    W.rescore(spark, root, more, gold.SENTIMENT_COLUMNS)
    assert W.read_posts(spark, root).where("sentiment_label = 'negative'").count() == 3
    assert W.read_posts(spark, root).where("sentiment_label is not null").count() == scores.join(one.where("subreddit is not null"), "post_id", "left_semi").count()
    assert W.rescore(spark, root, scores.limit(0), gold.SENTIMENT_COLUMNS) == []


@pytest.mark.parametrize("span", ["month", "year"])
def test_longer_spans(spark, tmp_path, span):
    one, two = posts(spark, 0, 200, weeks=9), posts(spark, 200, 100, week0=7)
    assert len(W.add_batch(one, str(tmp_path), "b1", span)) == (3 if span == "month" else 1)
    W.add_batch(two, str(tmp_path), "b2", span)
    assert rows_of(W.read_weekly(spark, str(tmp_path))) == rows_of(gold.weekly_rollup(one.union(two)))


def test_empty_batch(spark, tmp_path):
    assert W.add_batch(posts(spark, 0, 5).limit(0), str(tmp_path), "b1") == []
    assert W.read_weekly(spark, str(tmp_path)).count() == 0
