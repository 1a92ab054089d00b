"""Weekly analytics, question routing and metric templates."""

import datetime as dt

import pytest

from moodtide.operators import metrics, trends

SCHEMA = (
    "subreddit string, week date, n_posts bigint, n_active_authors bigint, avg_word_count double, "
    "sentiment double, crisis_count bigint, crisis_rate double"
)
CUT = dt.date(2021, 6, 1)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def weekly(spark):
    rows = [
        ("sleep", day("2021-05-17"), 40, 31, 92.5, 0.05, 2, 0.05),
        ("sleep", day("2021-05-24"), 60, 44, 88.0, 0.11, 3, 0.05),
        ("sleep", day("2021-06-07"), 50, 37, 81.0, -0.02, 9, 0.18),
        ("running", day("2021-05-24"), 300, 210, 40.0, 0.31, 6, 0.02),
        ("running", day("2021-06-07"), 200, 150, 44.5, 0.37, 5, 0.025),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_view_puts_contract_columns_first(weekly):
    view = trends.weekly_view(weekly)
    assert tuple(view.columns[:6]) == trends.WEEKLY_VIEW
    assert view.columns[6:] == ["n_active_authors", "avg_word_count"]


def test_kpis(weekly, empty):
    row = trends.kpis(weekly).first()
    assert (row["communities"], row["total_posts"]) == (2, 650)
    assert row["crisis_share"] == pytest.approx(25 / 650)
    assert row["avg_sentiment"] == pytest.approx(0.82 / 5)
    assert trends.kpis(empty).first().asDict() == {
        "communities": 0, "total_posts": 0, "avg_sentiment": 0.0, "crisis_share": 0.0
    }


def test_event_impact(weekly, empty, spark):
    rows = {r["subreddit"]: r for r in trends.event_impact(weekly, CUT).collect()}
    assert rows["sleep"]["sentiment_delta"] == -0.1  # -0.02 after a mean of 0.08
    assert rows["sleep"]["crisis_rate_delta"] == 0.13 and rows["running"]["sentiment_delta"] == 0.06
    assert (rows["sleep"]["posts_pre"], rows["sleep"]["posts_post"]) == (100, 50)
    assert trends.event_impact(weekly, dt.date(2022, 1, 1)).count() == 0
    assert trends.event_impact(empty, CUT).count() == 0
    one_sided = weekly.where("NOT (subreddit = 'sleep' AND week < '2021-06-01')")
    assert [r["subreddit"] for r in trends.event_impact(one_sided, CUT).collect()] == ["running"]


def test_spans(weekly, empty):
    assert trends.spans(weekly, CUT).first()[0] is True
    assert trends.spans(weekly, dt.date(2021, 6, 8)).first()[0] is False
    assert trends.spans(empty, CUT).first()[0] is False


def test_smooth(spark):
    values = [0.2, 0.4, 0.9, None, None, None, -0.5]
    rows = [("x", day("2021-01-04") + dt.timedelta(weeks=i), 1, 1, 1.0, v, 0, v) for i, v in enumerate(values)]
    series = spark.createDataFrame(rows, SCHEMA)
    got = [r["sentiment"] for r in trends.smooth(series, 3).orderBy("week").collect()]
    assert got == [pytest.approx(0.2), pytest.approx(0.3), pytest.approx(0.5), pytest.approx(0.65),
                   pytest.approx(0.9), None, pytest.approx(-0.5)]
    assert trends.smooth(series, 1) is series


def test_overview(spark, weekly):
    zero = spark.createDataFrame([("quiet", day("2021-05-17"), 0, 0, 0.0, 0.5, 0, 0.0)], SCHEMA)
    rows = [r.asDict() for r in trends.ranked_overview(weekly.union(zero)).collect()]
    assert [r["subreddit"] for r in rows] == ["running", "sleep", "quiet"]
    assert rows[2]["crisis_share"] == 0.0
    assert rows[1]["crisis_share"] == 0.0933 and rows[1]["avg_sentiment"] == 0.047


def test_pivots(weekly):
    matrix = trends.sentiment_pivot(weekly)
    assert matrix.columns == ["week", "running", "sleep"]
    assert trends.crisis_volume_pivot(weekly, ["sleep"]).orderBy("week").first()[1] == 2
    assert [r["week"] for r in trends.trend_tail(matrix, 2).collect()] == [day("2021-05-24"), day("2021-06-07")]


def test_window_filter(weekly):
    view = trends.select_window(weekly, ["sleep"], day("2021-05-24"), day("2021-06-07"))
    assert view.count() == 2
    assert trends.select_window(weekly).count() == 5


def test_answers(spark, weekly, empty):
    questions = spark.createDataFrame(
        [(1, "how is sleep doing?"), (2, "who wrote that"), (3, " "), (4, None)],
        "id int, question string",
    )
    got = {r["id"]: r["answer"] for r in trends.route_questions(questions, weekly).collect()}
    assert "**r/sleep** (+0.047)" in got[1] and "**r/sleep** (9.3%)" in got[1] and "aggregate" in got[1]
    assert got[2] == trends.REFUSAL and got[3] == got[4] == trends.HINT
    lost = {r["id"]: r["answer"] for r in trends.route_questions(questions, empty).collect()}
    assert lost[1] == trends.NO_DATA and lost[2] == trends.REFUSAL


def test_unscored_data_still_answers(spark, weekly):
    from pyspark.sql import functions as F

    unscored = weekly.withColumns({c: F.lit(None).cast("double") for c in ("sentiment", "crisis_rate")})
    answer = trends.answer_sentence(unscored).first()["answer"]
    assert "(n/a)" in answer


def test_metric_templates(weekly):
    span = {"first_week": day("2021-05-17"), "last_week": day("2021-06-07")}
    rise = metrics.run_metric(weekly, "largest_rise", **span).first()
    assert rise["subreddit"] == "sleep" and rise["rise"] == pytest.approx(0.13)
    assert metrics.run_metric(weekly, "community_trend", subreddit="running", **span).count() == 2
    injected = metrics.run_metric(weekly, "community_trend", subreddit="x' OR '1'='1", **span)
    assert injected.count() == 0
    with pytest.raises(KeyError, match="unknown metric"):
        metrics.run_metric(weekly, "SELECT 1")
    with pytest.raises(ValueError, match="takes"):
        metrics.run_metric(weekly, "largest_rise", first_week=day("2021-05-17"))
