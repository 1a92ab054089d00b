"""Scorers, weak labels, features, split, classifier and metrics."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from moodtide.bindings import views
from moodtide.operators import scoring, signal


class FakeScorer:
    def score_texts(self, texts):
        table = {"sunny": [0.125, 0.25, 0.625], "rainy": [0.5, 0.25, 0.25]}
        return np.array([table.get(t, [0.25, 0.5, 0.25]) for t in texts])


def test_batch_scorer(spark):
    texts = ["sunny", "rainy", None, "cloudy " * 50, "sunny"] * 20
    posts = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "post_id string, text string")
    rows = {r["post_id"]: r for r in scoring.score_posts(posts, FakeScorer, batch_rows=7).collect()}
    assert len(rows) == 100
    for i, t in enumerate(texts):
        expected = {"sunny": (0.5, "positive"), "rainy": (-0.25, "negative")}.get(t, (0.0, "neutral"))
        assert (rows[f"p{i}"]["sentiment_score"], rows[f"p{i}"]["sentiment_label"]) == expected


def test_tasks_see_posts_by_length(spark):
    posts = spark.range(500).select(
        F.col("id").cast("string").alias("post_id"),
        F.repeat(F.lit("x"), (F.col("id") * 37 % 101).cast("int")).alias("text"),
    )
    ordered = scoring.length_ordered(posts, 4).select(F.spark_partition_id().alias("p"), F.length("text").alias("n"))
    by_task = {}
    for r in ordered.collect():
        by_task.setdefault(r["p"], []).append(r["n"])
    assert len(by_task) == 4
    assert all(lengths == sorted(lengths) for lengths in by_task.values())


def test_resume_scores_only_what_is_missing(spark):
    posts = spark.createDataFrame([("a", "sunny"), ("b", "rainy"), ("c", "x")], "post_id string, text string")
    done = spark.createDataFrame([("a", 9.0, "old")], "post_id string, sentiment_score double, sentiment_label string")
    seen = []

    def score(rows):
        seen.extend(r["post_id"] for r in rows.collect())
        return scoring.score_posts(rows, FakeScorer)

    scores = {r["post_id"]: r["sentiment_score"] for r in scoring.resume_scoring(posts, done, score).collect()}
    assert sorted(seen) == ["b", "c"] and scores == {"a": 9.0, "b": -0.25, "c": 0.0}


def test_label_ties_go_to_the_earlier_class(spark):
    df = spark.createDataFrame([([0.4, 0.2, 0.4],), ([0.2, 0.4, 0.4],)], "probabilities array<double>")
    assert [r["sentiment_label"] for r in scoring.score_probabilities(df).collect()] == ["negative", "neutral"]


def test_label_shares_and_agreement(spark):
    rows = [("negative", "negative", -0.5), ("neutral", "mixed", 0.0), ("positive", "negative", 0.25), (None, None, None)]
    df = spark.createDataFrame(rows, "sentiment_label string, review string, sentiment_score double")
    shares = scoring.label_shares(df).collect()
    assert all(r["n_scored"] == 3 and r["share"] == pytest.approx(1 / 3) for r in shares)
    assert shares[0]["mean_sentiment"] == pytest.approx(-0.25 / 3)
    cell = scoring.label_agreement(df, "sentiment_label", "review", "sentiment_score").first()
    assert cell["exact_agreement"] == pytest.approx(1 / 3)
    assert cell["compatible_agreement"] == pytest.approx(2 / 3)


def test_weak_labels(spark):
    table = [
        ("I want to KILL MYSELF", 1),
        ("I feel hopeless", 0),
        ("hopeless and worthless", 1),
        ("such hopelessness", 1),  # holds "hopeless" too
        ("a crisis, crisis, crisis", 0),
        ("a good day", 0),
        ("", 0),
        (None, 0),
    ]
    posts = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(table)], "post_id string, text string")
    rows = {r["post_id"]: r["label"] for r in signal.weak_labels(posts).collect()}
    assert [rows[str(i)] for i in range(len(table))] == [y for _, y in table]


def test_features(spark):
    silver = spark.createDataFrame(
        [("a", "I am hopeless, I will never stop"), ("b", None)], "post_id string, text string"
    )
    posts = spark.createDataFrame([("a", -0.5), ("b", None)], "post_id string, sentiment_score double")
    rows = {r["post_id"]: r for r in signal.build_features(silver, posts).collect()}
    a, b = rows["a"], rows["b"]
    assert a["severe_density"] == pytest.approx(100 / 7)
    assert a["first_person_density"] == pytest.approx(200 / 7)
    assert a["negation_density"] == pytest.approx(100 / 7)
    assert a["sentiment_score"] == -0.5 and a["log_n_words"] == pytest.approx(np.log(8))
    assert b["sentiment_score"] == 0.0 and b["log_n_words"] == pytest.approx(np.log(2))
    with pytest.raises(RuntimeError, match="sentiment"):
        signal.build_features(silver, posts.withColumn("sentiment_score", F.lit(None).cast("double")))
    both = {r["post_id"]: r["label"] for r in signal.training_rows(silver, posts).collect()}
    assert both == {"a": 0, "b": 0}


def test_training_rows_lower_a_text_once(spark, plan_of):
    """Label, sentiment and densities look for their terms in one projection."""
    posts = spark.createDataFrame([("a", "Trash, with my IDIOT friend"), ("b", None)], "post_id string, text string")
    rows = views.training_rows_of(posts)
    assert sum("lower(" in line for line in plan_of(rows).splitlines()) == 1
    got = {r["post_id"]: r for r in rows.collect()}
    assert (got["a"]["label"], got["a"]["sentiment_score"], got["a"]["severe_density"]) == (1, -0.25, 40.0)
    assert (got["a"]["first_person_density"], got["b"]["label"], got["b"]["sentiment_score"]) == (20.0, 0, 0.0)


@pytest.mark.parametrize("sizes", [(80, 20), (997, 3), (1, 1), (0, 7), (333, 333)])
def test_split_is_exact_per_label(spark, sizes):
    rows = [(f"{y}-{i}", y) for y, n in enumerate(sizes) for i in range(n)]
    split = signal.stratified_split(spark.createDataFrame(rows, "post_id string, label bigint"))
    got = {(r["label"], r["is_train"]): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    total, target = sum(sizes), int(0.8 * sum(sizes))
    assert sum(n for (_, train), n in got.items() if train) == target
    for y, n in enumerate(sizes):
        assert abs(got.get((y, True), 0) - target * n / total) < 1
    again = signal.stratified_split(spark.createDataFrame(rows[::-1], "post_id string, label bigint"))
    assert sorted(split.collect()) == sorted(again.collect())


def test_split_of_text_never_ranks_a_whole_label(spark, plan_of):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("post_id"), (F.col("id") % 2).alias("label"))
    plan = plan_of(signal.stratified_split(rows))
    top = plan.split("Subquery")[0]
    assert "Window" not in top and "Exchange" not in top and "Join" not in top


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.RandomState(0)
    y = (rng.rand(600) < 0.25).astype(int)
    x = rng.rand(600, 5) * [10, 8, 6, 2, 5] + y[:, None] * [3, 1, 0.5, -0.7, 0.2]
    rows = [(f"p{i}", *map(float, x[i]), int(y[i])) for i in range(600)]
    schema = "post_id string, " + ", ".join(f"{f} double" for f in signal.FEATURES) + ", label bigint"
    return spark.createDataFrame(rows, schema).repartition(6), x, y


def newton(x, y):
    """Minimise sum(w * loss) + |b|^2 / 2 with balanced weights; intercept free."""
    z = (x - x.mean(0)) / x.std(0)
    a = np.c_[z, np.ones(len(z))]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    ridge = np.diag([1.0] * z.shape[1] + [0.0])
    b = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ b))
        gradient = a.T @ (w * (p - y)) + ridge @ b
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + ridge
        b -= np.linalg.solve(hessian, gradient)
    return b


def test_classifier_equals_newton(labelled):
    df, x, y = labelled
    fitted = signal.train_classifier(df)
    expected = newton(x, y)
    assert np.allclose([*fitted.coefficients, fitted.intercept], expected, atol=1e-8)
    ranked = [r["coefficient"] for r in fitted.importances(df.sparkSession).collect()]
    assert [abs(c) for c in ranked] == sorted((abs(c) for c in ranked), reverse=True)


def test_train_and_score(labelled):
    df, _, _ = labelled
    features, labels = df.drop("label"), df.select("post_id", "label")
    scores, report, importances = signal.train_and_score(features, labels, threshold=0.5)
    rows = scores.collect()
    assert len(rows) == 600 and all(0 <= r["crisis_score"] <= 1 for r in rows)
    held = report.first()
    assert held["auc"] > 0.75 and 0 < held["precision"] <= 1 and importances.count() == 5


def test_passes_of_the_fit_hash_no_ids(labelled, plan_of, monkeypatch):
    seen = []

    def fit(rows, *args, train=signal.train_classifier):
        seen.append((plan_of(rows), rows.count()))
        return train(rows, *args)

    monkeypatch.setattr(signal, "train_classifier", fit)
    signal.fit_and_score(labelled[0])
    [(plan, n)] = seen
    assert n == 480 and "md5" not in plan and "post_id" not in plan


def test_gradient_is_zero_at_the_fit(labelled):
    df, x, y = labelled
    fitted = signal.train_classifier(df)
    n1 = int(y.sum())
    weight = F.when(F.col("label") == 1, len(y) / (2 * n1)).otherwise(len(y) / (2 * (len(y) - n1)))
    rows = signal.standardize(df, signal.FEATURES, fitted.moments).select(*signal.FEATURES, F.col("label").cast("double").alias("_y"), weight.alias("_w"))
    at = signal.penalised_gradient(rows, (*fitted.coefficients, fitted.intercept)).first()
    assert max(abs(at[f"g{i}"]) for i in range(6)) < 1e-8


def test_one_class_is_refused(labelled):
    with pytest.raises(ValueError, match="both classes"):
        signal.train_classifier(labelled[0].where("label = 0"))


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def test_metrics_equal_brute_force(spark):
    rng = np.random.RandomState(4)
    labels = [int(v) for v in rng.rand(300) < 0.3]
    scores = [round(float(0.3 * y + 0.7 * v), 2) for y, v in zip(labels, rng.rand(300))]
    df = spark.createDataFrame(list(zip(scores, labels)), "s double, y int")
    row = signal.classifier_metrics(df, "s", "y", 0.6).first()
    assert row["auc"] == pytest.approx(brute_auc(scores, labels))
    flagged = [s >= 0.6 for s in scores]
    tp = sum(f and y for f, y in zip(flagged, labels))
    assert row["precision"] == pytest.approx(tp / sum(flagged))
    assert row["recall"] == pytest.approx(tp / sum(labels))
    assert row["f1"] == pytest.approx(2 * tp / (sum(flagged) + sum(labels)))
    close = [s + 1e-5 * (i % 7) for i, s in enumerate(scores)]  # distinct, but many round alike
    exact = signal.exact_auc(spark.createDataFrame(list(zip(close, labels)), "p double, label int")).first()["auc"]
    assert exact == pytest.approx(brute_auc(close, labels))
    none = signal.classifier_metrics(df, "s", "y", 2.0).first()
    assert none["precision"] == none["recall"] == none["f1"] == 0.0


def test_scores_must_be_probabilities(spark):
    df = spark.createDataFrame([(0.2, 0), (1.5, 1)], "s double, y int")
    with pytest.raises(PySparkException, match="between 0 and 1"):
        signal.classifier_metrics(df, "s", "y").collect()


def test_threshold_matches_prevalence(spark):
    df = spark.createDataFrame([(i / 100, int(i % 4 == 0)) for i in range(100)], "s double, y int")
    row = signal.calibrate_threshold(df, "s", "y").first()
    assert (row["threshold"], row["flag_rate"], row["label_rate"]) == (0.75, 0.25, 0.25)


def test_flag_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([("a", 0.61396), ("b", 0.614)], "post_id string, p double")
    rows = {r["post_id"]: r for r in signal.flag_scores(df).collect()}
    assert rows["a"]["crisis_score"] == 0.614 and rows["a"]["crisis_flag"] is False
    assert rows["b"]["crisis_flag"] is True
    zero = signal.flag_scores(df, threshold=0.0).collect()
    assert all(r["crisis_flag"] for r in zero)


def test_constant_column_is_standardised_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = sorted(tuple(r) for r in signal.standardize(df, ["a", "b"]).collect())
    assert rows == [(-1.0, 0.0), (1.0, 0.0)]


def test_exact_auc_of_scores_that_nearly_all_round_alike(spark):
    """Most distinct scores lie in one published bucket; they are still spread over ranges of their own."""
    rng = np.random.default_rng(4)
    scores = np.concatenate([0.5 + rng.normal(size=6000) * 1e-7, rng.random(200), np.full(300, 0.5)])
    labels = (rng.random(len(scores)) < 0.3 + 0.3 * (scores > 0.5)).astype(int)
    df = spark.createDataFrame([(float(s), int(x)) for s, x in zip(scores, labels)] + [(None, 1)], "p double, label int").repartition(5)
    pos, neg = scores[labels == 1], scores[labels == 0]
    want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
    assert abs(signal.exact_auc(df).first()["auc"] - want) < 1e-12
    spread = spark.createDataFrame([(float(s),) for s in scores], "s double").distinct().repartitionByRange(8, "s")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * min(sizes)
    assert signal.exact_auc(df.limit(0)).first()["auc"] is None
