"""Distress signal: weak labels, features, distributed classifier, metrics."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moodtide.functions import text as T
from moodtide.functions.numbers import round_even
from moodtide.session import materialize

FEATURES = (
    "severe_density",
    "first_person_density",
    "negation_density",
    "sentiment_score",
    "log_n_words",
)

# Fixed value: the prevalence-calibrated flag threshold.
FLAG_THRESHOLD = 0.614

SCORE_DECIMALS = 4  # scores are kept to 1e-4, hence at most 10,001 distinct values


# --- labels and features ----------------------------------------------------------


def weak_label(
    text: Column | str,
    acute: Iterable[str] = T.ACUTE_PHRASES,
    severe: Iterable[str] = T.SEVERE_TERMS,
) -> Column:
    """1 for an acute phrase or two distinct severe terms, else 0."""
    body = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    hit = (T.distinct_hits(body, acute) >= 1) | (T.distinct_hits(body, severe) >= 2)
    return hit.cast("bigint")


def weak_labels(posts: DataFrame, **lexicon) -> DataFrame:
    return posts.select("post_id", weak_label("text", **lexicon).alias("label"))


def token_densities(
    posts: DataFrame, severe: Iterable[str] = T.SEVERE_TERMS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Hits per 100 words and log length; a post counts at least one word."""
    body = F.coalesce(F.col("text"), F.lit(""))
    counted = posts.withColumn("_n", F.greatest(T.word_count(body), F.lit(1)))

    def per_100(hits: Column) -> Column:
        return 100 * hits / F.col("_n")

    return counted.select(
        "post_id",
        per_100(T.count_hits(body, severe)).alias("severe_density"),
        per_100(T.count_tokens(body, T.FIRST_PERSON)).alias("first_person_density"),
        per_100(T.count_tokens(body, T.NEGATION)).alias("negation_density"),
        F.log1p("_n").alias("log_n_words"),
        *keep,
    )


def require_sentiment(posts: DataFrame) -> None:
    """Raise when no post has a sentiment score; stops at the first one found."""
    if posts.where(F.col("sentiment_score").isNotNull()).isEmpty():
        raise RuntimeError("sentiment_score is empty: score the posts first")


def join_sentiment(features: DataFrame, posts: DataFrame) -> DataFrame:
    """Add the sentiment score by post, 0.0 where a post has none."""
    joined = features.join(posts.select("post_id", "sentiment_score"), "post_id", "left")
    return joined.withColumn("sentiment_score", F.coalesce("sentiment_score", F.lit(0.0)))


def build_features(
    silver: DataFrame, scores: DataFrame, severe: Iterable[str] = T.SEVERE_TERMS
) -> DataFrame:
    """Feature row per post; the acute phrases are left out on purpose.

    ``scores`` holds post_id and sentiment_score: the score table itself or the
    per-post table. Texts are reduced to numbers before the join, so only those
    are shuffled.
    """
    require_sentiment(scores)
    return join_sentiment(token_densities(silver, severe), scores).select("post_id", *FEATURES)


def training_rows(
    silver: DataFrame,
    posts: DataFrame,
    acute: Iterable[str] = T.ACUTE_PHRASES,
    severe: Iterable[str] = T.SEVERE_TERMS,
) -> DataFrame:
    """Features and weak label of every post from one pass over the texts."""
    require_sentiment(posts)
    # Densities first: their projection then takes in the label, and the text is lowered once for both.
    numbers = token_densities(silver, severe, keep=("text",)).withColumn("label", weak_label("text", acute, severe))
    return join_sentiment(numbers, posts).select("post_id", *FEATURES, "label")


# --- split and scaling ------------------------------------------------------------


def _hashed(df: DataFrame, seed: int) -> DataFrame:
    """Adds ``_h``, by which rows are put in order: md5 of id and seed, then the id."""
    salted = F.concat_ws(":", F.col("post_id").cast("string"), F.lit(str(seed)))
    return df.withColumn("_h", F.struct(F.md5(salted).alias("h"), F.col("post_id").alias("id")))


def _by_label(rows: DataFrame, label: str, value: str) -> Column:
    """A look-up with one entry per label, instead of a join on so few keys."""
    return rows.agg(F.map_from_entries(F.collect_list(F.struct(label, value)))).scalar()


def last_training_rows(df: DataFrame, label: str = "label", seed: int = 7) -> DataFrame:
    """(label, _h) of the last training row of each label.

    Ranking a whole label in one task would not scale. The row is found on a
    histogram of hash prefixes (65,536 per label); only the prefix it falls into is
    ranked row by row.
    """
    prefixed = _hashed(df, seed).select(label, "_h", F.substring("_h.h", 1, 4).alias("_p"))
    histogram = prefixed.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_c"))

    # Per-label quotas by largest remainder, so that they add up to 80 % of all.
    sizes = histogram.groupBy(label).agg(F.sum("_c").alias("_size"))
    exact = F.col("_target") * F.col("_size") / F.col("_all")
    shares = (
        sizes.withColumn("_all", sizes.agg(F.sum("_size")).scalar())
        .withColumn("_target", F.floor(F.lit(0.8) * F.col("_all")))
        .withColumn("_floor", F.floor(exact))
        .withColumn("_rest", exact - F.col("_floor"))
    )
    spare = F.col("_target") - F.sum("_floor").over(Window.partitionBy("_all"))
    place = F.row_number().over(Window.partitionBy("_all").orderBy(F.desc("_rest"), label))
    quotas = shares.select(
        label, (F.col("_floor") + (place <= spare).cast("bigint")).alias("_quota")
    )

    # At most 65,536 rows per label here.
    upto = F.sum("_c").over(Window.partitionBy(label).orderBy("_p"))
    last_prefix = (
        histogram.withColumn("_upto", upto)
        .join(quotas, label)
        .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_c") < F.col("_quota")))
        .select(label, "_p", (F.col("_quota") - F.col("_upto") + F.col("_c")).alias("_nth"))
    )
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_h"))
    edge = last_prefix.withColumn("_e", F.struct("_p", "_nth"))
    return (
        prefixed.withColumn("_e", F.try_element_at(_by_label(edge, label, "_e"), F.col(label)))
        .where(F.col("_p") == F.col("_e._p"))
        .withColumn("_n", nth)
        .where(F.col("_n") == F.col("_e._nth"))
        .select(label, "_h")
    )


def stratified_split(df: DataFrame, label: str = "label", seed: int = 7, cuts: Column | None = None) -> DataFrame:
    """Add ``is_train``: 80 % of every label, exactly, chosen by a hash of the id.

    Rows are compared with the last training row of their label in one pass that
    shuffles nothing; ``cuts`` names those rows where they are known already.
    """
    cuts = _by_label(last_training_rows(df, label, seed), label, "_h") if cuts is None else cuts
    is_train = F.col("_h") <= F.try_element_at(F.col("_cuts"), F.col(label))
    return (
        _hashed(df, seed)
        .withColumn("_cuts", cuts)
        .withColumn("is_train", F.coalesce(is_train, F.lit(False)))
        .select(*df.columns, "is_train")
    )


def feature_moments(df: DataFrame, columns: Iterable[str] = FEATURES) -> DataFrame:
    """Mean and population deviation of every column, as one struct per column."""
    return df.agg(
        *[
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
            for c in columns
        ]
    )


def standardize(
    df: DataFrame, columns: Iterable[str] = FEATURES, moments: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0.

    By the frame's own moments, or by given (mean, deviation) pairs.
    """
    columns = tuple(columns)
    if moments is not None:
        return df.withColumns({c: (F.col(c) - F.lit(moments[c][0])) / F.lit(moments[c][1] or 1.0) for c in columns})
    one = feature_moments(df, columns).select(F.struct(*columns)).scalar()
    scaled = {}
    for c in columns:
        mean, std = F.col(f"_m.{c}.mean"), F.col(f"_m.{c}.std")
        scaled[c] = (F.col(c) - mean) / F.when(std == 0, 1.0).otherwise(std)
    return df.withColumn("_m", one).withColumns(scaled).drop("_m")


# --- classifier -------------------------------------------------------------------


@dataclass(frozen=True)
class Classifier:
    """Weights of the scaled features, with the moments their inputs are scaled by."""

    coefficients: tuple[float, ...]
    intercept: float
    moments: Mapping[str, tuple[float, float]]

    def margin(self) -> Column:
        """Of scaled features."""
        return _margin((*self.coefficients, self.intercept))

    def predict(self, features: DataFrame) -> DataFrame:
        """Adds ``p``, the unrounded probability of the signal."""
        scaled = standardize(features, FEATURES, self.moments).withColumn("p", _sigmoid(self.margin()))
        return scaled

    def importances(self, spark: SparkSession) -> DataFrame:
        """Coefficients of the scaled features, by size."""
        rows = [(f, round(c, 4)) for f, c in zip(FEATURES, self.coefficients)]
        return rank_coefficients(spark.createDataFrame(rows, "feature string, coefficient double"))


def _margin(weights: Iterable[float]) -> Column:
    *slopes, intercept = weights
    return sum((F.lit(float(w)) * F.col(f) for f, w in zip(FEATURES, slopes)), F.lit(float(intercept)))


def _sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def rank_coefficients(coefficients: DataFrame) -> DataFrame:
    """Largest absolute coefficient first."""
    return coefficients.orderBy(F.desc(F.abs("coefficient")), "feature")


NEWTON_STEPS = 50
NEWTON_STEP_SIZE = 1e-11  # of the last step, at which the weights stand still


def penalised_gradient(rows: DataFrame, weights: Iterable[float], c: float = 1.0) -> DataFrame:
    """loss, gradient g0..g5 and Hessian h00..h55 of the objective at ``weights``, as one row.

    ``rows`` holds scaled features, ``_y`` and ``_w``. The objective is
    ``sum(w * loss) + |slopes|^2 / (2c)``; the sums are Spark's, over any number of
    rows in one pass.
    """
    weights = [float(w) for w in weights]
    k = len(weights)
    inputs = [F.col(f) for f in FEATURES] + [F.lit(1.0)]
    m = F.col("_m")
    prepared = rows.withColumn("_m", _margin(weights)).withColumn("_p", _sigmoid(m))
    prepared = prepared.withColumns({"_r": F.col("_w") * (F.col("_p") - F.col("_y")), "_c": F.col("_w") * F.col("_p") * (1 - F.col("_p"))})
    loss = F.sum(F.col("_w") * (F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - F.col("_y") * m))
    ridge = [1 / c] * (k - 1) + [0.0]
    gradient = [(F.sum(F.col("_r") * inputs[i]) + ridge[i] * weights[i]).alias(f"g{i}") for i in range(k)]
    hessian = [
        (F.sum(F.col("_c") * inputs[i] * inputs[j]) + (ridge[i] if i == j else 0.0)).alias(f"h{i}{j}")
        for i in range(k)
        for j in range(i + 1)
    ]
    size = sum(w * w for w in weights[:-1]) / (2 * c)
    return prepared.agg((loss + F.lit(size)).alias("loss"), *gradient, *hessian)


def train_classifier(train: DataFrame, label: str = "label", c: float = 1.0) -> Classifier:
    """L2 logistic regression with classes weighted to equal mass, by Newton's method.

    Each step is one pass of sums over the rows and a solve of six unknowns on the
    driver; a step that does not lower the objective is halved. The minimum is
    unique and reached to the last digits, so the fit does not depend on the
    solver's settings.
    """
    frozen = {name: (m["mean"], m["std"]) for name, m in feature_moments(train).first().asDict().items()}
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # one per class
    n = sum(sizes.values())
    if len(sizes) != 2:
        raise ValueError("training needs posts of both classes")
    weight = F.when(F.col(label) == 1, n / (2 * sizes[1])).otherwise(n / (2 * sizes[0]))
    rows = standardize(train, FEATURES, frozen).select(*FEATURES, F.col(label).cast("double").alias("_y"), weight.alias("_w"))
    k = len(FEATURES) + 1
    weights, step = np.zeros(k), np.zeros(k)
    reached = np.inf
    for _ in range(NEWTON_STEPS):
        at = penalised_gradient(rows, weights + step, c).first()
        if at["loss"] > reached + 1e-9 * abs(reached):
            step = step / 2
            continue
        weights, reached = weights + step, at["loss"]
        hessian = np.array([[at[f"h{max(i, j)}{min(i, j)}"] for j in range(k)] for i in range(k)])
        step = -np.linalg.solve(hessian, [at[f"g{i}"] for i in range(k)])
        if np.abs(step).max() < NEWTON_STEP_SIZE:
            break
    final = [float(x) for x in weights + step]
    return Classifier(tuple(final[:-1]), final[-1], frozen)


def exact_auc(predicted: DataFrame, score: str = "p", label: str = "label") -> DataFrame:
    """Area under the curve on unrounded scores, ties counted half, as one row ``auc``.

    Equal scores become one row with counts. These rows, of which no two have the same
    score, are written in even ranges of scores, however close together most of them
    lie; negatives below a score are those of lower ranges, one running sum over as
    many rows as there are ranges, and those below it in its own range. A null score
    is in no range and takes no part.
    """
    counted = predicted.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ranged = materialize(counted.repartitionByRange("_s").withColumn("_range", F.spark_partition_id()), "score-ranges")
    before = lambda w: F.coalesce(F.sum("_neg").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ranged.groupBy("_range").agg(F.sum("_neg").alias("_neg"))
    offsets = totals.select("_range", before(Window.orderBy("_range")).alias("_lower"))
    placed = ranged.withColumn("_inside", before(Window.partitionBy("_range").orderBy("_s"))).join(offsets, "_range")
    wins = F.sum(F.col("_pos") * (F.col("_lower") + F.col("_inside") + F.col("_neg") / 2))
    return placed.agg(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))


def flag_scores(
    predicted: DataFrame, threshold: float = FLAG_THRESHOLD, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Published score (4 decimals) and flag; the flag looks at the unrounded value."""
    return predicted.select(
        "post_id",
        round_even("p", SCORE_DECIMALS).alias("crisis_score"),
        (F.col("p") >= threshold).alias("crisis_flag"),
        *keep,
    )


def score_linear(
    features: DataFrame,
    coefficients: Mapping[str, float],
    intercept: float,
    threshold: float = FLAG_THRESHOLD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Score and flag from known coefficients, as a closed-form sigmoid."""
    z = F.lit(float(intercept))
    for name, weight in coefficients.items():
        z = z + F.lit(float(weight)) * F.col(name)
    return flag_scores(features.withColumn("p", 1 / (1 + F.exp(-z))), threshold, keep)


def fit_and_score(
    rows: DataFrame, threshold: float = FLAG_THRESHOLD, seed: int = 7
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores of all posts, one-row holdout report, importances).

    ``rows`` holds post_id, the features and ``label``. They are written to the
    shared folder once, and so are the training rows without their ids: the fit
    passes over those many times, and should read a few numbers per post, neither
    derive them from text nor hash ids. The rows at which the split is cut, one for
    each label, are looked up once too. Scores and report are lazy.
    """
    narrow = materialize(rows.select("post_id", *FEATURES, "label"), "training")
    last = last_training_rows(narrow, "label", seed).collect()
    point = lambda r: F.struct(F.lit(r["_h"]["h"]).alias("h"), F.lit(r["_h"]["id"]).alias("id"))
    cuts = F.create_map(*(x for r in last for x in (F.lit(r["label"]), point(r))))
    split = stratified_split(narrow, "label", seed, cuts)
    fitted = train_classifier(materialize(split.where("is_train").select(*FEATURES, "label"), "fit"))
    holdout = fitted.predict(split.where("NOT is_train"))
    report = classifier_metrics(holdout, "p", "label", threshold).withColumn("auc", exact_auc(holdout).scalar())
    return flag_scores(fitted.predict(narrow), threshold), report, fitted.importances(rows.sparkSession)


def train_and_score(
    features: DataFrame, labels: DataFrame, threshold: float = FLAG_THRESHOLD, seed: int = 7
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``fit_and_score`` for labels kept in a table of their own."""
    return fit_and_score(features.join(labels, "post_id"), threshold, seed)


# --- metrics ----------------------------------------------------------------------


def score_histogram(
    df: DataFrame, score: str, label: str, threshold: float = FLAG_THRESHOLD
) -> DataFrame:
    """Negatives and positives per published score: at most 10,001 rows.

    Flags are counted before the scores are rounded. A score that is no
    probability is an error, for it would break the bound.
    """
    positive, flagged = F.col(label) == 1, F.col(score) >= threshold
    stop = F.raise_error(F.lit("scores must lie between 0 and 1")).cast("double")
    published = F.when(
        F.col(score).isNull() | F.col(score).between(0, 1), round_even(score, SCORE_DECIMALS)
    ).otherwise(stop)
    return df.groupBy(published.alias("score")).agg(
        F.count_if(positive).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & positive).alias("tp"),
        F.count(F.lit(1)).alias("n"),
    )


def classifier_metrics(
    df: DataFrame, score: str, label: str, threshold: float = FLAG_THRESHOLD
) -> DataFrame:
    """Precision, recall, F1, rates and the area under the curve, in one row.

    Data rows are read once, into the histogram; the running sum behind the area
    (ties counted half) is over its rows. Undefined ratios are 0.
    """
    below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = score_histogram(df, score, label, threshold).withColumn(
        "neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0))
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, flagged, pos, n = (F.sum(c) for c in ("tp", "flagged", "pos", "n"))
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return ranked.agg(
        ratio(tp, flagged).alias("precision"),
        ratio(tp, pos).alias("recall"),
        ratio(2 * tp, flagged + pos).alias("f1"),
        ratio(pos, n).alias("weak_label_rate"),
        ratio(flagged, n).alias("flag_rate"),
        F.try_divide(wins, pos.cast("double") * F.sum("neg")).alias("auc"),
    )


def calibrate_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """Published score whose flag rate is nearest the label rate, higher on ties."""
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.sum(F.col("pos") + F.col("neg")).over(whole)
    rates = score_histogram(df, score, label).select(
        F.col("score").alias("threshold"),
        (F.sum(F.col("pos") + F.col("neg")).over(above) / n).alias("flag_rate"),
        (F.sum("pos").over(whole) / n).alias("label_rate"),
    )
    distance = F.abs(F.col("flag_rate") - F.col("label_rate"))
    best = F.min_by(F.struct("threshold", "flag_rate", "label_rate"), F.struct(distance, -F.col("threshold")))
    return rates.agg(best.alias("b")).select("b.*")
