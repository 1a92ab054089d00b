"""Score a published run: sentiment first, then the distress signal."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from moodtide.functions import text as T
from moodtide.operators import gold, scoring, signal
from moodtide.plans import medallion
from moodtide.sources import layers
from moodtide.schemas import SENTIMENT_SCORES


def score_sentiment(
    spark: SparkSession, root: str, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Append scores for unscored posts and refresh Gold; returns all scores.

    Scores are written before they are merged, so the scorer runs once per post.
    """
    table = f"{root}/scores/sentiment"
    silver = medallion.read_silver(spark, root).select("post_id", "text")
    todo = silver
    if layers.has_parquet(spark, table):
        done = spark.read.schema(SENTIMENT_SCORES).parquet(table)
        todo = scoring.unscored(silver, done)
    score(todo).write.mode("append").parquet(table)
    scores = spark.read.schema(SENTIMENT_SCORES).parquet(table)
    medallion.refresh_scores(spark, root, scores, gold.SENTIMENT_COLUMNS)
    return scores


def score_signal(
    spark: SparkSession,
    root: str,
    threshold: float = signal.FLAG_THRESHOLD,
    acute: tuple[str, ...] = T.ACUTE_PHRASES,
    severe: tuple[str, ...] = T.SEVERE_TERMS,
) -> tuple[DataFrame, DataFrame]:
    """Train on weak labels, score every post, refresh Gold: (report, importances)."""
    silver = medallion.read_silver(spark, root)
    posts = medallion.read_posts(spark, root)
    rows = signal.training_rows(silver, posts, acute, severe)
    scores, report, importances = signal.fit_and_score(rows, threshold)
    medallion.refresh_scores(spark, root, scores, gold.CRISIS_COLUMNS)
    return report, importances
