"""Batch post scoring with a pluggable scorer."""

from __future__ import annotations

from typing import Callable, Iterable, Iterator, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.functions.numbers import round_even
from moodtide.functions.text import count_hits
from moodtide.schemas import SENTIMENT_SCORES

# Class order of every probability row.
LABELS = ("negative", "neutral", "positive")


class Scorer(Protocol):
    """Anything that turns texts into an (n, 3) array of class probabilities."""

    def score_texts(self, texts: list[str]) -> np.ndarray: ...


def label_of(probabilities: Column | str) -> Column:
    """Most likely class; the earlier class wins a tie."""
    p = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    place = F.array_position(p, F.array_max(p)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), place)


def score_of(probabilities: Column | str) -> Column:
    """P(positive) - P(negative), 4 decimals."""
    p = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    return round_even(p[2] - p[0], 4)


def score_probabilities(df: DataFrame, column: str = "probabilities") -> DataFrame:
    """Score and label from a column of class probabilities."""
    return df.withColumns(
        {"sentiment_score": score_of(column), "sentiment_label": label_of(column)}
    ).drop(column)


def length_ordered(posts: DataFrame, partitions: int | None = None, text: str = "text") -> DataFrame:
    """Order each task's rows by text length, over ``partitions`` tasks if given.

    Batches of like length pad alike; rows keep their post_id, so nothing has to
    be put back in order afterwards. Without a number of tasks no text is moved.
    """
    spread = posts.repartition(partitions, "post_id") if partitions else posts
    return spread.sortWithinPartitions(F.length(F.coalesce(F.col(text), F.lit(""))), "post_id")


def score_posts(
    posts: DataFrame,
    scorer_factory: Callable[[], Scorer],
    batch_rows: int = 1280,
    partitions: int | None = None,
    by_length: bool = True,
) -> DataFrame:
    """Score every post; the scorer is built once per task, not per batch.

    Only ids and texts are sent to Python, in Arrow batches. ``partitions``
    spreads the posts anew, for slow scorers on few or uneven input files;
    ``by_length`` sorts each task's texts, which pays for scorers that pad.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows]
                p = np.asarray(scorer.score_texts(part["text"].tolist()), dtype="float64")
                yield pd.DataFrame(
                    {
                        "post_id": part["post_id"].to_numpy(),
                        "sentiment_score": np.round(p[:, 2] - p[:, 0], 4) + 0.0,
                        "sentiment_label": [LABELS[i] for i in p.argmax(axis=1)],
                    }
                )

    narrow = posts.select("post_id", F.coalesce("text", F.lit("")).alias("text"))
    if by_length:
        ready = length_ordered(narrow, partitions)
    else:
        ready = narrow.repartition(partitions, "post_id") if partitions else narrow
    return ready.mapInPandas(run, SENTIMENT_SCORES)


def with_lexicon_score(
    posts: DataFrame, positive: Iterable[str], negative: Iterable[str]
) -> DataFrame:
    """Default scorer: term counts with one pseudo-count for neutral, in the JVM."""
    body = F.coalesce(F.col("text"), F.lit(""))
    counted = posts.withColumns(
        {"_pos": count_hits(body, positive), "_neg": count_hits(body, negative)}
    )
    total = F.col("_pos") + F.col("_neg") + 1
    probabilities = F.array(F.col("_neg") / total, 1 / total, F.col("_pos") / total)
    return score_probabilities(counted.withColumn("_p", probabilities), "_p").drop("_pos", "_neg")


def score_with_lexicon(
    posts: DataFrame, positive: Iterable[str], negative: Iterable[str]
) -> DataFrame:
    """Lexicon scores as a score table."""
    scored = with_lexicon_score(posts.select("post_id", "text"), positive, negative)
    return scored.drop("text")


def first_posts(posts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` posts by id (a bare limit would not be repeatable)."""
    return posts.orderBy("post_id").limit(n)


def unscored(posts: DataFrame, done: DataFrame) -> DataFrame:
    """Posts without a score yet; repeated scores are merged before the shuffle."""
    return posts.join(done.select("post_id").distinct(), "post_id", "left_anti")


def append_scores(done: DataFrame, fresh: DataFrame) -> DataFrame:
    """Earlier scores plus a new batch, matched by column name."""
    return done.unionByName(fresh.select(*done.columns))


def resume_scoring(
    posts: DataFrame, done: DataFrame, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """All scores after scoring only what is missing."""
    return append_scores(done, score(unscored(posts, done)))


def _total(value: Column) -> Column:
    """Total over a frame of one row per label or pair of labels."""
    return F.sum(value).over(Window.partitionBy())


def label_shares(posts: DataFrame) -> DataFrame:
    """Share of each label among scored posts, with their number and mean score.

    Totals are windows over the few label rows, so posts are read once.
    """
    scored = posts.where(F.col("sentiment_score").isNotNull())
    per_label = scored.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sentiment_score").alias("total")
    )
    everything = _total(F.col("n"))
    return per_label.select(
        "sentiment_label",
        (F.col("n") / everything).alias("share"),
        everything.alias("n_scored"),
        (_total(F.col("total")) / everything).alias("mean_sentiment"),
    ).where(F.col("sentiment_label").isNotNull())


def label_agreement(df: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """Cross-tabulation of two label columns with the mean score per cell.

    Every cell also carries the overall exact agreement and the agreement that
    takes neutral and mixed as the same.
    """

    def merged(c: str) -> Column:
        return F.when(F.col(c).isin("neutral", "mixed"), "neutral/mixed").otherwise(F.col(c))

    def share(same: Column) -> Column:
        return _total(F.when(same, F.col("n")).otherwise(0)) / _total(F.col("n"))

    both = df.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    cells = both.groupBy(left, right).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score")
    )
    return cells.select(
        left,
        right,
        "n",
        "mean_score",
        share(F.col(left) == F.col(right)).alias("exact_agreement"),
        share(merged(left) == merged(right)).alias("compatible_agreement"),
    )
