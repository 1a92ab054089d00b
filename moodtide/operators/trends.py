"""Trend analytics over the weekly table (one row per community and week)."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.functions.numbers import round_even
from moodtide.functions.text import targets_individual

# --- fixed values ---------------------------------------------------------------
EVENT_CUTOFF = dt.date(2020, 3, 11)
WEEKLY_VIEW = ("week", "subreddit", "n_posts", "sentiment", "crisis_rate", "crisis_count")
REFUSAL = (
    "I can only report aggregate, anonymized trends — not information about any "
    "individual user or content that could identify someone. Try asking about "
    "cohort- or subreddit-level patterns instead."
)

# --- wording --------------------------------------------------------------------
HINT = "Ask about communities as a whole, such as how their mood or volume changed over some weeks."
NO_DATA = "There are no weekly figures to answer from."
ANSWER = (
    "Lowest mean sentiment over all weeks: **r/%s** (%s). Largest share of flagged posts: "
    "**r/%s** (%s%%). Both are aggregate figures of whole communities."
)


def weekly_view(weekly: DataFrame) -> DataFrame:
    """Contract columns first, further columns after, sorted for reading."""
    extras = [c for c in weekly.columns if c not in WEEKLY_VIEW]
    typed = weekly.withColumns(
        {"week": F.col("week").cast("date"), "crisis_count": F.col("crisis_count").cast("bigint")}
    )
    return typed.select(*WEEKLY_VIEW, *extras).orderBy("subreddit", "week")


def select_window(
    weekly: DataFrame,
    communities: Sequence[str] | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Chosen communities and an inclusive date range."""
    if communities is not None:
        weekly = weekly.where(F.col("subreddit").isin(list(communities)))
    if first is not None:
        weekly = weekly.where(F.col("week") >= F.lit(first))
    if last is not None:
        weekly = weekly.where(F.col("week") <= F.lit(last))
    return weekly


def scored_rows(weekly: DataFrame, field: str) -> DataFrame:
    """Rows whose plotted metric is known."""
    return weekly.dropna(subset=[field])


def spans(weekly: DataFrame, cutoff: dt.date = EVENT_CUTOFF) -> DataFrame:
    """Does the data reach from before to after the cutoff? False when empty."""
    inside = F.lit(cutoff).between(F.min("week"), F.max("week"))
    return weekly.agg(F.coalesce(inside, F.lit(False)).alias("spans_cutoff"))


def kpis(weekly: DataFrame) -> DataFrame:
    """Headline figures; the mean sentiment weighs every week alike."""
    posts = F.coalesce(F.sum("n_posts"), F.lit(0))
    signals = F.coalesce(F.sum("crisis_count"), F.lit(0))
    return weekly.agg(
        F.count_distinct("subreddit").alias("communities"),
        posts.alias("total_posts"),
        F.when(F.count(F.lit(1)) == 0, F.lit(0.0)).otherwise(F.avg("sentiment")).alias(
            "avg_sentiment"
        ),
        F.coalesce(F.try_divide(signals, posts), F.lit(0.0)).alias("crisis_share"),
    )


def community_overview(weekly: DataFrame) -> DataFrame:
    """Totals and unweighted mean sentiment per community."""
    known = weekly.where(F.col("subreddit").isNotNull())
    totals = known.groupBy("subreddit").agg(
        F.sum("n_posts").alias("posts"),
        round_even(F.avg("sentiment"), 3).alias("avg_sentiment"),
        F.coalesce(F.sum("crisis_count"), F.lit(0)).alias("crisis_signals"),
    )
    share = F.when(F.col("posts") > 0, F.col("crisis_signals") / F.col("posts")).otherwise(0.0)
    return totals.withColumn("crisis_share", round_even(share, 4))


def ranked_overview(weekly: DataFrame) -> DataFrame:
    """Overview, largest community first."""
    return community_overview(weekly).orderBy(F.desc("posts"), "subreddit")


def _before_after(weekly: DataFrame, cutoff: dt.date) -> DataFrame:
    """Per-community aggregates on both sides of the cutoff, one shuffle.

    Communities seen on one side only vanish, like in an inner join.
    """
    before = F.col("week") < F.lit(cutoff)
    after = F.col("week") >= F.lit(cutoff)

    def side(condition: Column, suffix: str) -> list[Column]:
        return [
            F.avg(F.when(condition, F.col("sentiment"))).alias(f"sentiment_{suffix}"),
            F.avg(F.when(condition, F.col("crisis_rate"))).alias(f"crisis_rate_{suffix}"),
            F.sum(F.when(condition, F.col("n_posts"))).alias(f"posts_{suffix}"),
            F.count_if(condition).alias(f"weeks_{suffix}"),
        ]

    both = (
        weekly.where(F.col("subreddit").isNotNull())
        .groupBy("subreddit")
        .agg(*side(before, "pre"), *side(after, "post"))
    )
    return both.where((F.col("weeks_pre") > 0) & (F.col("weeks_post") > 0))


def pre_post_join(weekly: DataFrame, cutoff: dt.date = EVENT_CUTOFF) -> DataFrame:
    """Both sides of the cutoff next to each other."""
    return _before_after(weekly, cutoff).drop("weeks_pre", "weeks_post")


def event_impact(weekly: DataFrame, cutoff: dt.date = EVENT_CUTOFF) -> DataFrame:
    """Before/after comparison with deltas, 4 decimals."""
    both = pre_post_join(weekly, cutoff)
    deltas = both.withColumns(
        {
            f"{m}_delta": F.col(f"{m}_post") - F.col(f"{m}_pre")
            for m in ("sentiment", "crisis_rate")
        }
    )
    measures = [c for c in deltas.columns if c.startswith(("sentiment_", "crisis_rate_"))]
    return deltas.withColumns({c: round_even(c, 4) for c in measures})


def smooth(weekly: DataFrame, window: int = 3) -> DataFrame:
    """Trailing mean over rows of a community, unknown values ignored.

    A community's series is bounded by the calendar, so its window is small
    however many posts lie behind it.
    """
    if window <= 1:
        return weekly
    trailing = Window.partitionBy("subreddit").orderBy("week").rowsBetween(1 - window, 0)
    fields = [c for c in ("sentiment", "crisis_rate") if c in weekly.columns]
    return weekly.withColumns({c: F.avg(c).over(trailing) for c in fields})


def _pivot(weekly: DataFrame, communities: Sequence[str] | None, measure: Column) -> DataFrame:
    known = weekly.where(F.col("subreddit").isNotNull())
    return known.groupBy("week").pivot("subreddit", list(communities) if communities else None).agg(
        measure
    )


def sentiment_pivot(weekly: DataFrame, communities: Sequence[str] | None = None) -> DataFrame:
    """Week by community matrix of mean sentiment.

    Naming the communities saves the job that would look them up.
    """
    return _pivot(weekly, communities, F.avg("sentiment"))


def crisis_volume_pivot(weekly: DataFrame, communities: Sequence[str] | None = None) -> DataFrame:
    """Week by community matrix of flagged posts; unscored weeks stay NULL."""
    return _pivot(weekly, communities, F.sum("crisis_count"))


def trend_tail(pivot: DataFrame, weeks: int = 6) -> DataFrame:
    """Latest weeks of a matrix, oldest first."""
    return pivot.orderBy(F.desc("week")).limit(weeks).orderBy("week")


def activity(weekly: DataFrame) -> DataFrame:
    """Mean weekly active authors, weeks, posts, communities and span."""
    return weekly.agg(
        F.avg("n_active_authors").alias("avg_active_authors"),
        F.count_distinct("week").alias("weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
        F.coalesce(F.sum("n_posts"), F.lit(0)).alias("posts"),
        F.count_distinct("subreddit").alias("communities"),
    )


def extremes(weekly: DataFrame) -> DataFrame:
    """Most negative and most flagged community, ties by name, as one row."""
    overview = community_overview(weekly)
    tied = F.struct(F.col("avg_sentiment"), F.col("subreddit"))
    flagged = F.struct((-F.col("crisis_share")).alias("s"), F.col("subreddit"))
    return overview.agg(
        F.min(F.when(F.col("avg_sentiment").isNotNull(), tied)).alias("low"),
        F.min(F.when(F.col("crisis_share").isNotNull(), flagged)).alias("high"),
    ).select(
        F.col("low.subreddit").alias("most_negative"),
        F.col("low.avg_sentiment").alias("avg_sentiment"),
        F.col("high.subreddit").alias("highest_share"),
        (-F.col("high.s")).alias("crisis_share"),
    )


def answer_sentence(weekly: DataFrame) -> DataFrame:
    """The aggregate answer as one row, one column."""
    percent = F.round(F.col("crisis_share").cast("decimal(9,4)") * 100, 1).cast("string")
    level = F.format_string("%+.3f", F.col("avg_sentiment"))
    sentence = F.format_string(
        ANSWER,
        F.coalesce(F.col("most_negative"), F.lit("n/a")),
        F.when(F.col("avg_sentiment").isNull(), "n/a").otherwise(level),
        F.col("highest_share"),
        percent,
    )
    nothing = F.col("highest_share").isNull() & F.col("most_negative").isNull()
    return extremes(weekly).select(F.when(nothing, NO_DATA).otherwise(sentence).alias("answer"))


def route_questions(questions: DataFrame, weekly: DataFrame, column: str = "question") -> DataFrame:
    """Hint for blanks, refusal for individuals, the aggregate answer otherwise.

    The answer is a scalar subquery: computed once, joined to nothing.
    """
    asked = F.trim(F.coalesce(F.col(column), F.lit("")))
    answer = answer_sentence(weekly).scalar()
    return questions.withColumn(
        "answer",
        F.when(asked == "", HINT).when(targets_individual(asked), REFUSAL).otherwise(answer),
    )
