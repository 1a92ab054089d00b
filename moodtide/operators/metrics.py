"""Vetted, parameterised metric queries over the weekly table; no free SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

TEMPLATES: dict[str, tuple[frozenset[str], str]] = {
    "community_trend": (
        frozenset({"subreddit", "first_week", "last_week"}),
        """
        SELECT week, n_posts, sentiment, crisis_rate
        FROM {weekly}
        WHERE subreddit = :subreddit AND week BETWEEN :first_week AND :last_week
        ORDER BY week
        """,
    ),
    "largest_rise": (
        frozenset({"first_week", "last_week"}),
        """
        SELECT subreddit,
               max_by(crisis_rate, week) - min_by(crisis_rate, week) AS rise
        FROM {weekly}
        WHERE week BETWEEN :first_week AND :last_week AND crisis_rate IS NOT NULL
        GROUP BY subreddit
        ORDER BY rise DESC, subreddit
        """,
    ),
    "volume_by_community": (
        frozenset({"first_week", "last_week"}),
        """
        SELECT subreddit, sum(n_posts) AS posts, avg(n_active_authors) AS avg_authors
        FROM {weekly}
        WHERE week BETWEEN :first_week AND :last_week
        GROUP BY subreddit
        ORDER BY posts DESC, subreddit
        """,
    ),
}


def run_metric(weekly: DataFrame, name: str, **parameters) -> DataFrame:
    """Run a template; unknown names and wrong parameters are refused."""
    if name not in TEMPLATES:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(TEMPLATES)}")
    expected, statement = TEMPLATES[name]
    if set(parameters) != expected:
        raise ValueError(f"{name} takes {sorted(expected)}, got {sorted(parameters)}")
    return weekly.sparkSession.sql(statement, args=parameters, weekly=weekly)
