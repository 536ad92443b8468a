"""Recommendations for display."""

from pyspark.sql import DataFrame, functions as F

from ratemill.functions.numbers import match_percent
from ratemill.operators.joins import join_dimension

UNKNOWN_TITLE = "Unknown"


def lookup(recommendations: DataFrame, users: DataFrame) -> DataFrame:
    """Recommendations of the given users, one row per distinct ``user_id``.

    ``status`` is ``success``, or ``not_found`` for a user without any.
    Requests are made distinct first, so one user asked for very often is a
    single row in the join.
    """
    found = F.col("recommendations").isNotNull()
    return (
        users.select("user_id")
        .distinct()
        .join(recommendations, "user_id", "left")
        .select(
            "user_id",
            F.when(found, "success").otherwise("not_found").alias("status"),
            "recommendations",
        )
    )


def lookup_user(recommendations: DataFrame, user_id: int) -> DataFrame:
    """Recommendations of one user; empty if there are none."""
    return recommendations.where(F.col("user_id") == user_id)


def enrich(scored: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Add ``title`` and ``match_percent`` to rows of user, item and ``score``."""
    titles = dim_item.select("movie_id", "title")
    joined = join_dimension(scored, titles, "movie_id", "left")
    return joined.select(
        *scored.columns,
        F.coalesce("title", F.lit(UNKNOWN_TITLE)).alias("title"),
        match_percent(F.col("score")).alias("match_percent"),
    )
