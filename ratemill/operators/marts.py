"""The published reports on the star schema.

Each takes facts, or totals of ratings per the keys it joins on, which Silver keeps.
"""

from pyspark.sql import DataFrame, functions as F

from ratemill.functions.numbers import mean
from ratemill.operators.joins import Dimension, rating_totals


def _report(totals: DataFrame, groups: list[str], digits: int) -> DataFrame:
    return totals.select(
        *groups,
        mean(F.col("rating_sum"), F.col("rating_count"), digits).alias("average_rating"),
        F.col("rating_count").alias("total_ratings"),
    )


def top_items(fact: DataFrame, dim_item: DataFrame, n: int = 10) -> DataFrame:
    """Best titles by rounded average, then by count; equal titles merge."""
    totals = rating_totals(fact, [Dimension(dim_item, "movie_id", ("title",))])
    return (
        _report(totals, ["title"], 2)
        .orderBy(F.desc("average_rating"), F.desc("total_ratings"), "title")
        .limit(n)
    )


def trend_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Count and average per calendar month, newest first."""
    totals = rating_totals(fact, [Dimension(dim_date, "date_id", ("year", "month"))])
    return _report(totals, ["year", "month"], 1).orderBy(F.desc("year"), F.desc("month"))


def location_genre(
    fact: DataFrame, dim_user: DataFrame, dim_item: DataFrame, n: int = 10
) -> DataFrame:
    """Most rated combinations of user location and item genre."""
    totals = rating_totals(
        fact,
        [
            Dimension(dim_item, "movie_id", ("genre",)),
            Dimension(dim_user, "user_id", ("location",)),
        ],
    )
    return (
        _report(totals, ["location", "genre"], 2)
        .orderBy(F.desc("total_ratings"), "location", "genre")
        .limit(n)
    )


def sample(table: DataFrame, n: int = 5) -> DataFrame:
    """A few rows, the same ones every time."""
    return table.orderBy(*table.columns).limit(n)
