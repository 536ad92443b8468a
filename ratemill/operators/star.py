"""Clean ratings to a star schema, and a check of its keys."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratemill.functions import calendar


def dim_item(items: DataFrame) -> DataFrame:
    """Item dimension out of a catalog table."""
    return items.select(
        F.col("movie_id").cast("int").alias("movie_id"),
        F.col("title").cast("string").alias("title"),
        F.col("genre").cast("string").alias("genre"),
        F.col("release_year").cast("int").alias("release_year"),
    )


def dim_user(profiles: DataFrame) -> DataFrame:
    """User dimension out of a profile table."""
    return profiles.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("username").cast("string").alias("username"),
        F.col("age").cast("int").alias("age"),
        F.col("gender").cast("string").alias("gender"),
        F.col("location").cast("string").alias("location"),
        F.col("subscription_tier").cast("string").alias("subscription_tier"),
    )


def fact_ratings(ratings: DataFrame) -> DataFrame:
    """One fact per clean rating, keyed by user, item and date."""
    return ratings.select(
        "user_id",
        "movie_id",
        calendar.date_id(F.col("timestamp")).alias("date_id"),
        "rating",
    )


def dim_date(fact: DataFrame) -> DataFrame:
    """One row per calendar date with a fact."""
    key = F.col("date_id")
    return (
        fact.select(key)
        .where(key.isNotNull())
        .distinct()
        .select(
            key,
            calendar.year_of(key).alias("year"),
            calendar.month_of(key).alias("month"),
            calendar.day_of(key).alias("day"),
        )
    )


def check_star(
    fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Broken keys per dimension, as counts of keys and of rows.

    ``dimensions`` maps a table name to the table and its key column. Reports
    keys that occur more than once in a dimension and fact keys it lacks (a
    NULL fact key is one of them). All facts are read once, and both sides are
    counted per key before they meet, so a hot key is one row in the join.
    """
    copies = reduce(
        DataFrame.unionByName,
        [
            table.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"))
            for name, (table, key) in dimensions.items()
        ],
    )
    uses = fact.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key")
                    )
                    for name, (_, key) in dimensions.items()
                ]
            )
        )
    )
    by_key = ["table_name", "key"]
    matched = (
        copies.groupBy(*by_key)
        .agg(F.count("*").alias("n_copies"))
        .join(uses.groupBy(*by_key).agg(F.count("*").alias("n_uses")), by_key, "full")
    )
    repeated, orphan = F.col("n_copies") > 1, F.col("n_copies").isNull()
    found = matched.groupBy("table_name").agg(
        F.count_if(repeated).alias("repeated_keys"),
        F.sum(F.when(repeated, F.col("n_copies"))).alias("repeated_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.sum(F.when(orphan, F.col("n_uses"))).alias("orphan_rows"),
    )

    def report(check: str, kind: str) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"),
            F.col("table_name"),
            F.coalesce(f"{kind}_keys", F.lit(0)).alias("bad_keys"),
            F.coalesce(f"{kind}_rows", F.lit(0)).alias("bad_rows"),
        )

    names = fact.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in dimensions])).alias("table_name")
    )
    reports = F.array(report("duplicate_key", "repeated"), report("orphan_fact", "orphan"))
    return names.join(found, "table_name", "left").select(F.inline(reports))
