import itertools

from pyspark.sql import functions as F

from ratemill.operators.cleanse import clean_ratings, drop_incomplete
from ratemill.schemas import EVENT_COLUMNS


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_null_copy_does_not_hide_a_good_one(ratings):
    copies = [(1, 1, None, 5), (1, 1, 3.0, 5), (1, 1, 4.0, 5)]
    for order in itertools.permutations(copies):
        assert rows(clean_ratings(ratings(list(order)))) == [(1, 1, 4.0, 5)]


def test_incomplete_rows_and_nan_are_dropped(ratings):
    good = (1, 1, 1.0, 1)
    broken = [(None, 1, 1.0, 1), (1, None, 1.0, 1), (1, 1, None, 2), (1, 1, 1.0, None)]
    nan = (2, 2, float("nan"), 2)
    df = ratings([good, *broken, nan])
    assert rows(clean_ratings(df)) == [good]
    assert rows(drop_incomplete(df)) == rows(df.na.drop("any"))


def test_rating_is_not_part_of_the_key_but_the_second_is(ratings):
    df = ratings([(1, 1, 1.0, 1), (1, 1, 2.0, 2), (1, 2, 3.0, 1), (2, 1, 4.0, 1)])
    assert rows(clean_ratings(df)) == rows(df)


def test_latest_arrival_wins_over_a_higher_rating(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, 1, 10), (1, 1, 2.0, 1, 20), (1, 1, 1.0, 1, 20), (1, 1, None, 1, 30)],
        "user_id int, movie_id int, rating double, timestamp bigint, arrival int",
    )
    assert rows(clean_ratings(df, latest_by="arrival")) == [(1, 1, 2.0, 1)]


def test_one_key_with_a_third_of_all_rows(spark):
    n = 30000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int")
    df = spark.range(n).select(
        key.alias("user_id"),
        key.alias("movie_id"),
        (F.col("id") % 7).cast("double").alias("rating"),
        F.lit(1).cast("bigint").alias("timestamp"),
    )
    kept = clean_ratings(df)
    assert kept.columns == EVENT_COLUMNS
    assert kept.count() == n - n // 3 + 1
    assert kept.where("user_id = 0").first()["rating"] == 6.0


def test_copies_merge_before_the_shuffle(ratings):
    plan = clean_ratings(ratings([(1, 1, 1.0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_max(rating" in plan and "Window" not in plan


def test_null_tests_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(1).selectExpr(
        "1 AS user_id", "1 AS movie_id", "1D AS rating", "1L AS timestamp"
    ).write.parquet(path)
    plan = clean_ratings(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(user_id)" in plan and "IsNotNull(timestamp)" in plan
