import random
from collections import defaultdict

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ratemill.operators import joins, marts, star
from ratemill.plans.catalog import QUERIES


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_dim_date_is_unique_per_date(ratings):
    df = ratings([(1, 1, 1.0, 1700000000), (1, 1, 1.0, 1700000001), (2, 1, 1.0, 1700000001)])
    assert rows(star.dim_date(star.fact_ratings(df))) == [(20231114, 2023, 11, 14)]


def test_times_out_of_range_share_an_unknown_date(ratings):
    df = ratings([(1, 1, 1.0, 10**15), (2, 1, 1.0, -(10**15))])
    assert rows(star.dim_date(star.fact_ratings(df))) == [(0, 0, 0, 0)]
    assert rows(star.fact_ratings(df)) == [(1, 1, 0, 1.0), (2, 1, 0, 1.0)]


def test_trend_total_is_the_number_of_facts(ratings):
    df = ratings([(user, 1, 1.0 + user % 5, 1700000000 + user) for user in range(100)])
    fact = star.fact_ratings(df)
    trend = marts.trend_by_month(fact, star.dim_date(fact))
    assert rows(trend) == [(2023, 11, 3.0, 100)]


def test_check_star(spark):
    fact = spark.createDataFrame(
        [(1, 10), (1, 11), (2, 10), (None, 99), (None, 10)], "user_id int, movie_id int"
    )
    users = spark.createDataFrame([(1,), (1,), (3,)], "user_id int")
    movies = spark.createDataFrame([(10,), (11,)], "movie_id int")
    found = star.check_star(fact, {"u": (users, "user_id"), "m": (movies, "movie_id")})
    assert rows(found) == [
        ("duplicate_key", "m", 0, 0),
        ("duplicate_key", "u", 1, 2),
        ("orphan_fact", "m", 1, 1),
        ("orphan_fact", "u", 2, 3),
    ]


def test_check_star_of_empty_tables(spark):
    fact = spark.createDataFrame([], "user_id int")
    users = spark.createDataFrame([], "user_id int")
    assert rows(star.check_star(fact, {"u": (users, "user_id")})) == [
        ("duplicate_key", "u", 0, 0),
        ("orphan_fact", "u", 0, 0),
    ]


# A third of the facts on one user and on one item, repeated pairs, orphans,
# and dimension keys that occur twice.
def skewed(spark):
    rng = random.Random(7)
    facts = [
        (
            0 if rng.random() < 0.4 else rng.randrange(60),
            0 if rng.random() < 0.4 else rng.randrange(40),
            20240100 + rng.randrange(1, 32),
            float(rng.randrange(1, 6)),
        )
        for _ in range(4000)
    ]
    users = [(u, f"place {u % 4}") for u in range(50)] + [(3, "place 9")]
    items = [(m, f"title {m % 9}", f"genre {m % 3}") for m in range(30)] + [(5, "title 0", "genre 8")]
    return (
        facts,
        users,
        items,
        spark.createDataFrame(facts, "user_id int, movie_id int, date_id int, rating double"),
        spark.createDataFrame(users, "user_id int, location string"),
        spark.createDataFrame(items, "movie_id int, title string, genre string"),
    )


def expected_location_genre(facts, users, items):
    sums = defaultdict(list)
    for user, movie, _, rating in facts:
        for u, place in users:
            if u == user:
                for m, _, genre in items:
                    if m == movie:
                        sums[place, genre].append(rating)
    report = [(p, g, sum(r) / len(r), len(r)) for (p, g), r in sums.items()]
    return sorted(report, key=lambda row: (-row[3], row[0], row[1]))[:10]


def check_reports(spark):
    facts, users, items, fact, dim_user, dim_item = skewed(spark)
    found = [tuple(row) for row in marts.location_genre(fact, dim_user, dim_item).collect()]
    expected = expected_location_genre(facts, users, items)
    assert [row[:2] + row[3:] for row in found] == [row[:2] + row[3:] for row in expected]
    assert [row[2] for row in found] == pytest.approx([row[2] for row in expected], abs=0.0051)

    sums = defaultdict(list)
    for _, movie, _, rating in facts:
        for m, title, _ in items:
            if m == movie:
                sums[title].append(rating)
    counts = {row["title"]: row["total_ratings"] for row in marts.top_items(fact, dim_item).collect()}
    assert counts == {title: len(r) for title, r in sums.items()}


def test_reports_with_broadcast(spark):
    check_reports(spark)


def test_reports_without_broadcast(spark, no_broadcast):
    check_reports(spark)


def _some_fit(monkeypatch, fitting):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: bool(set(df.columns) & fitting))


@pytest.mark.parametrize("fitting", [{"user_id"}, {"movie_id"}])
def test_reports_with_one_large_dimension(spark, monkeypatch, fitting):
    _some_fit(monkeypatch, fitting)
    check_reports(spark)


def test_large_dimensions_see_sums_only(spark, no_broadcast):
    *_, fact, dim_user, dim_item = skewed(spark)
    plan = marts.location_genre(fact, dim_user, dim_item)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i in reversed(range(len(lines))) if "rating#" in lines[i] and "Scan" in lines[i])
    above = [line for line in lines[:scan] if "Exchange" in line or "partial_sum" in line]
    assert "partial_sum" in above[-1] or "partial_sum" in above[-2]
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_size_check_follows_the_session_setting(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(1000).write.parquet(path)
    dim = spark.read.parquet(path)
    assert joins.fits_broadcast(dim)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        assert not joins.fits_broadcast(dim)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_size_check_counts_rows_and_texts(spark, tmp_path):
    """Five million rows take a few kilobytes on disk and far more in memory."""
    path = str(tmp_path / "ids")
    constant = F.lit("somewhere").alias("location")
    spark.range(5_000_000).select((F.col("id") * 2).cast("int").alias("user_id"), constant).write.option(
        "compression", "zstd"
    ).parquet(path)
    dim = spark.read.parquet(path)
    assert not joins.fits_broadcast(dim)
    rows_in = spark.range(10).select(F.col("id").cast("int").alias("user_id"))
    plan = joins.join_dimension(rows_in, dim, "user_id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    long_texts = spark.range(50).select("id", F.repeat(F.lit("x"), 1_000_000).alias("title"))
    assert not joins.fits_broadcast(long_texts)
    assert joins.fits_broadcast(long_texts.limit(3)) and joins.fits_broadcast(long_texts.limit(0))


def test_left_join_keeps_every_row_once(spark, no_broadcast):
    rows_in = spark.range(5000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("movie_id")
    )
    dim = spark.range(100).select(F.col("id").alias("movie_id"), F.concat(F.lit("t"), "id").alias("title"))
    joined = joins.join_dimension(rows_in, dim, "movie_id", "left")
    assert "explode" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 5000
    assert joined.where("movie_id = 1 AND title = 't1'").count() == rows_in.where("movie_id = 1").count()
    assert joined.where("movie_id >= 100 AND title IS NULL").count() == rows_in.where("movie_id >= 100").count()


def test_profiles_are_not_shuffled(spark):
    plan = QUERIES["location_genre"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
