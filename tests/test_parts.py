import pytest
from conftest import SF_DIR

from ratemill.operators import parts
from ratemill.operators.cleanse import clean_ratings
from ratemill.operators.parts import spread
from ratemill.plans import fixtures
from ratemill.plans.catalog import QUERIES


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture
def some(spark, monkeypatch):
    """Twice as many parts as cores, of ten rows each."""
    monkeypatch.setattr(parts, "ROWS_PER_PART", 10)
    return 2 * spark.sparkContext.defaultParallelism


def test_parts_follow_the_rows(spark, some):
    df = spark.range(10 * some)
    assert spread(df, 10 * some, "id").rdd.getNumPartitions() == some
    assert spread(df, 10 * some + 1, "id").rdd.getNumPartitions() == some + 1
    assert spread(df, 10, "id") is df and spread(df, None, "id") is df and spread(df, 0, "id") is df


@pytest.mark.parametrize("latest_by", [None, "arrival"])
def test_many_ratings_are_dealt_by_key(spark, some, latest_by):
    df = spark.range(10 * some).selectExpr(
        "nullif(cast(id % 70 AS int), 5) AS user_id", "cast(id % 2 AS int) AS movie_id",
        "cast(id % 9 AS double) AS rating", "id % 3 AS timestamp", "id AS arrival",
    )
    kept = clean_ratings(df, latest_by, rows=10 * some)
    assert kept.rdd.getNumPartitions() == some
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert rows(kept) == rows(clean_ratings(df, latest_by))


def test_large_silver_is_made_in_parts_of_the_lines(spark, monkeypatch):
    expected = rows(QUERIES["silver_large"](spark, SF_DIR))
    lines = fixtures.n_order_lines(spark, SF_DIR)
    some = 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(parts, "ROWS_PER_PART", -(-lines // some))
    found = QUERIES["silver_large"](spark, SF_DIR)
    assert found.rdd.getNumPartitions() == some
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    assert rows(found) == expected
