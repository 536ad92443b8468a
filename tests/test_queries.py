"""Every registered query against its SQL at sf0.01."""

import pytest
from conftest import SF_DIR
from oracle import compare, duck

import __spark_entry__ as driver
from ratemill.plans.catalog import QUERIES
from ratemill.plans.oracles import ORACLES

WITHOUT_SQL = {"predictions", "rmse", "recommendations", "rec_enriched"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_only_model_output_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


def test_all_are_registered():
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_model_output_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        name
        for name in ORACLES
        if name.startswith(("top_items", "trend", "location", "rating_display", "star_check"))
    ],
)
def test_matches_sql_without_broadcast(spark, connection, no_broadcast, name):
    df = QUERIES[name](spark, SF_DIR)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df, connection, ORACLES[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).columns == ["title", "average_rating", "total_ratings"]
    assert driver.entry(spark).count() == 10
