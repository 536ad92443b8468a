import pytest
from test_star import skewed

from ratemill.operators import joins, marts, parts
from ratemill.plans.star import Star, read_star, write_star


@pytest.mark.parametrize("fitting", [set(), {"user_id"}, {"movie_id"}])
def test_many_stored_facts_are_dealt_for_the_report(spark, tmp_path, monkeypatch, fitting):
    facts, users, items, fact, dim_user, dim_item = skewed(spark)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: bool(set(df.columns) & fitting))
    expected = marts.location_genre(fact, dim_user, dim_item).collect()

    dates = fact.select("date_id").distinct()
    write_star(Star(dim_item, dim_user, dates, fact), str(tmp_path))
    stored = read_star(spark, str(tmp_path))
    some = 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(parts, "ROWS_PER_PART", -(-len(facts) // some))
    found = marts.location_genre(stored.fact_ratings, stored.dim_user, stored.dim_item)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and plan.count(f", {some}") >= 2
    assert found.collect() == expected
    # One key alone has few sums; they are added up before any shuffle.
    plan = marts.top_items(stored.fact_ratings, stored.dim_item)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan
