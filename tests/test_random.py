"""Random events against plain Python."""

import random
from collections import defaultdict

import pytest

from ratemill.functions.calendar import FIRST_SECOND, LAST_SECOND
from ratemill.operators import marts, star
from ratemill.operators.cleanse import clean_ratings
from ratemill.plans.silver import read_silver, rebuild_silver, refresh_silver
from ratemill.streaming.bronze import append_batch

SECONDS = [0, 86399, 86400, 10 * 86400, -1, FIRST_SECOND - 1, LAST_SECOND + 1, None]


def random_events(rng, n):
    return [
        (
            rng.choice([1, 1, 1, 2, 3, None]),
            rng.choice([1, 1, 2, 3, None]),
            rng.choice([1.0, 2.5, 5.0, float("nan"), None]),
            rng.choice(SECONDS),
        )
        for _ in range(n)
    ]


def best_copies(events):
    best = {}
    for user, movie, rating, seconds in events:
        if None in (user, movie, rating, seconds) or rating != rating:
            continue
        key = (user, movie, seconds)
        best[key] = max(best.get(key, rating), rating)
    return sorted((u, m, r, s) for (u, m, s), r in best.items())


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_cleaning(ratings, seed):
    events = random_events(random.Random(seed), 300)
    assert rows(clean_ratings(ratings(events).repartition(5))) == best_copies(events)


@pytest.mark.parametrize("seed", range(3))
def test_refreshes(spark, ratings, tmp_path, seed):
    rng = random.Random(seed)
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    waves = [random_events(rng, rng.randrange(1, 40)) for _ in range(4)]
    for number, wave in enumerate(waves):
        append_batch(ratings(wave), number, bronze)
    rebuild_silver(spark, bronze, silver, 0)
    last = 0
    while last < 3:
        following = rng.randrange(last + 1, 4)
        refresh_silver(spark, bronze, silver, following, since=last)
        last = following
        seen = [event for wave in waves[: last + 1] for event in wave]
        assert rows(read_silver(spark, silver)) == best_copies(seen)


def test_trend(ratings):
    rng = random.Random(1)
    events = [(u, 1, float(rng.randrange(1, 6)), rng.randrange(10**9, 10**9 + 10**8)) for u in range(500)]
    fact = star.fact_ratings(ratings(events))
    counts = defaultdict(int)
    for date_id, in fact.select("date_id").collect():
        counts[date_id // 10000, date_id // 100 % 100] += 1
    trend = marts.trend_by_month(fact, star.dim_date(fact)).collect()
    assert [(row["year"], row["month"]) for row in trend] == sorted(counts, reverse=True)
    assert {(row["year"], row["month"]): row["total_ratings"] for row in trend} == counts
