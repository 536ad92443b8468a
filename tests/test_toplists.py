"""Pruned top lists against scoring all pairs, and against MLlib's."""

import random

import numpy as np
import pytest

from ratemill.operators import recommend
from ratemill.operators.toplists import top_lists
from ratemill.plans import catalog

SF_DIR = "/root/testdata/sf0.01"


class Factors:
    """What of a model is asked for."""

    def __init__(self, spark, users, items):
        def table(rows):
            return spark.createDataFrame([(i, [float(x) for x in f]) for i, f in rows], "id int, features array<float>")

        self.userFactors, self.itemFactors = table(users), table(items)


def lists(df):
    return {r["user_id"]: [(x["movie_id"], x["rating"]) for x in r["recommendations"]] for r in df.collect()}


def brute(users, items, n):
    found = {}
    for user, u in users:
        scores = [(np.float32(np.dot(np.float32(u).astype(float), np.float32(f).astype(float))), item) for item, f in items]
        found[user] = [(item, float(score)) for score, item in sorted(scores, key=lambda x: (-x[0], -x[1]))[:n]]
    return found


@pytest.mark.parametrize("first, most", [(7, 20), (64, 64), (1000, 1000)])
def test_matches_scoring_all_pairs(spark, first, most):
    """With ties, items of no length, users of no length, and negative scores."""
    rnd = np.random.default_rng(4)
    items = [(i, rnd.normal(0, 1, 4) * (1 if i % 20 else 6)) for i in range(300)]
    items += [(1000 + i, items[40][1]) for i in range(12)] + [(2000 + i, np.zeros(4)) for i in range(3)]
    users = [(u, rnd.normal(0, 1, 4)) for u in range(120)] + [(500, np.zeros(4)), (501, -items[40][1])]
    found = top_lists(Factors(spark, users, items), 5, first, most)
    assert lists(found.lists) == brute(users, items, 5)
    assert found.pairs == len(users) * len(items) and found.scored <= found.pairs
    if first == 7:
        assert found.scored < 0.7 * found.pairs


def test_long_items_stop_the_search(spark):
    """Where lengths differ much, a small part of the pairs is scored."""
    rnd = np.random.default_rng(5)
    items = [(i, np.abs(rnd.normal(0, 1, 4)) * 0.97**i) for i in range(2000)]
    users = [(u, np.abs(rnd.normal(0, 1, 4))) for u in range(50)]
    found = top_lists(Factors(spark, users, items), 5, first=50, most=200)
    assert lists(found.lists) == brute(users, items, 5)
    assert found.scored < 0.2 * found.pairs


def test_fewer_items_than_asked_for(spark):
    items = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    found = top_lists(Factors(spark, [(7, [1.0, 2.0])], items), 5)
    assert lists(found.lists) == {7: [(2, 2.0), (1, 1.0)]}
    nothing = top_lists(Factors(spark, [(7, [1.0])], []), 5)
    assert nothing.lists.isEmpty() and nothing.pairs == 0
    assert top_lists(Factors(spark, [], items), 5).lists.isEmpty()


def test_matches_mllib(spark):
    model = catalog.full_model(spark, SF_DIR)
    found, listed = top_lists(model, 5, first=16, most=64), recommend.recommend(model, 5)
    ours, theirs = lists(found.lists), lists(listed)
    assert ours.keys() == theirs.keys()
    for user, items in theirs.items():
        assert [x for _, x in ours[user]] == pytest.approx([x for _, x in items], rel=1e-5)
        # MLlib adds in single precision, so nearly equal scores may change places.
        swapped = {a[0] for a in ours[user]} ^ {b[0] for b in items}
        assert all(abs(x - items[-1][1]) < 1e-5 * abs(x) for i, x in ours[user] + items if i in swapped)


def test_ties_are_mllibs(spark, ratings):
    """Items with the same ratings have the same factors: scores are equal, and so is the
    order of what both list. Of a tie at the last place MLlib keeps what its blocks give."""
    rnd = random.Random(2)
    rows = [(u, m, float(rnd.randrange(1, 6)), u * 100 + m) for u in range(12) for m in range(4)]
    rows += [(u, m + 10, r, t + 50) for u, m, r, t in rows]
    model = recommend.fit_als(ratings(rows), user_blocks=1, item_blocks=1)
    ours, theirs = lists(top_lists(model, 5).lists), lists(recommend.recommend(model, 5))
    for user, items in theirs.items():
        assert [i for i, _ in ours[user][:4]] == [i for i, _ in items[:4]]
        assert ours[user][4][0] % 10 == items[4][0] % 10
        assert ours[user][4][1] == pytest.approx(items[4][1], rel=1e-6)
