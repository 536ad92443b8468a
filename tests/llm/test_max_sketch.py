"""Ranked search against scoring every document; the SQL test is with the queries."""

import random
from collections import Counter

import numpy as np
import pytest

from ratemill.llm import max_sketch

N_DOCS = 400


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) over all documents, from the formulas alone."""
    split = [max_sketch.terms_of((t or "").encode()) for _, t in docs]
    count, total = sum(map(bool, split)), sum(map(len, split))
    df = Counter(t for terms in split for t in set(terms))
    rows = []
    for item_id, text in items:
        scored = []
        for at, terms in enumerate(split):
            if terms:
                tf, m = Counter(terms), 100 - 90 + 90 * len(terms) * count // total
                score = sum(
                    max_sketch.weight_of(count, df[t]) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in set(max_sketch.terms_of((text or "").encode()))
                    if tf[t]
                )
                scored.append((-score, docs[at][0] is None, docs[at][0] or 0))
        best = [s for s in sorted(scored) if s[0] < 0][:k]
        rows += [(item_id, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(best, 1)]
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(3000)] + ["été", "Straße", "日本"]
    common = rnd.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=200_000)
    docs = []
    for doc_id in range(N_DOCS):
        size = rnd.choice([3, 30, 300, 2000 if doc_id % 50 == 0 else 100])
        at = rnd.randrange(len(common) - size)
        docs.append((doc_id, " ".join(common[at : at + size])))
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # copies, so ties
    docs += [(None, docs[7][1]), (3, docs[7][1]), (5000, None), (5001, ""), (5002, "...!"), (5003, "w1 " * 400)]
    items = [(i, docs[i * 9][1][: rnd.choice([40, 200])].upper()) for i in range(20)]
    items += [(7, docs[7][1]), (7, docs[7][1]), (None, "w1"), (50, None), (51, "unheard of"), (52, "")]
    return docs, items


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(spark, docs, items):
    documents = spark.createDataFrame(
        [(*row, 1, "x", "y") for row in docs], "doc_id long, text string, row int, item string, bound string"
    )
    return documents, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("width, at_once", [(8192, 4096), (64, 50), (2, 4096)])
def test_matches_scoring_all(spark, corpus, width, at_once):
    """Also where all terms share two coordinates, and where each item is a block."""
    documents, items = tables(spark, *corpus)
    index = max_sketch.build_index(documents.repartition(5), width=width)
    got = found(max_sketch.search(index, items, k=10, terms_at_once=at_once))
    assert got == brute(*corpus, 10)


def test_sketches_are_packed_whole():
    rnd = np.random.default_rng(1)
    folded = rnd.integers(0, 256, (50, 128)).astype(np.uint8) * (rnd.random((50, 128)) < 0.1)
    folded[7] = 0
    rows = max_sketch.packed(folded)
    assert rows[7] == b"" and (max_sketch.unpacked(rows, 128) == folded).all()
    assert max_sketch.packed(folded[:0]) == [] and max_sketch.unpacked([], 128).shape == (0, 128)


def test_bounds_are_bounds(corpus):
    docs, items = corpus
    split = [max_sketch.terms_of((t or "").encode()) for _, t in docs]
    split = [terms for terms in split if terms]
    counts = [Counter(terms) for terms in split]
    df = Counter(t for c in counts for t in c)
    count, total = len(split), sum(map(len, split))
    weights = {t: max_sketch.weight_of(count, n) for t, n in sorted(df.items())}
    numbers = {t: at for at, t in enumerate(weights)}
    asked = [[numbers[t] for t in set(max_sketch.terms_of((x or "").encode())) if t in numbers] for _, x in items]
    for width in (2, 256, 8192):
        block = max_sketch.Block(asked, weights, count, total, width)
        folded = max_sketch.sketches(counts, max_sketch._Coordinates(width))
        bounds = block.bounds(np.array([len(t) for t in split]), folded)
        scores = np.array([[block.score(i, added) for i in range(len(items))] for added in map(block.contributions, split)])
        assert (bounds >= scores).all()
        if width == 8192:
            assert (bounds <= scores * 1.05 + 1e4).mean() > 0.95


def test_many_rows_with_the_same_score(spark):
    """Ties beyond k are decided by the id, in every task and between tasks."""
    docs = [(i, "same words here") for i in range(200, 0, -1)] + [(0, "other")]
    documents, items = tables(spark, docs, [(1, "same")])
    index = max_sketch.build_index(documents.repartition(7))
    assert [r[2] for r in sorted(found(max_sketch.search(index, items, k=3)), key=lambda r: r[1])] == [1, 2, 3]


def test_empty_tables(spark, corpus):
    documents, items = tables(spark, *corpus)
    nothing = max_sketch.build_index(documents.limit(0))
    assert max_sketch.search(nothing, items).isEmpty()
    wordless = max_sketch.build_index(documents.where("doc_id between 5000 and 5002"))
    assert max_sketch.search(wordless, items).isEmpty()
    index = max_sketch.build_index(documents.limit(20))
    assert max_sketch.search(index, items.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        max_sketch.build_index(documents, width=3)


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "y")], "item_id string, text string")
    rows = found(max_sketch.search(max_sketch.build_index(docs), items))
    assert [(r[0], r[1], r[2]) for r in sorted(rows, key=lambda r: r[1])] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]
