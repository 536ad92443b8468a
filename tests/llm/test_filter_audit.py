"""The audit of filters against plain Python sets; the SQL test is with the queries."""

from itertools import permutations

import pytest
from conftest import SF_DIR

from ratemill.llm import filter_audit
from ratemill.llm.queries import QUERIES


def plain_audit(fails, parts, good, toxic):
    """Rows of the audit from sets of row numbers."""
    names, rows = list(fails), {}
    for part in set(parts.values()):
        here = {r for r, p in parts.items() if p == part}
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            left = set(here)
            for step, name in enumerate(order, 1):
                mine = fails[name] & here
                gone = left & mine
                others = set().union(*(fails[n] for n in names if n != name))
                left -= gone
                shapley[name] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), len(mine) - len(gone), len(mine - others),
                    len(gone & good), len(gone & toxic), name,
                ]
        for key, row in rows.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {key: tuple(row) for key, row in rows.items()}


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows)
    return got


PROSE = " ".join(f"word{i}" for i in range(120))
SHOUT = " ".join(f"WORD{i}" for i in range(120))
ROWS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (None, PROSE, "en"), (3, PROSE + "$", None),
    (4, SHOUT, "de"), (5, "a " * 150, "de"), (6, None, "de"), (7, "", ""), (8, "A#", "en"), (9, "\t\x0b\n", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 1, None), (5, None, 1), (8, 0, 1), (None, 1, 1)]
FAILS = {
    "A": {7, 8, 9, 10}, "B": {6}, "C": {5, 9}, "D": {4, 9}, "E": {1, 2, 8},
}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(
        [(*row, "x", "y", 0) for row in ROWS], "doc_id long, text string, lang string, file string, words string, filter int"
    )
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_matches_plain_sets(tables):
    parts = {at: lang or "" for at, (_, _, lang) in enumerate(ROWS)}
    want = plain_audit(FAILS, parts, good={0, 1, 2, 5}, toxic={1, 2, 6, 9})
    got = found(filter_audit.audit(*tables))
    assert len(got) == 120 * 5 * 4
    assert got == want


def test_matches_plain_sets_without_broadcast(tables, no_broadcast):
    parts = {at: lang or "" for at, (_, _, lang) in enumerate(ROWS)}
    want = plain_audit(FAILS, parts, good={0, 1, 2, 5}, toxic={1, 2, 6, 9})
    counts = filter_audit.audit(*tables)
    assert found(counts) == want
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan


def test_own_filters(tables, spark):
    tests = {"X": filter_audit.TESTS["A"], "Y": filter_audit.TESTS["D"]}
    got = found(filter_audit.audit(*tables, tests=tests, repeated=None))
    parts = {at: lang or "" for at, (_, _, lang) in enumerate(ROWS)}
    assert got == plain_audit({"X": FAILS["A"], "Y": FAILS["D"]}, parts, good={0, 1, 2, 5}, toxic={1, 2, 6, 9})
    with pytest.raises(ValueError):
        filter_audit.audit(*tables, tests={str(n): filter_audit.TESTS["A"] for n in range(8)}, repeated=None)


def test_empty_tables(tables):
    docs, labels = tables
    assert filter_audit.audit(docs.limit(0), labels).isEmpty()
    got = found(filter_audit.audit(docs, labels.limit(0)))
    assert len(got) == 2400 and all(row[4] == row[5] == 0 for row in got.values())


def test_query_has_every_step(spark):
    df = QUERIES["op11_filter_audit"](spark, SF_DIR)
    rows = df.count()
    assert rows == 600 * df.select("part").distinct().count()
