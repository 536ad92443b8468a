"""Silver as runs, and the totals kept with them, against the full computation."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratemill.operators import marts, star
from ratemill.operators.cleanse import clean_ratings
from ratemill.plans import catalog, silver as plans
from ratemill.plans.silver import (
    has_totals,
    merge_silver,
    read_silver,
    read_totals,
    rebuild_silver,
    refresh_silver,
)
from ratemill.sources import storage
from ratemill.sources.bronze import append_batch, read_batches, read_bronze
from ratemill.sources.commits import newest

YEAR = 365 * 86400
SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def wave(seed, n=400):
    """Few users, items and seconds, so that keys return with other ratings."""
    rnd = random.Random(seed)
    return [
        (rnd.randrange(8), rnd.randrange(6), rnd.choice([1.0, 2.0, 3.5, 5.0, None]), rnd.randrange(40) * 86400)
        for _ in range(n)
    ]


def full_totals(clean, *key):
    return rows(star.fact_ratings(clean).groupBy(*key).agg(F.sum("rating"), F.count("rating")))


@pytest.fixture
def tables(spark, ratings, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for number in range(6):
        append_batch(ratings(wave(number)), number, bronze)
    return bronze, silver


def agrees(spark, bronze, silver, version):
    clean = clean_ratings(read_bronze(spark, bronze, version))
    assert rows(read_silver(spark, silver)) == rows(clean)
    totals = read_totals(spark, silver)
    assert rows(totals.by_item) == full_totals(clean, "movie_id")
    assert rows(totals.by_date) == full_totals(clean, "date_id")
    assert rows(totals.by_pair) == full_totals(clean, "user_id", "movie_id")


def test_totals_follow_new_and_risen_ratings(spark, tables):
    bronze, silver = tables
    rebuild_silver(spark, bronze, silver, 0)
    agrees(spark, bronze, silver, 0)
    for version in (1, 3, 5):
        refresh_silver(spark, bronze, silver, version)
        agrees(spark, bronze, silver, version)
    assert len(newest(spark, silver).of("rows")) == 4
    assert merge_silver(spark, silver, fan=2) > 0
    assert {part.kind for part in newest(spark, silver).parts} == {"rows", "by_item", "by_date", "by_pair"}
    assert len(newest(spark, silver).parts) == 4
    agrees(spark, bronze, silver, 5)


def test_totals_with_too_many_new_keys_to_broadcast(spark, tables, no_broadcast):
    bronze, silver = tables
    for version in (1, 4, 5):
        refresh_silver(spark, bronze, silver, version)
    agrees(spark, bronze, silver, 5)


def test_a_refresh_without_totals_reads_nothing_of_the_table(spark, tables, monkeypatch):
    bronze, silver = tables
    refresh_silver(spark, bronze, silver, 2, totals=False)
    assert not has_totals(spark, silver)

    def never(*args):
        raise AssertionError("read")

    with monkeypatch.context() as patched:
        patched.setattr(plans, "read_runs", never)
        patched.setattr(plans, "read_kind", never)
        refresh_silver(spark, bronze, silver, 5)
    assert rows(read_silver(spark, silver)) == rows(clean_ratings(read_bronze(spark, bronze)))
    with pytest.raises(ValueError):
        read_totals(spark, silver)
    merge_silver(spark, silver, fan=2)
    assert len(newest(spark, silver).parts) == 1
    assert rows(read_silver(spark, silver)) == rows(clean_ratings(read_bronze(spark, bronze)))


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("totals", [False, True])
def test_bytes_of_a_refresh_follow_the_new_rows(spark, tmp_path, totals):
    """Event times are uniform over a year, so that every date is touched."""
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def events(seed, n):
        return spark.range(n, numPartitions=2).select(
            (F.rand(seed) * 5000).cast("int").alias("user_id"),
            (F.rand(seed + 1) * 30).cast("int").alias("movie_id"),
            F.ceil(F.rand(seed + 2) * 5).cast("double").alias("rating"),
            (F.rand(seed + 3) * YEAR).cast("long").alias("timestamp"),
        )

    append_batch(events(10, 400_000), 0, bronze)
    refresh_silver(spark, bronze, silver, totals=totals)
    before = set(storage.children(spark, f"{silver}/data"))
    append_batch(events(20, 20_000), 1, bronze)
    refresh_silver(spark, bronze, silver)
    added = set(storage.children(spark, f"{silver}/data")) - before
    plain = str(tmp_path / "plain")
    clean_ratings(read_batches(spark, bronze, 0, 1)).coalesce(1).write.parquet(plain)
    written = sum(size(f"{silver}/data/{name}") for name in added)
    assert written <= 3 * size(plain), (written, size(plain))
    assert star.dim_date(star.fact_ratings(read_silver(spark, silver))).count() == 365


def test_an_older_reader_can_finish(spark, tables):
    bronze, silver = tables
    refresh_silver(spark, bronze, silver, 3)
    opened, expected = read_silver(spark, silver), rows(clean_ratings(read_bronze(spark, bronze, 3)))
    refresh_silver(spark, bronze, silver, 5)
    merge_silver(spark, silver, fan=2)
    rebuild_silver(spark, bronze, silver)
    assert rows(opened) == expected


def test_merging_needs_one_shuffle_by_ranges_of_the_key(spark, tables):
    bronze, silver = tables
    for version in (0, 1):
        refresh_silver(spark, bronze, silver, version, totals=False)
    runs = newest(spark, silver).of("rows")
    kind = plans.ROWS
    merged = kind.merged(plans.read_runs(spark, silver, runs, kind).repartitionByRange(*kind.key))
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_an_overtaken_merge_changes_nothing(spark, tables, monkeypatch):
    bronze, silver = tables
    for version in range(3):
        refresh_silver(spark, bronze, silver, version, totals=False)
    from ratemill.sources import runs

    plain = runs.write_run

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(runs, "write_run", plain)
        rebuild_silver(spark, bronze, silver, 5, totals=False)
        return plain(*args, **kwargs)

    monkeypatch.setattr(runs, "write_run", overtaken)
    assert merge_silver(spark, silver, fan=3) == 0
    assert len(newest(spark, silver).parts) == 1
    assert rows(read_silver(spark, silver)) == rows(clean_ratings(read_bronze(spark, bronze)))


def test_a_format_with_versions_is_asked_for_changes_only(spark, ratings, tmp_path, monkeypatch):
    """A stand-in for a reader of changes: it gives the versions it is asked for."""
    asked = []

    def changes(session, path, since, version, fmt):
        asked.append((since, version))
        return ratings(sum((wave(n) for n in range(since + 1, version + 1)), []))

    def whole(session, path, version, fmt):
        asked.append(("all", version))
        return ratings(sum((wave(n) for n in range(version + 1)), []))

    monkeypatch.setattr(plans, "read_batches", changes)
    monkeypatch.setattr(plans, "read_bronze", whole)
    silver = str(tmp_path / "silver")
    for version in (1, 3, 4):
        refresh_silver(spark, "nowhere", silver, version, fmt="orc")
    assert asked == [("all", 1), (1, 3), (3, 4)]
    assert rows(read_silver(spark, silver, "orc")) == rows(clean_ratings(ratings(sum(map(wave, range(5)), []))))


def test_the_options_of_a_reader_of_changes(spark, ratings, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader
    from test_formats import stand_in

    path = str(tmp_path / "changes")
    changed = ratings([(1, 1, 3.0, 10), (2, 1, 4.0, 20)])
    kinds = F.when(F.col("user_id") == 1, "insert").otherwise("delete")
    changed.select("*", kinds.alias("_change_type"), F.lit(4).alias("_commit_version")).write.parquet(path)
    seen = stand_in(monkeypatch, DataFrameReader, "delta", "parquet")
    assert rows(read_batches(spark, path, 3, 7, "delta")) == [(1, 1, 3.0, 10)]
    assert seen == {"format": "delta", "readChangeFeed": "true", "startingVersion": 4, "endingVersion": 7}


@pytest.mark.parametrize("name", ["top_items", "trend_by_month", "location_genre"])
def test_reports_from_totals_scan_no_facts(spark, name):
    """Equal to the report on facts, and of Silver only the totals are read."""
    refreshed = catalog.QUERIES[f"{name}_refreshed"](spark, SF_DIR)
    path = catalog._silver_with_totals(spark, SF_DIR)
    facts = [part.folder for part in newest(spark, path).of("rows")]
    assert len(facts) == 3
    read = refreshed.inputFiles()
    assert any(path in file for file in read)
    assert not [file for file in read if any(folder in file for folder in facts)]
    full = catalog.QUERIES[name](spark, SF_DIR)
    assert [tuple(r) for r in refreshed.collect()] == [tuple(r) for r in full.collect()]


def test_reports_take_totals(spark, ratings):
    clean = clean_ratings(ratings(wave(1)))
    fact = star.fact_ratings(clean)
    sums = F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count")
    items = spark.createDataFrame([(m, f"t{m % 3}", "g", 2000) for m in range(6)], "movie_id int, title string, genre string, release_year int")
    by_item = fact.groupBy("movie_id").agg(*sums)
    assert rows(marts.top_items(by_item, items)) == rows(marts.top_items(fact, items))
