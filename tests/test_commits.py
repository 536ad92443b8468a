"""Commits of Bronze: readers, compactions and writers beside each other."""

import time

import pytest

from ratemill.plans.silver import read_silver, refresh_silver, silver_version
from ratemill.sources import bronze, commits, storage
from ratemill.sources.bronze import (
    StaleWriter,
    append_batch,
    begin_writing,
    bronze_versions,
    compact_bronze,
    latest_version,
    read_batches,
    read_bronze,
)
from ratemill.sources.commits import Commit, Conflict, Part, joined, newest, sweep, update


def wave(number):
    return [(number, item, 3.0, 100 * number + item) for item in range(3)]


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture
def table(spark, ratings, tmp_path):
    path = str(tmp_path / "bronze")
    for number in range(4):
        append_batch(ratings(wave(number)), number, path)
    return path


EVERYTHING = sorted(sum(map(wave, range(4)), []))

#: What a read takes in, one after another; a compaction is put after each.
STEPS = [
    (storage, "children"),
    (storage, "read_text"),
    (commits, "children"),
    (commits, "read_text"),
    (bronze, "newest"),
    (bronze, "_read"),
    (bronze, "_holds"),
]


@pytest.mark.parametrize("module, step", STEPS, ids=[f"{m.__name__}.{s}" for m, s in STEPS])
@pytest.mark.parametrize("when", ["before", "after"])
def test_no_event_is_lost_to_a_compaction(spark, table, monkeypatch, tmp_path, module, step, when):
    silver = str(tmp_path / "silver")
    refresh_silver(spark, table, silver, 0)
    plain, busy = getattr(module, step), []

    def with_compaction(*args, **kwargs):
        if busy:
            return plain(*args, **kwargs)
        busy.append(step)
        try:
            if when == "before":
                compact_bronze(spark, table)
            found = plain(*args, **kwargs)
            if when == "after":
                compact_bronze(spark, table)
            return found
        finally:
            busy.clear()

    monkeypatch.setattr(module, step, with_compaction)
    assert rows(read_bronze(spark, table)) == EVERYTHING
    assert rows(read_bronze(spark, table, 2)) == sorted(sum(map(wave, range(3)), []))
    assert rows(read_batches(spark, table, 0, 3)) == sorted(sum(map(wave, range(1, 4)), []))
    assert refresh_silver(spark, table, silver) == 3
    assert rows(read_silver(spark, silver)) == EVERYTHING


def test_a_frame_opened_before_a_compaction_can_be_read_after_it(spark, table):
    opened = read_bronze(spark, table)
    assert compact_bronze(spark, table) == 3
    assert rows(opened) == EVERYTHING == rows(read_bronze(spark, table))


def test_replaced_folders_go_after_the_stated_number_of_commits(spark, table, ratings, monkeypatch):
    for module in (commits.update, commits.sweep):
        monkeypatch.setattr(module, "__defaults__", (3,))
    before = {part.folder for part in newest(spark, table).parts}
    compact_bronze(spark, table)
    for number in range(4, 6):
        append_batch(ratings(wave(number)), number, table)
        assert all(storage.exists(spark, f"{table}/{folder}") for folder in before)
    for number in range(6, 8):
        append_batch(ratings(wave(number)), number, table)
    assert not any(storage.exists(spark, f"{table}/{folder}") for folder in before)
    assert bronze_versions(spark, table) == list(range(8)) and read_bronze(spark, table).count() == 24
    assert len([n for n in storage.children(spark, f"{table}/_log") if n.endswith(".json")]) == 3


def test_a_cut_off_write_is_never_seen_and_goes(spark, table, ratings, monkeypatch):
    left = f"{table}/data/{newest(spark, table).number}-cut-off"
    ratings([(77, 1, 1.0, 10)]).write.parquet(left)
    assert rows(read_bronze(spark, table)) == EVERYTHING
    sweep(spark, table)
    assert storage.exists(spark, left)  # its writer may still commit it
    monkeypatch.setattr(sweep, "__defaults__", (1,))
    for number in range(4, 6):
        append_batch(ratings(wave(number)), number, table)
    sweep(spark, table)
    assert not storage.exists(spark, left) and read_bronze(spark, table).count() == 18
    late = Part(f"data/{newest(spark, table).number - 3}-late", 9, 9, 1, ((9, 9),))
    with pytest.raises(Conflict):
        update(spark, table, lambda now: now.replaced([], late), keep=2)


def test_two_compactions(spark, table, monkeypatch):
    """The slower one finds its parts replaced, and leaves the table as it is."""
    plain, busy = bronze._read, []

    def other_first(*args):
        if not busy:
            busy.append(True)
            assert compact_bronze(spark, table) == 3
        return plain(*args)

    monkeypatch.setattr(bronze, "_read", other_first)
    assert compact_bronze(spark, table) is None
    assert rows(read_bronze(spark, table)) == EVERYTHING and len(newest(spark, table).parts) == 1
    assert len(storage.children(spark, f"{table}/data")) == 5


def test_the_query_that_began_last_is_the_writer(spark, table, ratings):
    old = begin_writing(spark, table)
    append_batch(ratings(wave(4)), 4, table, old)
    new = begin_writing(spark, table)
    with pytest.raises(StaleWriter):
        append_batch(ratings(wave(5)), 5, table, old)
    append_batch(ratings(wave(5)), 5, table, new)
    compact_bronze(spark, table)
    append_batch(ratings(wave(6)), 6, table, new)
    assert bronze_versions(spark, table) == list(range(7)) and read_bronze(spark, table).count() == 21


def test_a_writer_that_is_overtaken_while_it_writes(spark, table, ratings, monkeypatch):
    old, plain = begin_writing(spark, table), bronze.commits.update

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(bronze.commits, "update", plain)
        begin_writing(spark, table)
        return plain(*args, **kwargs)

    folders = storage.children(spark, f"{table}/data")
    monkeypatch.setattr(bronze.commits, "update", overtaken)
    with pytest.raises(StaleWriter):
        append_batch(ratings(wave(4)), 4, table, old)
    assert storage.children(spark, f"{table}/data") == folders
    assert bronze_versions(spark, table) == [0, 1, 2, 3]


def test_a_commit_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "0.json")
    assert storage.create_once(spark, path, "first")
    assert not storage.create_once(spark, path, "second")
    assert storage.read_text(spark, path) == "first"
    assert storage.children(spark, str(tmp_path / "log")) == ["0.json"]


def test_a_change_is_worked_out_again_after_another_commit(spark, table, monkeypatch):
    plain, tried = commits.create_once, []

    def taken(*args):
        if not tried:
            tried.append(True)
            begin_writing(spark, table)
        return plain(*args)

    monkeypatch.setattr(commits, "create_once", taken)
    assert begin_writing(spark, table) == 2


def test_an_empty_batch_is_no_version(spark, table, ratings):
    append_batch(ratings([]), 4, table)
    append_batch(ratings(wave(5)), 5, table)
    assert bronze_versions(spark, table) == [0, 1, 2, 3, 5]
    compact_bronze(spark, table)
    assert newest(spark, table).parts[0].numbers == ((0, 3), (5, 5))
    with pytest.raises(ValueError):
        read_bronze(spark, table, 4)


def test_levels_keep_the_parts_few(spark, ratings, tmp_path):
    path = str(tmp_path / "many")
    for number in range(9):
        append_batch(ratings(wave(number)), number, path)
        if number % 2:
            compact_bronze(spark, path, fan=2)
    assert [(p.first, p.last, p.level) for p in newest(spark, path).parts] == [(0, 7, 3), (8, 8, 0)]
    assert read_bronze(spark, path, 5).count() == 18


def test_versions_of_a_year_open_at_once(spark, ratings, tmp_path):
    """A batch every 20 s for a year, compacted after every thousand."""
    path = str(tmp_path / "year")
    append_batch(ratings(wave(0)), 1_578_000, path)
    (part,) = newest(spark, path).parts
    whole = [(level, count) for level, count in ((4, 1), (3, 5), (2, 7), (1, 7))]
    old, at = [], 0
    for level, count in whole:
        for _ in range(count):
            size = 1000 * 10 ** (level - 1)
            old.append(Part(part.folder, at, at + size - 1, size, ((at, at + size - 1),), level=level))
            at += size
    fresh = [Part(part.folder, n, n, 1, ((n, n),)) for n in range(at, at + 900)]
    update(spark, path, lambda now: Commit(now.number, parts=(*old, *fresh, part)))
    start = time.perf_counter()
    assert latest_version(spark, path) == 1_578_000
    assert bronze.has_version(spark, path, 1_000_000) and not bronze.has_version(spark, path, 1_577_950)
    assert time.perf_counter() - start < 1


def test_runs_of_numbers():
    assert joined([(5, 6), (0, 1), (2, 2), (9, 9), (6, 7)]) == ((0, 2), (5, 7), (9, 9))
    assert joined([]) == ()


def test_silver_records_what_it_holds_with_its_rows(spark, table, tmp_path, monkeypatch):
    """A refresh that is overtaken by another one changes nothing."""
    silver = str(tmp_path / "silver")
    refresh_silver(spark, table, silver, 0)
    from ratemill.plans import silver as plans

    plain = plans.write_run

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(plans, "write_run", plain)
        refresh_silver(spark, table, silver, 3)
        return plain(*args, **kwargs)

    monkeypatch.setattr(plans, "write_run", overtaken)
    with pytest.raises(Conflict):
        refresh_silver(spark, table, silver, 1)
    assert silver_version(spark, silver) == 3 and rows(read_silver(spark, silver)) == EVERYTHING
