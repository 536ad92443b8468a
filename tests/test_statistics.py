"""Counts that are kept with a table, against counting it."""

import pytest
from pyspark.sql import functions as F

from ratemill.operators import joins
from ratemill.operators.joins import fits_broadcast
from ratemill.sources.statistics import read_counted, stored_size, write_counted


@pytest.fixture
def table(spark, tmp_path):
    rows = [(1, "ä", None), (2, "bcd", "x"), (3, None, "yy")]
    path = str(tmp_path / "table")
    write_counted(spark.createDataFrame(rows, "id int, name string, note string"), path)
    return read_counted(spark, path)


def test_counts_go_with_columns(table):
    assert stored_size(table) == (3, 5 + 3)
    assert stored_size(table.select("id", "name")) == (3, 5)
    assert stored_size(table.where("id > 1").select("note")) == (3, 3)
    assert sorted(tuple(r) for r in table.select("id", "note").collect()) == [(1, None), (2, "x"), (3, "yy")]


def test_what_may_be_larger_is_not_known(table):
    assert stored_size(table.join(table.select("id"), "id")) is None
    assert stored_size(table.union(table)) is None
    assert stored_size(table.withColumn("long", F.repeat("name", F.lit(9)))) is None
    assert stored_size(table.select("id", F.explode(F.array("name", "note")))) is None


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    write_counted(spark.createDataFrame([], "id int, name string"), path)
    assert stored_size(read_counted(spark, path)) == (0, 0)


def test_table_without_counts_and_other_formats(spark, tmp_path):
    plain, orc = str(tmp_path / "plain"), str(tmp_path / "orc")
    spark.range(4).write.parquet(plain)
    assert stored_size(read_counted(spark, plain)) is None
    write_counted(spark.range(4), orc, "orc")
    assert stored_size(read_counted(spark, orc, "orc")) == (4, 0)
    assert read_counted(spark, orc, "orc").count() == 4


def test_size_check_runs_no_job(spark, table, monkeypatch):
    def job(*args):
        raise AssertionError("a job")

    monkeypatch.setattr(type(table), "count", job)
    assert fits_broadcast(table)
    monkeypatch.setattr(joins, "ROW_BYTES", 10**9)
    assert not fits_broadcast(table)
    with pytest.raises(AssertionError):
        fits_broadcast(table.union(table))
