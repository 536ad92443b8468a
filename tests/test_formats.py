"""Formats whose packages are absent here: format and options arrive unchanged."""

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter

from ratemill.operators.decode import encode_events, parse_events
from ratemill.operators import marts
from ratemill.operators.validate import accepted, validate_submissions
from ratemill.plans import cycle
from ratemill.sources.bronze import read_bronze
from ratemill.sources.events import (
    publish_event_stream,
    publish_events,
    read_event_stream,
    read_events,
)
from ratemill.streaming.bronze import write_bronze
from ratemill.streaming.refresh import write_and_refresh


def stand_in(monkeypatch, cls, absent, present):
    """Make ``cls`` use format ``present`` for ``absent`` and note what it is given."""
    seen = {}
    use, option, options = cls.format, cls.option, cls.options

    def note_format(self, name):
        seen["format"] = name
        return use(self, present if name == absent else name)

    def note_option(self, key, value):
        seen[key] = value
        return option(self, key, value)

    def note_options(self, **given):
        seen.update(given)
        return options(self, **given)

    monkeypatch.setattr(cls, "format", note_format)
    monkeypatch.setattr(cls, "option", note_option)
    monkeypatch.setattr(cls, "options", note_options, raising=False)
    return seen


KAFKA = {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest"}


def test_kafka_stream(spark, monkeypatch):
    seen = stand_in(monkeypatch, DataStreamReader, "kafka", "rate")
    stream = read_event_stream(spark, "kafka", KAFKA)
    assert seen == {"format": "kafka", **KAFKA}
    assert stream.isStreaming and stream.columns == ["value"]
    assert parse_events(stream).isStreaming


def test_delta_version(spark, ratings, monkeypatch, tmp_path):
    path = str(tmp_path / "bronze")
    ratings([(1, 2, 3.0, 4)]).write.parquet(path)
    seen = stand_in(monkeypatch, DataFrameReader, "delta", "parquet")
    assert read_bronze(spark, path, version=0, fmt="delta").count() == 1
    assert seen == {"format": "delta", "versionAsOf": 0}


def test_delta_sink(spark, ratings, monkeypatch, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "bronze")
    publish_events(encode_events(ratings([(1, 2, 3.0, 4)])), "text", {"path": source})
    events = parse_events(read_event_stream(spark, "text", {"path": source}))
    seen = stand_in(monkeypatch, DataStreamWriter, "delta", "parquet")
    write_bronze(
        events, table, str(tmp_path / "checkpoint"), {"availableNow": True}, fmt="delta"
    ).awaitTermination()
    assert seen["format"] == "delta"
    assert [tuple(row) for row in spark.read.parquet(table).collect()] == [(1, 2, 3.0, 4)]


def test_accepted_submissions_are_published_as_a_stream(spark, tmp_path):
    forms, topic = str(tmp_path / "forms"), str(tmp_path / "topic")
    schema = "user_id string, movie_id string, rating string"
    spark.createDataFrame([("1", "2", "4"), ("x", "2", "4")], schema).write.json(forms)
    submissions = spark.readStream.schema(schema).json(forms)
    publish_event_stream(
        encode_events(accepted(validate_submissions(submissions))),
        "text",
        {"path": topic, "checkpointLocation": str(tmp_path / "checkpoint")},
        {"availableNow": True},
    ).awaitTermination()
    (event,) = parse_events(read_events(spark, "text", {"path": topic})).collect()
    assert tuple(event)[:3] == (1, 2, 4.0)


def test_one_format_through_a_whole_cycle(spark, ratings, monkeypatch, tmp_path):
    """Every table but the lists goes through the stated format, and versions through its
    history; an installed format stands in for the one with versions of its own."""
    bronze = str(tmp_path / "bronze")
    ratings([(1, 1, 3.0, 10), (2, 1, 4.0, 86410), (1, 2, 5.0, 20)]).write.format("orc").save(bronze)
    monkeypatch.setattr(
        "ratemill.sources.bronze.table_history",
        lambda session, path, fmt: session.createDataFrame([(0,), (7,)], "version long"),
    )
    items = spark.createDataFrame([(1, "a", "g", 2000), (2, "b", "g", 2001)], "movie_id int, title string, genre string, release_year int")
    profiles = spark.createDataFrame(
        [(1, "u", 30, "F", "here", "Basic"), (2, "v", 31, "M", "there", "Basic")],
        "user_id int, username string, age int, gender string, location string, subscription_tier string",
    )
    paths = cycle.Paths(bronze, *[str(tmp_path / name) for name in ("silver", "gold", "lists")])
    for _ in range(2):
        report = cycle.run_cycle(spark, paths, items, profiles, fmt="orc")
        assert report.version == 7
    star = cycle.read_gold(spark, paths, "orc")
    assert star.fact_ratings.count() == 3 and star.dim_date.count() == 2
    assert marts.top_items(star.fact_ratings, star.dim_item).count() == 2
    written = {p.suffix for name in ("silver/data", "gold") for p in (tmp_path / name).rglob("part-*")}
    assert written == {".orc", ".parquet"}  # parquet: the marker of an edition
    assert not list((tmp_path / "silver" / "data").rglob("*.parquet"))


def test_one_format_through_the_stream(spark, ratings, monkeypatch, tmp_path):
    """Micro-batches are appended in the stated format, with their number; a format that
    is neither parquet nor one with versions is an error before anything starts."""
    topic, bronze, checkpoint = (str(tmp_path / name) for name in ("topic", "bronze", "checkpoint"))
    publish_events(encode_events(ratings([(1, 1, 3.0, 10), (2, 1, 4.0, 86410)])), "text", {"path": topic})
    stream = parse_events(read_event_stream(spark, "text", {"path": topic}))
    paths = cycle.Paths(bronze, *[str(tmp_path / name) for name in ("silver", "gold", "lists")])
    items = spark.createDataFrame([(1, "a", "g", 2000)], "movie_id int, title string, genre string, release_year int")
    profiles = spark.createDataFrame(
        [(1, "u", 30, "F", "here", "Basic")],
        "user_id int, username string, age int, gender string, location string, subscription_tier string",
    )

    def start():
        return write_and_refresh(stream, paths, items, profiles, checkpoint, {"availableNow": True}, fmt="orc")

    with pytest.raises(ValueError):
        start()
    with pytest.raises(ValueError):
        write_bronze(stream, bronze, checkpoint, fmt="orc")
    monkeypatch.setattr("ratemill.streaming.bronze.VERSIONED", {"orc"})
    monkeypatch.setattr(
        "ratemill.sources.bronze.table_history",
        lambda session, path, fmt: session.createDataFrame([(0,)], "version long"),
    )
    seen = stand_in(monkeypatch, DataFrameWriter, "none", "none")
    start().awaitTermination()
    assert seen["txnAppId"] == checkpoint and seen["txnVersion"] == 0
    assert spark.read.format("orc").load(bronze).count() == 2
    assert cycle.read_gold(spark, paths, "orc").fact_ratings.count() == 2
