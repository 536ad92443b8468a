"""Event messages: a ``value`` column, from and to a topic or files."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_event_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """Streaming messages; every option goes to the source unchanged.

    With ``kafka`` the caller states ``startingOffsets``: from ``latest``,
    events published before the first start are never read.
    """
    return spark.readStream.format(fmt).options(**options).load().select("value")


def read_events(
    spark: SparkSession, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """The same messages as one bounded read."""
    return spark.read.format(fmt).options(**options).load().select("value")


def publish_events(messages: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Append encoded messages to a topic or a folder of text files."""
    messages.select("value").write.format(fmt).options(**options).mode("append").save()


def publish_event_stream(
    messages: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """The same for a stream; ``options`` name the checkpoint location."""
    writer = messages.select("value").writeStream.format(fmt).options(**options)
    return (writer.trigger(**trigger) if trigger else writer).outputMode("append").start()
