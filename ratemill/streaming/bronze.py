"""Streaming ingestion into the raw event table."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratemill.sources.bronze import append_batch, begin_writing, compact_bronze, latest_version
from ratemill.sources.storage import children

# Batches that are parts of their own; at one in 20 s, these are some five hours.
COMPACT_EVERY = 1000

#: Formats with a transaction log and versions of their own.
VERSIONED = {"delta"}


def check_format(fmt: str) -> None:
    """Bronze is kept by this library in parquet, or by a format with versions."""
    if fmt != "parquet" and fmt not in VERSIONED:
        raise ValueError(f"Bronze is parquet or one of {sorted(VERSIONED)}, not {fmt}")


def refuse_lost_checkpoint(df: DataFrame, path: str, checkpoint: str) -> None:
    # A new checkpoint counts batches from 0 again, and they would pass for replayed ones.
    if latest_version(df.sparkSession, path) is not None and not children(df.sparkSession, checkpoint):
        raise ValueError(f"{path} holds batches but checkpoint {checkpoint} is empty")


def compact_now_and_then(spark: SparkSession, batch: int, path: str, every: int) -> None:
    """After every ``every`` batches, compact all before this one."""
    if batch and batch % every == 0:
        compact_bronze(spark, path, before=batch)


def append_versioned(events: DataFrame, batch: int, path: str, checkpoint: str, fmt: str) -> None:
    """Append one micro-batch to a table that keeps versions itself; the stream and the
    number of the batch go along, by which the format passes over a replayed one."""
    writer = events.write.format(fmt).mode("append")
    writer.option("txnAppId", checkpoint).option("txnVersion", batch).save(path)


def write_bronze(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    fmt: str = "parquet",
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start appending a stream of parsed events to the table at ``path``.

    ``trigger`` is passed to ``writeStream.trigger``; by default the next
    micro-batch starts when the last one ends. Table and checkpoint belong
    together, and the query that starts last is the one that writes: an older
    one fails at its next batch. Batches are compacted after every
    ``compact_every``. With ``delta`` the sink keeps its own transaction log.
    """
    check_format(fmt)
    writer = events.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if fmt != "parquet":
        return writer.format(fmt).start(path)
    refuse_lost_checkpoint(events, path, checkpoint)
    number = begin_writing(events.sparkSession, path)

    def step(df: DataFrame, batch: int) -> None:
        append_batch(df, batch, path, number)
        compact_now_and_then(df.sparkSession, batch, path, compact_every)

    return writer.foreachBatch(step).start()
