"""Ingestion and everything downstream of it as one streaming query."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ratemill.plans.cycle import Paths, run_cycle
from ratemill.sources.bronze import append_batch, begin_writing
from ratemill.streaming.bronze import (
    COMPACT_EVERY,
    append_versioned,
    check_format,
    compact_now_and_then,
    refuse_lost_checkpoint,
)


def write_and_refresh(
    events: DataFrame,
    paths: Paths,
    items: DataFrame,
    profiles: DataFrame,
    checkpoint: str,
    trigger: Mapping[str, object],
    compact_every: int = COMPACT_EVERY,
    fmt: str = "parquet",
    **cycle_options,
) -> StreamingQuery:
    """Append every micro-batch of parsed events, then run a cycle over it.

    Silver knows the version it holds, so that a restart refreshes it too. A
    failing cycle fails the query; after a restart the batch is replayed, which
    adds nothing twice. Without new events nothing is run. ``fmt`` is the format
    of all tables, as in ``run_cycle``.
    """
    check_format(fmt)
    session = events.sparkSession
    number = None
    if fmt == "parquet":
        refuse_lost_checkpoint(events, paths.bronze, checkpoint)
        number = begin_writing(session, paths.bronze)

    def step(batch: DataFrame, n: int) -> None:
        if fmt == "parquet":
            append_batch(batch, n, paths.bronze, number)
        else:
            append_versioned(batch, n, paths.bronze, checkpoint, fmt)
        run_cycle(session, paths, items, profiles, fmt=fmt, **cycle_options)
        if fmt == "parquet":
            compact_now_and_then(session, n, paths.bronze, compact_every)

    return (
        events.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(step)
        .start()
    )
