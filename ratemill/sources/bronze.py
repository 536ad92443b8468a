"""The raw event table, as of any version.

A version is a micro-batch. Batches and compactions are commits (``commits``): a batch
adds a part, a compaction puts one part, whose files are ordered by batch, in the place
of several, by sizes that grow tenfold, so that the parts of years of batches are few.
A snapshot reads the parts of one commit, and every read is one filter on the batch
number, after parts beyond it are left out. With a format that keeps versions itself
(``delta``) versions are its own.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from ratemill.schemas import EVENT, EVENT_COLUMNS
from ratemill.sources import commits
from ratemill.sources.commits import Commit, Conflict, Part, joined, new_folder, newest
from ratemill.sources.storage import remove

BATCH = "_batch_id"
#: Parts of a level that are merged into one of the next.
FAN = 10

_STORED = StructType([*EVENT.fields]).add(BATCH, LongType())


class StaleWriter(RuntimeError):
    """A query that writes although a later one has taken over."""


# --- versions ---------------------------------------------------------------


def _holds(commit: Commit, version: int) -> bool:
    return any(
        first <= version <= last
        for part in commit.parts
        if part.first <= version <= part.last
        for first, last in part.numbers
    )


def has_version(spark: SparkSession, path: str, version: int) -> bool:
    return _holds(newest(spark, path), version)


def latest_version(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """The newest version, or None for a table without events."""
    if fmt != "parquet":
        version = table_history(spark, path, fmt).agg(F.max("version")).first()[0]
        return None if version is None else int(version)
    return max((part.last for part in newest(spark, path).parts), default=None)


def bronze_versions(spark: SparkSession, path: str) -> list[int]:
    """All versions of a parquet table, ascending; for tests and small tables."""
    runs = [run for part in newest(spark, path).parts for run in part.numbers]
    return [n for first, last in joined(runs) for n in range(first, last + 1)]


def table_history(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Versions of a table whose format keeps them itself."""
    return spark.sql(f"DESCRIBE HISTORY {fmt}.`{path}`").select("version")


# --- reading ----------------------------------------------------------------


def _read(spark: SparkSession, path: str, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(*[f"{path}/{part.folder}" for part in parts])


def read_bronze(
    spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Raw events, all or as of ``version``."""
    if fmt != "parquet":
        reader = spark.read.format(fmt)
        if version is not None:
            reader = reader.option("versionAsOf", version)
        return reader.load(path).select(*EVENT_COLUMNS)
    now = newest(spark, path)
    if version is None:
        return _read(spark, path, list(now.parts)).select(*EVENT_COLUMNS)
    if not _holds(now, version):
        raise ValueError(f"no version {version} in {path}")
    until = _read(spark, path, [part for part in now.parts if part.first <= version])
    return until.where(F.col(BATCH) <= version).select(*EVENT_COLUMNS)


def read_batches(
    spark: SparkSession, path: str, since: int, version: int, fmt: str = "parquet"
) -> DataFrame:
    """Raw events of the micro-batches after ``since`` up to ``version``.

    A format that keeps versions is asked for the rows inserted between the two, by its
    reader of changes (Delta: the table has ``delta.enableChangeDataFeed``).
    """
    if fmt != "parquet":
        reader = spark.read.format(fmt).option("readChangeFeed", "true")
        changes = reader.option("startingVersion", since + 1).option("endingVersion", version).load(path)
        if "_change_type" in changes.columns:
            changes = changes.where(F.col("_change_type") == "insert")
        return changes.select(*EVENT_COLUMNS)
    parts = [part for part in newest(spark, path).parts if part.last > since and part.first <= version]
    batch = F.col(BATCH)
    return _read(spark, path, parts).where((batch > since) & (batch <= version)).select(*EVENT_COLUMNS)


# --- writing ----------------------------------------------------------------


def begin_writing(spark: SparkSession, path: str) -> int:
    """Take over as the one query that adds batches; returns its number."""
    return commits.update(spark, path, lambda now: replace(now, writer=now.writer + 1)).writer


def append_batch(events: DataFrame, batch: int, path: str, writer: int | None = None) -> None:
    """Add one micro-batch; without events, or if it is there already, nothing.

    A batch that is replayed after a failure has the same number and the same events, so
    every event is stored once. With ``writer``, only while no later query has begun.
    """
    spark = events.sparkSession

    def open_to(now: Commit) -> bool:
        if writer is not None and now.writer != writer:
            raise StaleWriter(f"query {now.writer} has begun to write {path} after query {writer}")
        return not _holds(now, batch)

    now = newest(spark, path)
    if not open_to(now):
        return
    folder, seen = new_folder(now), Observation()
    numbered = events.select(*EVENT_COLUMNS, F.lit(batch).cast("bigint").alias(BATCH))
    numbered.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}")
    rows = seen.get["rows"]
    part = Part(folder, batch, batch, rows, ((batch, batch),))
    added = False
    try:
        if rows:
            then = commits.update(spark, path, lambda now: now.replaced([], part) if open_to(now) else None)
            added = part in then.parts
    finally:
        if not added:
            remove(spark, f"{path}/{folder}")


def compact_bronze(
    spark: SparkSession, path: str, before: int | None = None, fan: int = FAN
) -> int | None:
    """Merge parts of single batches (those numbered below ``before``) into one.

    If that makes ``fan`` parts of a level, they are merged in the same go. Returns the
    last batch that was merged, or None where there was nothing to do, or where another
    compaction was first. It may run beside readers, ingestion and itself: what it
    replaces stays for as many commits as ``commits.KEEP`` says.
    """
    commits.sweep(spark, path)
    now = newest(spark, path)
    merged = [p for p in now.parts if p.level == 0 and (before is None or p.last < before)]
    if not merged:
        return None
    level = 1
    while len(same := [p for p in now.parts if p.level == level]) + 1 >= fan:
        merged += same
        level += 1
    folder = new_folder(now)
    # A range of batches per task, so that files can be skipped by their numbers.
    rows = _read(spark, path, merged).repartitionByRange(BATCH).sortWithinPartitions(BATCH)
    rows.write.parquet(f"{path}/{folder}")
    numbers = joined([run for part in merged for run in part.numbers])
    first, last = numbers[0][0], numbers[-1][1]
    part = Part(folder, first, last, sum(p.rows for p in merged), numbers, level=level)
    try:
        commits.update(spark, path, lambda now: now.replaced(merged, part))
    except Conflict:
        remove(spark, f"{path}/{folder}")
        return None
    return last
