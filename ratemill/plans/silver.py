"""The clean table and the totals that reports need: runs that are merged on read.

A refresh cleans the batches that the table lacks and adds them as a run, whatever dates
they have; of several ratings of a key the highest counts, in any order of runs, so the
result is that of a rebuild. With totals it looks up what the table holds of the new
keys, and adds a run of sums and counts: of new keys, and of ratings that rose, the
difference. All runs of a refresh, and the Bronze version they belong to, are one commit.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from ratemill.functions.calendar import date_id
from ratemill.operators.cleanse import clean_ratings
from ratemill.operators.joins import fits_broadcast
from ratemill.operators.star import fact_ratings
from ratemill.schemas import EVENT, EVENT_COLUMNS, EVENT_KEY
from ratemill.sources import commits
from ratemill.sources.bronze import latest_version, read_batches, read_bronze
from ratemill.sources.commits import Commit, Conflict, newest
from ratemill.sources.runs import KEEP, Kind, merge_runs, read_kind, read_runs, write_run
from ratemill.sources.storage import fresh_folder, remove
from ratemill.sources.tables import overwrite_table, read_table

ROWS = Kind("rows", EVENT, ("timestamp", "user_id", "movie_id"), F.max)


def _totals(name: str, *key: str) -> Kind:
    schema = StructType()
    for column in key:
        schema = schema.add(column, IntegerType())
    schema = schema.add("rating_sum", DoubleType()).add("rating_count", LongType())
    return Kind(name, schema, key, F.sum)


BY_ITEM = _totals("by_item", "movie_id")
BY_DATE = _totals("by_date", "date_id")
BY_PAIR = _totals("by_pair", "user_id", "movie_id")
TOTALS = [BY_ITEM, BY_DATE, BY_PAIR]

#: What a rating was before it rose; null for a new key. Kept with a run's rows.
_WAS = "was"


@dataclass(frozen=True)
class Totals:
    """Sum and number of clean ratings per item, per date, and per user and item."""

    by_item: DataFrame
    by_date: DataFrame
    by_pair: DataFrame


def _built(spark: SparkSession, path: str) -> Commit:
    now = newest(spark, path)
    if now.version is None:
        raise FileNotFoundError(f"{path} was never built")
    return now


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_kind(spark, path, _built(spark, path), ROWS, fmt).select(*EVENT_COLUMNS)


def read_changes(
    spark: SparkSession, path: str, since: int, group: tuple[str, ...] = ("user_id", "movie_id", "date_id"), fmt: str = "parquet"
) -> DataFrame:
    """All facts, as they are now, of each ``group`` that changed after Bronze version
    ``since``, for a copy of the facts elsewhere that holds that version.

    Groups are those with a row in a run that goes beyond ``since``; merged runs may
    bring in more of them, which does no harm. Other runs are searched for their rows,
    without a shuffle while the groups may be broadcast.
    """
    now = _built(spark, path)
    if since > now.version:
        raise ValueError(f"{path} holds version {now.version}, not {since} or later")
    runs = now.of(ROWS.name)
    newer = [run for run in runs if run.last > since]
    if len(newer) == len(runs):
        return fact_ratings(read_silver(spark, path, fmt))

    def dated(some: list) -> DataFrame:
        return read_runs(spark, path, some, ROWS, fmt).withColumn("date_id", date_id(F.col("timestamp")))

    groups = dated(newer).select(*group).distinct()
    if newer and fits_broadcast(groups):
        groups = F.broadcast(groups)
    found = dated(runs).join(groups, list(group), "left_semi")
    return fact_ratings(ROWS.merged(found.select(*EVENT_COLUMNS)))


def has_totals(spark: SparkSession, path: str) -> bool:
    return bool(newest(spark, path).of(BY_ITEM.name))


def read_totals(spark: SparkSession, path: str, fmt: str = "parquet") -> Totals:
    now = _built(spark, path)
    if not now.of(BY_ITEM.name):
        raise ValueError(f"{path} was built without totals")
    return Totals(*[read_kind(spark, path, now, kind, fmt) for kind in TOTALS])


def silver_version(spark: SparkSession, path: str) -> int | None:
    """The Bronze version that the table holds; None before the first build."""
    return newest(spark, path).version


def _add(
    spark: SparkSession, path: str, now: Commit, rows: DataFrame, version: int, totals: bool, rebuilt: bool, fmt: str
) -> None:
    """Commit a run of ``rows``, which have ``was`` if there are totals to keep."""
    span = (0 if rebuilt or now.version is None else now.version + 1, version)
    run = write_run(rows, path, now, ROWS, span, fmt)
    added = [run]
    if totals:
        stored = StructType([*rows.schema.fields])
        changes = spark.read.format(fmt).schema(stored).load(f"{path}/{run.folder}")
        risen = F.col("rating") - F.coalesce(_WAS, F.lit(0.0))
        dated = changes.withColumn("date_id", date_id(F.col("timestamp")))
        for kind in TOTALS:
            sums = dated.groupBy(*kind.key).agg(
                F.sum(risen).alias("rating_sum"), F.count_if(F.col(_WAS).isNull()).alias("rating_count")
            )
            added.append(write_run(sums, path, now, kind, span, fmt))

    def change(then: Commit) -> Commit:
        if then.version != now.version:
            raise Conflict(f"{path} was refreshed to version {then.version} meanwhile")
        return replace(then.replaced(list(then.parts) if rebuilt else [], *added), version=version)

    try:
        commits.update(spark, path, change, KEEP)
    except Conflict:
        for part in added:
            remove(spark, f"{path}/{part.folder}")
        raise


def _unchanged() -> Column:
    return F.lit(None).cast("double").alias(_WAS)


def rebuild_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    version: int | None = None,
    fmt: str = "parquet",
    totals: bool = True,
) -> int:
    """Clean all raw events (as of ``version``) and replace the table."""
    if version is None:
        version = latest_version(spark, bronze, fmt)
    if version is None:
        raise ValueError(f"{bronze} holds no events yet")
    rows = clean_ratings(read_bronze(spark, bronze, version, fmt))
    if totals:
        rows = rows.select("*", _unchanged())
    _add(spark, silver, newest(spark, silver), rows, version, totals, True, fmt)
    return version


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    version: int | None = None,
    since: int | None = None,
    fmt: str = "parquet",
    totals: bool = True,
) -> int:
    """Bring the table to Bronze ``version``, by default the newest; returns it.

    The version it holds is recorded with the table, so no batch can be left out: a
    ``since`` that differs is an error. Only newer batches are cleaned and written; of
    a format with versions of its own, the changes between the two. A table that was
    never written or has to go back to an older ``version`` is rebuilt, with totals if
    ``totals`` says so; later refreshes keep the totals if it has them. Without, nothing
    of the table is read; with them, its rows are searched for the new keys, without a
    shuffle of them while the new keys are few enough to be broadcast.
    """
    now = newest(spark, silver)
    held = now.version
    if since is not None and since != held:
        raise ValueError(f"{silver} holds version {held}, not {since}")
    if version is None:
        version = latest_version(spark, bronze, fmt)
    if version is None:
        raise ValueError(f"{bronze} holds no events yet")
    if held == version:
        return version
    if held is None or version < held:
        kept = totals if held is None else bool(now.of(BY_ITEM.name))
        return rebuild_silver(spark, bronze, silver, version, fmt, kept)
    fresh = clean_ratings(read_batches(spark, bronze, held, version, fmt))
    if not now.of(BY_ITEM.name):
        _add(spark, silver, now, fresh, version, False, False, fmt)
        return version
    # Read and cleaned once: its keys are searched for, its rows are added.
    scratch = fresh_folder(spark, "fresh")
    overwrite_table(fresh, scratch)
    fresh = read_table(spark, scratch)
    keys = fresh.select(*EVENT_KEY)
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    known = read_runs(spark, silver, now.of(ROWS.name), ROWS, fmt).join(keys, EVENT_KEY, "left_semi")
    before = ROWS.merged(known).withColumnRenamed("rating", _WAS)
    changed = fresh.join(before, EVENT_KEY, "left").where(F.col(_WAS).isNull() | (F.col("rating") > F.col(_WAS)))
    _add(spark, silver, now, changed.select(*EVENT_COLUMNS, _WAS), version, True, False, fmt)
    remove(spark, scratch)
    return version


def merge_silver(spark: SparkSession, silver: str, fmt: str = "parquet", **sizes: int) -> int:
    """Merge runs of like size, of rows and of totals; returns how many runs went."""
    return merge_runs(spark, silver, [ROWS, *TOTALS], fmt, **sizes)
