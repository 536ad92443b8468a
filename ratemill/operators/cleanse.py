"""Raw events to clean ratings: complete rows, one per event key."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ratemill.operators.parts import spread
from ratemill.schemas import EVENT_COLUMNS, EVENT_KEY


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows with a value in every column; NaN counts as no value.

    Same rows as ``na.drop("any")``, spelled as predicates that reach the scan.
    """
    names = columns or df.columns
    tests = [F.col(name).isNotNull() for name in names]
    fractional = (T.FloatType, T.DoubleType)
    tests += [
        ~F.isnan(name) for name in names if isinstance(df.schema[name].dataType, fractional)
    ]
    return df.where(reduce(lambda left, right: left & right, tests))


def clean_ratings(raw: DataFrame, latest_by: str | None = None, rows: int | None = None) -> DataFrame:
    """One row per (user, item, second), after incomplete rows are dropped.

    Copies of a key that differ in ``rating``: the highest wins, or with
    ``latest_by`` the one with the greatest value in that column (then the
    highest). Dropping NULLs first keeps a good copy beside a broken one.

    An aggregate rather than a window: copies merge before the shuffle, so a
    key with very many copies sends one row per map task. That holds all keys of a
    task in memory: with ``rows``, about how many ``raw`` has, they are dealt by key
    before it where they are many (``parts.spread``).
    """
    if latest_by is None:
        complete = drop_incomplete(raw.select(*EVENT_COLUMNS))
        kept = spread(complete, rows, *EVENT_KEY).groupBy(*EVENT_KEY).agg(F.max("rating").alias("rating"))
    else:
        complete = drop_incomplete(raw.select(*EVENT_COLUMNS, latest_by), EVENT_COLUMNS)
        newest = F.max(F.struct(latest_by, "rating"))
        kept = spread(complete, rows, *EVENT_KEY).groupBy(*EVENT_KEY).agg(newest.getField("rating").alias("rating"))
    return kept.select(*EVENT_COLUMNS)
