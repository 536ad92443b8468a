"""Tasks in proportion to the rows, for steps whose tasks hold a row for each key."""

from pyspark.sql import DataFrame

ROWS_PER_PART = 500_000


def spread(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` into parts, one for each ``ROWS_PER_PART`` of ``rows``.

    Spark sizes a task by bytes as they are shuffled, compressed: 64 MB of ratings, nearly
    three million, take ten times that once they are sorted and hashed. Rows that are dealt
    by the keys of an aggregate need no other shuffle for it, but copies then meet after
    the shuffle only: for keys with few copies. Where ``rows`` is not known, or Spark gives
    every core a task without exceeding that size, nothing changes.
    """
    parts = -(-(rows or 0) // ROWS_PER_PART)
    if parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)
