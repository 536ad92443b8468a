"""Lake tables that a reader always sees whole.

A table is replaced by writing a new edition beside the old one. An edition counts
once it is complete, readers take the newest complete one, and the last two stay, so
that a reader of the older can finish. Tables that grow instead are in ``runs``.
"""

from pyspark.sql import DataFrame, SparkSession

from ratemill.sources.storage import exists, numbered_children, remove

EDITION = "edition="
KEPT = 2


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table in place: for inputs and formats with transactions of their own."""
    df.write.format(fmt).mode("overwrite").save(path)


# --- editions ---------------------------------------------------------------


def complete_editions(spark: SparkSession, path: str, marker: str = "_SUCCESS") -> list[int]:
    """Editions below ``path`` that were written to the end, ascending."""
    return [
        n
        for n in numbered_children(spark, path, EDITION)
        if exists(spark, f"{path}/{EDITION}{n}/{marker}")
    ]


def next_edition(spark: SparkSession, path: str) -> int:
    return max(numbered_children(spark, path, EDITION), default=-1) + 1


def drop_old_editions(spark: SparkSession, path: str, marker: str = "_SUCCESS", keep: int = KEPT) -> None:
    """Remove all editions but the newest ``keep`` complete ones."""
    kept = complete_editions(spark, path, marker)[-keep:]
    for old in set(numbered_children(spark, path, EDITION)) - set(kept):
        remove(spark, f"{path}/{EDITION}{old}")


def newest_edition(spark: SparkSession, path: str, marker: str = "_SUCCESS") -> str:
    """Path of the newest complete edition; an error if there is none."""
    complete = complete_editions(spark, path, marker)
    if not complete:
        raise FileNotFoundError(f"{path} holds no complete edition")
    return f"{path}/{EDITION}{complete[-1]}"
