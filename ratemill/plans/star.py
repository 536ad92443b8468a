"""The star schema as one set of tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratemill.operators import star
from ratemill.sources.statistics import read_counted, write_counted
from ratemill.sources.tables import (
    EDITION,
    drop_old_editions,
    newest_edition,
    next_edition,
    overwrite_table,
    read_table,
)

FACT_TABLE = "fact_ratings"

# Written last: an edition of the star counts from then on.
COMPLETE = "complete/_SUCCESS"


@dataclass(frozen=True)
class Star:
    dim_item: DataFrame
    dim_user: DataFrame
    dim_date: DataFrame
    fact_ratings: DataFrame
    version: int | None = None  # of Silver, which the facts hold at least

    def tables(self) -> dict[str, DataFrame]:
        """Tables by warehouse name, dimensions first."""
        return {
            "dim_movie": self.dim_item,
            "dim_user": self.dim_user,
            "dim_date": self.dim_date,
            FACT_TABLE: self.fact_ratings,
        }

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: t for name, t in self.tables().items() if name != FACT_TABLE}

    def check(self) -> DataFrame:
        return star.check_star(
            self.fact_ratings,
            {
                "dim_movie": (self.dim_item, "movie_id"),
                "dim_user": (self.dim_user, "user_id"),
                "dim_date": (self.dim_date, "date_id"),
            },
        )


def build_star(ratings: DataFrame, items: DataFrame, profiles: DataFrame) -> Star:
    fact = star.fact_ratings(ratings)
    return Star(star.dim_item(items), star.dim_user(profiles), star.dim_date(fact), fact)


def write_star(built: Star, path: str, fmt: str = "parquet") -> None:
    """A new edition of all four tables; dates come from the written facts."""
    _write(built, path, fmt, with_facts=True)


def write_dimensions(built: Star, path: str, fmt: str = "parquet") -> None:
    """A new edition of the dimensions, where facts are kept elsewhere."""
    _write(built, path, fmt, with_facts=False)


def _write(built: Star, path: str, fmt: str, with_facts: bool) -> None:
    spark = built.fact_ratings.sparkSession
    target = f"{path}/{EDITION}{next_edition(spark, path)}"
    tables = built.dimensions()
    if with_facts:
        write_counted(built.fact_ratings, f"{target}/{FACT_TABLE}", fmt)
        tables["dim_date"] = star.dim_date(read_table(spark, f"{target}/{FACT_TABLE}", fmt))
    for name, table in tables.items():
        write_counted(table, f"{target}/{name}", fmt)
    overwrite_table(spark.range(1), f"{target}/complete")
    drop_old_editions(spark, path, COMPLETE)


def read_star(
    spark: SparkSession,
    path: str,
    fact: DataFrame | None = None,
    fmt: str = "parquet",
    version: int | None = None,
) -> Star:
    """The newest complete edition below ``path``; ``fact`` where facts are elsewhere,
    which then hold ``version``."""
    edition = newest_edition(spark, path, COMPLETE)
    return Star(
        read_counted(spark, f"{edition}/dim_movie", fmt),
        read_counted(spark, f"{edition}/dim_user", fmt),
        read_counted(spark, f"{edition}/dim_date", fmt),
        read_counted(spark, f"{edition}/{FACT_TABLE}", fmt) if fact is None else fact,
        version,
    )
