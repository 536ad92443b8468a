"""One refresh of everything downstream of the raw table."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratemill.operators import recommend, star
from ratemill.operators.toplists import top_lists
from ratemill.plans.silver import (
    has_totals,
    merge_silver,
    read_silver,
    read_totals,
    refresh_silver,
    silver_version,
)
from ratemill.plans.star import Star, read_star, write_dimensions
from ratemill.sources.documents import export_recommendations


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    gold: str
    recommendations: str


@dataclass(frozen=True)
class Report:
    version: int  # Bronze version all outputs belong to
    rmse: float | None  # None where no test pair could be scored
    edition: str | None  # recommendations written; None for an empty Silver
    user_blocks: int  # factor blocks, which the model depends on
    item_blocks: int


def write_gold(
    spark: SparkSession, paths: Paths, items: DataFrame, profiles: DataFrame, fmt: str = "parquet"
) -> Star:
    """Write the dimensions; facts are the Silver rows under the fact schema.

    No second copy of them is made, and dates come from the totals where Silver
    keeps them.
    """
    fact = star.fact_ratings(read_silver(spark, paths.silver, fmt))
    dated = read_totals(spark, paths.silver, fmt).by_date if has_totals(spark, paths.silver) else fact
    built = Star(star.dim_item(items), star.dim_user(profiles), star.dim_date(dated), fact)
    write_dimensions(built, paths.gold, fmt)
    return read_gold(spark, paths, fmt)


def read_gold(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> Star:
    version = silver_version(spark, paths.silver)  # before the facts, which may be newer
    fact = star.fact_ratings(read_silver(spark, paths.silver, fmt))
    return read_star(spark, paths.gold, fact, fmt, version)


def has_rows(ratings: DataFrame) -> bool:
    """Whether there is anything to train on."""
    return not ratings.isEmpty()


def train(
    ratings: DataFrame,
    path: str,
    n: int = 5,
    seed: int = 42,
    user_blocks: int = recommend.USER_BLOCKS,
    item_blocks: int = recommend.ITEM_BLOCKS,
    pruned: bool = False,
) -> tuple[float | None, str | None]:
    """Score a model on held-out rows, then refit on all and export top lists.

    Both models are kept beside the lists, until the next training. ``pruned`` finds the
    lists without scoring all pairs, for many items.
    """
    if not has_rows(ratings):
        return None, None
    blocks = {"user_blocks": user_blocks, "item_blocks": item_blocks}
    training, test = recommend.split_ratings(ratings)
    error = None
    if has_rows(training):
        trial = recommend.fit_als(training, seed, **blocks, folder=f"{path}/trial-model")
        error = recommend.rmse(recommend.predict(trial, test)).first()["rmse"]
    model = recommend.fit_als(ratings, seed, **blocks, folder=f"{path}/model")
    lists = top_lists(model, n).lists if pruned else recommend.recommend(model, n)
    return error, export_recommendations(lists, path)


def run_cycle(
    spark: SparkSession,
    paths: Paths,
    items: DataFrame,
    profiles: DataFrame,
    since: int | None = None,
    load: Callable[[Star], object] | None = None,
    seed: int = 42,
    user_blocks: int = recommend.USER_BLOCKS,
    item_blocks: int = recommend.ITEM_BLOCKS,
    pruned: bool = False,
    fmt: str = "parquet",
) -> Report:
    """Silver, then the star schema, then the model; the first failure ends it.

    The newest Bronze version is fixed at the start, so batches that arrive
    meanwhile wait for the next cycle. Silver records the version it holds and is
    refreshed from there, also after a restart; ``since``, if given, must agree with
    it. ``load`` receives the star, to fill a warehouse say. ``fmt`` is the format of
    all tables but the lists; of one that keeps versions itself (``delta``) the changes
    since the last cycle are read. Later steps read the written tables.
    """
    version = refresh_silver(spark, paths.bronze, paths.silver, since=since, fmt=fmt)
    merge_silver(spark, paths.silver, fmt)
    ratings = read_silver(spark, paths.silver, fmt)
    gold = write_gold(spark, paths, items, profiles, fmt)
    if load is not None:
        load(gold)
    error, edition = train(
        ratings, paths.recommendations, seed=seed, user_blocks=user_blocks, item_blocks=item_blocks, pruned=pruned
    )
    return Report(version, error, edition, user_blocks, item_blocks)
