"""Collaborative filtering on clean ratings."""

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from ratemill.functions.hashing import hash_bound, unit_hash
from ratemill.schemas import EVENT_KEY
from ratemill.sources.storage import ensure_checkpoints, fresh_folder

# MLlib's own defaults, stated because results depend on them.
RANK = 10
ITERATIONS = 10
REGULARIZATION = 0.1

# Factor blocks, MLlib's defaults too. The factors depend on them, so that no size of a
# table changes them: a cluster states more for a larger table (README).
USER_BLOCKS = 10
ITEM_BLOCKS = 10

# Iterations between lineage cuts.
CHECKPOINT_EVERY = 4


def split_ratings(ratings: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, chosen by a hash of the event key.

    Repeatable: a partition that is recomputed, or a later run on more data,
    puts every row on the same side.
    """
    in_training = unit_hash(*EVENT_KEY) < hash_bound(share)
    return ratings.where(in_training), ratings.where(~in_training)


def fit_als(
    ratings: DataFrame,
    seed: int = 42,
    user_blocks: int = USER_BLOCKS,
    item_blocks: int = ITEM_BLOCKS,
    folder: str | None = None,
) -> ALSModel:
    """Fit explicit-feedback ALS. Repeated ratings of an item stay separate rows.

    The numbers of blocks are the parallelism of the two factor tables. They are part
    of what defines the result, like the seed, and follow neither table nor cluster.

    The model is written to ``folder``, replacing an earlier one there, or to a
    fresh place in the shared folder, and read back. Its factors then survive a
    lost executor without another fit, and come in as many parts as their size
    asks for: scoring all pairs runs one task per pair of parts.
    """
    session = ratings.sparkSession
    ensure_checkpoints(session)
    als = ALS(
        userCol="user_id",
        itemCol="movie_id",
        ratingCol="rating",
        coldStartStrategy="drop",
        rank=RANK,
        maxIter=ITERATIONS,
        regParam=REGULARIZATION,
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        checkpointInterval=CHECKPOINT_EVERY,
        seed=seed,
    )
    folder = folder or fresh_folder(session, "als")
    als.fit(ratings.select("user_id", "movie_id", "rating")).write().overwrite().save(folder)
    return ALSModel.load(folder)


def predict(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with a user or item unseen in training drop out."""
    return model.transform(ratings)


def rmse(predictions: DataFrame) -> DataFrame:
    """Root mean square error as one row; NULL when there is nothing to compare."""
    error = F.col("rating") - F.col("prediction").cast("double")
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def recommend(model: ALSModel, n: int = 5) -> DataFrame:
    """The ``n`` best items of every user, items already rated included."""
    return model.recommendForAllUsers(n)


def flatten(recommendations: DataFrame) -> DataFrame:
    """One row per user and rank, ranks from 1."""
    return recommendations.select(
        "user_id", F.posexplode("recommendations").alias("position", "item")
    ).select(
        "user_id",
        (F.col("position") + 1).alias("rank"),
        F.col("item.movie_id").alias("movie_id"),
        F.col("item.rating").alias("score"),
    )
