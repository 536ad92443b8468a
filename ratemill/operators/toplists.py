"""The best items of every user without scoring all pairs, and exactly.

A score is the inner product of two factors, so none exceeds the product of their
lengths. Items are taken in blocks of falling length. A user is done as soon as the
lengths of what is left cannot reach the user's n-th best score; the others go on to the
next block. Blocks are of a stated size and double, so that rounds stay few; a block is
all that tasks are sent, and users are never shuffled.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratemill.schemas import RECOMMENDATIONS
from ratemill.sources.storage import exists, fresh_folder

#: Items of the first block and of the largest: some bytes a factor to each task.
FIRST_ITEMS, MOST_ITEMS = 1024, 65_536
#: Users scored together in a task.
USERS = 4096

_STATE = "user_id int, u array<float>, items array<int>, scores array<double>, done boolean"


@dataclass(frozen=True)
class TopLists:
    """Lists as ``recommend`` gives them, and how many pairs were scored of all."""

    lists: DataFrame
    scored: int
    pairs: int


def _by_length(items: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """(movie_id, i, length, position) in falling length, positions from 0, and how many.

    Positions are counted per written part and the parts' sizes added up, so that no
    task sees all items.
    """
    spark = items.sparkSession
    squares = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    sized = items.select(F.col("id").alias("movie_id"), F.col("features").alias("i"), F.sqrt(squares).alias("length"))
    ordered = sized.repartitionByRange(F.desc("length"), "movie_id").sortWithinPartitions(F.desc("length"), "movie_id")
    place = F.monotonically_increasing_id()
    # The upper bits are the part, the lower 33 the place in it; both are written.
    placed = ordered.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place"))
    placed.write.parquet(folder)
    stored = spark.read.parquet(folder)
    sizes = stored.groupBy("part").count().orderBy("part").collect()  # a row per part
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["part"], total))
        total += row["count"]
    if not total:
        return stored.select("movie_id", "i", "length", F.col("place").alias("position")), 0
    starts = F.broadcast(spark.createDataFrame(offsets, "part long, start long"))
    position = (F.col("start") + F.col("place")).alias("position")
    return stored.join(starts, "part").select("movie_id", "i", "length", position), total


def _round(
    users: DataFrame, ids: np.ndarray, factors: np.ndarray, longest_after: float, n: int
) -> DataFrame:
    """Users with the best ``n`` of what they had and the items of a block."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, USERS):
                part = batch.slice(at, USERS)
                u = np.array(part["u"].to_pylist(), np.float64)
                kept, had = part["items"].to_pylist(), part["scores"].to_pylist()
                # Single precision, in which lists are ordered and ties are ties.
                found = (u @ factors.T).astype(np.float32)
                few = min(n, len(ids))
                least = -np.partition(-found, few - 1, axis=1)[:, few - 1]
                lengths = np.sqrt((u * u).sum(axis=1))
                rows = []
                for row, (user, items, scores) in enumerate(zip(u, kept, had)):
                    near = np.flatnonzero(found[row] >= least[row])
                    merged = [*zip(scores, items), *zip(found[row, near].tolist(), ids[near].tolist())]
                    best = sorted(merged, key=lambda x: (-x[0], -x[1]))[:n]
                    # A bound may fall short of a score by rounding, far less than this.
                    bound = lengths[row] * longest_after * (1 + 1e-6)
                    done = longest_after < 0 or (len(best) == n and bound < best[-1][0])
                    rows.append(([item for _, item in best], [score for score, _ in best], done))
                items, scores, done = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["user_id"],
                        part["u"],
                        pa.array(items, pa.list_(pa.int32())),
                        pa.array(scores, pa.list_(pa.float64())),
                        pa.array(done),
                    ],
                    names=["user_id", "u", "items", "scores", "done"],
                )

    return users.mapInArrow(scored, _STATE)


def top_lists(model: ALSModel, n: int = 5, first: int = FIRST_ITEMS, most: int = MOST_ITEMS) -> TopLists:
    """The ``n`` best items of every user, as ``recommendForAllUsers`` orders them: by
    score in single precision, and of equal scores the greater id first, also at the
    last place, where that one keeps whichever its blocks give.

    Every round is written to the shared folder, so a lost executor costs its tasks of
    one round. Without items there are no lists.
    """
    spark: SparkSession = model.userFactors.sparkSession
    folder = fresh_folder(spark, "top-lists")
    items, total = _by_length(model.itemFactors, f"{folder}/items")
    empty = F.array()
    active = model.userFactors.select(
        F.col("id").alias("user_id"),
        F.col("features").alias("u"),
        empty.cast("array<int>").alias("items"),
        empty.cast("array<double>").alias("scores"),
        F.lit(False).alias("done"),
    )
    at, size, number, scored = 0, first, 0, 0
    users = left = model.userFactors.count()
    while at < total and left:
        # One item more than the block: the longest of what is left after it.
        block = items.where(F.col("position").between(at, at + size)).orderBy("position").collect()
        longest_after = block[size]["length"] if len(block) > size else -1.0
        block = block[:size]
        ids = np.array([row["movie_id"] for row in block], np.int64)
        factors = np.array([row["i"] for row in block], np.float64)
        _round(active, ids, factors, longest_after, n).write.partitionBy("done").parquet(f"{folder}/rounds/{number}")
        scored += left * len(block)
        rounds = spark.read.schema(_STATE).parquet(f"{folder}/rounds/{number}")
        active = rounds.where(~F.col("done"))
        left = active.count()
        at, size, number = at + size, min(2 * size, most), number + 1
    pairs = users * total
    if not number:
        return TopLists(spark.createDataFrame([], RECOMMENDATIONS), 0, 0)
    rounds = [f"{folder}/rounds/{at}/done=true" for at in range(number)]
    done = [folder for folder in rounds if exists(spark, folder)]
    found = spark.read.schema(_STATE.rsplit(",", 1)[0]).parquet(*done)
    listed = F.zip_with(
        "items", F.col("scores").cast("array<float>"), lambda i, s: F.struct(i.alias("movie_id"), s.alias("rating"))
    )
    return TopLists(found.select("user_id", listed.alias("recommendations")), scored, pairs)

