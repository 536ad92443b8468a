"""Recommendations as JSON documents that are replaced as a whole."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from ratemill.schemas import RECOMMENDATIONS
from ratemill.sources.tables import EDITION, drop_old_editions, newest_edition, next_edition

#: Folders of an edition; a lookup of one user reads one of them.
BUCKETS = 64
BUCKET = "_bucket"


def bucket_of(user_id: Column) -> Column:
    return F.pmod(F.xxhash64(user_id.cast("int")), F.lit(BUCKETS)).cast("int")


def export_recommendations(recommendations: DataFrame, path: str, keep: int = 2) -> str:
    """Write a new edition below ``path``; readers keep the last complete one.

    Afterwards the newest ``keep`` complete editions stay, so that a reader of
    the previous one can finish, and older or unfinished ones are removed.
    """
    if keep < 1:
        raise ValueError("keep at least the edition just written")
    session = recommendations.sparkSession
    target = f"{path}/{EDITION}{next_edition(session, path)}"
    by_bucket = recommendations.withColumn(BUCKET, bucket_of(F.col("user_id")))
    # One task per bucket writes its file; AQE splits buckets that are too large.
    by_bucket.hint("rebalance", BUCKET).write.partitionBy(BUCKET).json(target)
    drop_old_editions(session, path, keep=keep)
    return target


def read_recommendations(spark: SparkSession, path: str, user_id: int | None = None) -> DataFrame:
    """The newest complete edition, or one user's part of it; an error if there is none."""
    stored = StructType([*RECOMMENDATIONS.fields]).add(BUCKET, IntegerType())
    lists = spark.read.schema(stored).json(newest_edition(spark, path))
    if user_id is not None:
        here = F.col(BUCKET) == bucket_of(F.lit(user_id))
        lists = lists.where(here & (F.col("user_id") == user_id))
    return lists.select(*RECOMMENDATIONS.fieldNames())
