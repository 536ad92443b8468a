"""Rating events, catalog and profiles derived from the given tables.

The rules are those of FIXTURES.md, part 2.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratemill.operators.parts import spread
from ratemill.schemas import EVENT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: str) -> Column:
    """Whole seconds of a zone-less timestamp column, read as UTC."""
    return F.unix_date(F.col(ts).cast("date")).cast("bigint") * 86400 + (
        F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    )


def rated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ratings, with the event number, its value and arrival wave."""
    item = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        F.col("user_id").cast("int").alias("user_id"),
        item.alias("movie_id"),
        F.least(F.lit(5), 1 + F.floor(F.col("value") / 25)).cast("double").alias("rating"),
        epoch_seconds("ts").alias("timestamp"),
        F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10)).cast("int").alias("wave"),
    )


def wrongly_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated events, every thirtieth with its time in milliseconds by mistake."""
    wrong = F.col("event_id") % 30 == 0
    return rated_events(spark, sf_dir).withColumn(
        "timestamp", F.when(wrong, F.col("timestamp") * 1000).otherwise(F.col("timestamp"))
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in ``value`` with planted defects, and their arrival ``wave``."""

    def text(rating: Column) -> Column:
        return F.to_json(
            F.struct("user_id", "movie_id", rating.alias("rating"), "timestamp")
        )

    number, rating = F.col("event_id"), F.col("rating")
    message = text(rating)
    messages = F.array(
        message,
        F.when(number % 10 == 3, message),
        F.when(number % 50 == 7, text(6 - rating)),
        F.when(number % 40 == 11, text(F.lit(None).cast("double"))),
        F.when(number % 100 == 13, F.substring(message, 1, 12)),
    )
    return rated_events(spark, sf_dir).select(
        F.explode(F.array_compact(messages)).alias("value"), "wave"
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        (1970 + F.col("p_size")).alias("release_year"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    ).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        (18 + F.col("c_custkey") % 43).alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("subscription_tier"),
    )


def n_order_lines(spark: SparkSession, sf_dir: str) -> int:
    """How many order lines there are; reads file footers only."""
    return table(spark, sf_dir, "lineitem").count()


def raw_ratings_large(spark: SparkSession, sf_dir: str, rows: int | None = None) -> DataFrame:
    """Order lines as ratings of several years, not yet deduplicated.

    With ``rows``, how many they are, many lines are dealt by order for the join.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    lines = spread(lines, rows, "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("movie_id"),
        (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("rating"),
        epoch_seconds("l_shipdate").alias("timestamp"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted ratings as text, some of them faulty, and their time."""
    number = F.col("event_id")

    def at(remainder: int, text: str | None, otherwise: Column) -> Column:
        return F.when(number % 20 == remainder, F.lit(text)).otherwise(otherwise)

    user, movie, rating = (F.col(name).cast("string") for name in EVENT_COLUMNS[:3])
    return rated_events(spark, sf_dir).select(
        at(2, "abc", at(5, " 10 ", user)).alias("user_id"),
        at(3, "10.9", movie).alias("movie_id"),
        at(1, None, at(4, "nan", rating)).alias("rating"),
        F.col("timestamp").alias("received_at"),
    )


def submission_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same submissions as JSON bodies in ``value``.

    Ratings are JSON strings, as a browser form sends them. Whole ids are JSON
    numbers, some written with a fraction; other ids are JSON strings.
    """

    def member(name: str, fraction: str = "") -> Column:
        text = F.col(name)
        number = F.concat(text, F.lit(fraction))
        literal = F.when(text.rlike("^[0-9]+$"), number).otherwise(
            F.concat(F.lit('"'), text, F.lit('"'))
        )
        return F.concat(F.lit(f'"{name}":'), literal)

    rating = F.concat(F.lit('"rating":"'), F.col("rating"), F.lit('"'))
    members = F.concat_ws(",", member("user_id"), member("movie_id", ".9"), rating)
    return submissions(spark, sf_dir).select(
        F.concat(F.lit("{"), members, F.lit("}")).alias("value"), "received_at"
    )


def resubmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice: as it came, and later with the opposite rating."""
    first = rated_events(spark, sf_dir).select(*EVENT_COLUMNS, F.lit(1).alias("arrival"))
    later = first.withColumn("rating", 6 - F.col("rating")).withColumn("arrival", F.lit(2))
    return first.unionByName(later)
