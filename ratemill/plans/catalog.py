"""Every registered query: (session, data folder) to a DataFrame."""

from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratemill.functions.calendar import date_id
from ratemill.operators import decode, marts, recommend, serve, star, validate
from ratemill.operators.cleanse import clean_ratings
from ratemill.operators.toplists import top_lists
from ratemill.plans import cycle, fixtures
from ratemill.plans.silver import read_silver, read_totals, rebuild_silver, refresh_silver
from ratemill.plans.star import Star, build_star, read_star, write_star
from ratemill.sources.bronze import bronze_versions, compact_bronze, read_bronze
from ratemill.sources.documents import export_recommendations, read_recommendations
from ratemill.sources.events import publish_events, read_event_stream
from ratemill.sources.storage import fresh_folder
from ratemill.sources.tables import overwrite_table, read_table
from ratemill.sources.warehouse import register_views
from ratemill.streaming.bronze import write_bronze

Query = Callable[[SparkSession, str], DataFrame]

_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Result of ``make``, kept for the life of the Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drop kept results, so that the next query does all of its work."""
    _kept.clear()


# --- raw and clean events ---------------------------------------------------


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse_events(fixtures.raw_events(spark, sf_dir))


def encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.encode_events(fixtures.rated_events(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ratings(parse_events(spark, sf_dir))


def silver_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).agg(F.count("*").alias("n_rows"))


def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ratings where the last arrival of a key wins."""
    received = fixtures.resubmitted(spark, sf_dir)
    return clean_ratings(received, latest_by="arrival")


def silver_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.n_order_lines(spark, sf_dir)
    return clean_ratings(fixtures.raw_ratings_large(spark, sf_dir, rows), rows=rows)


# --- streaming and versions -------------------------------------------------


def ingest(spark: SparkSession, sf_dir: str) -> str:
    """Stream the raw events in three waves, one micro-batch each."""
    base = fresh_folder(spark, "ingest")
    incoming, bronze = f"{base}/incoming", f"{base}/bronze"
    messages = fixtures.raw_events(spark, sf_dir)
    for wave in range(3):
        publish_events(messages.where(F.col("wave") == wave), "text", {"path": incoming})
        events = decode.parse_events(read_event_stream(spark, "text", {"path": incoming}))
        write_bronze(
            events, bronze, f"{base}/checkpoint", {"availableNow": True}
        ).awaitTermination()
    return bronze


def _bronze(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "bronze", lambda: ingest(spark, sf_dir))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _bronze(spark, sf_dir))


def snapshot_v0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _bronze(spark, sf_dir), version=0)


def snapshot_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of version 0."""
    return marts.sample(snapshot_v0(spark, sf_dir))


def _compacted(spark: SparkSession, sf_dir: str) -> str:
    """Bronze once more, with the first two batches in a range."""

    def make() -> str:
        path = ingest(spark, sf_dir)
        compact_bronze(spark, path, before=bronze_versions(spark, path)[-1])
        return path

    return _once(spark, sf_dir, "compacted bronze", make)


def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _compacted(spark, sf_dir))


def snapshot_v0_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _compacted(spark, sf_dir), version=0)


def _refresh(spark: SparkSession, sf_dir: str, totals: bool) -> str:
    """Silver of the first version, then refreshed version by version."""
    bronze = _bronze(spark, sf_dir)
    target = fresh_folder(spark, "silver")
    first, *later = bronze_versions(spark, bronze)
    rebuild_silver(spark, bronze, target, first, totals=totals)
    for version in later:
        refresh_silver(spark, bronze, target, version)
    return target


def silver_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _refresh(spark, sf_dir, totals=False))


def _silver_with_totals(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "silver with totals", lambda: _refresh(spark, sf_dir, totals=True))


def silver_with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _silver_with_totals(spark, sf_dir))


# --- star schema and reports ------------------------------------------------


def ratings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, which the star and every fit read."""

    def write() -> str:
        path = fresh_folder(spark, "ratings")
        overwrite_table(silver(spark, sf_dir), path)
        return path

    return read_table(spark, _once(spark, sf_dir, "ratings", write))


def raw_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of events in one plan, from the raw messages on."""
    return build_star(
        silver(spark, sf_dir),
        fixtures.items(spark, sf_dir),
        fixtures.profiles(spark, sf_dir),
    )


def events_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of events as written tables."""

    def write() -> str:
        path = fresh_folder(spark, "events-star")
        built = build_star(
            ratings_table(spark, sf_dir),
            fixtures.items(spark, sf_dir),
            fixtures.profiles(spark, sf_dir),
        )
        write_star(built, path)
        return path

    return read_star(spark, _once(spark, sf_dir, "events star", write))


def orders_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of order lines as written tables."""

    def write() -> str:
        path = fresh_folder(spark, "star")
        built = build_star(
            silver_large(spark, sf_dir),
            fixtures.items(spark, sf_dir),
            fixtures.profiles(spark, sf_dir),
        )
        write_star(built, path)
        return path

    return read_star(spark, _once(spark, sf_dir, "orders star", write))


def star_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_star(spark, sf_dir).check()


def star_check_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on the written raw events as facts, with dates per second."""
    raw = bronze_stream(spark, sf_dir)
    items = star.dim_item(fixtures.items(spark, sf_dir))
    users = star.dim_user(fixtures.profiles(spark, sf_dir))
    seconds = raw.select("timestamp").distinct()
    dates = seconds.select(date_id(F.col("timestamp")).alias("date_id"))
    return star.check_star(
        star.fact_ratings(raw),
        {
            "dim_movie": (items, "movie_id"),
            "dim_user": (users, "user_id"),
            "dim_date": (dates, "date_id"),
        },
    )


def top_items_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from totals that two refreshes kept up to date."""
    totals = read_totals(spark, _silver_with_totals(spark, sf_dir))
    return marts.top_items(totals.by_item, events_star(spark, sf_dir).dim_item)


def trend_by_month_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = read_totals(spark, _silver_with_totals(spark, sf_dir))
    return marts.trend_by_month(totals.by_date, star.dim_date(totals.by_date))


def location_genre_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals, dims = read_totals(spark, _silver_with_totals(spark, sf_dir)), events_star(spark, sf_dir)
    return marts.location_genre(totals.by_pair, dims.dim_user, dims.dim_item)


def fact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five facts by SQL over the registered tables."""
    register_views(events_star(spark, sf_dir).tables())
    return spark.sql(
        "SELECT * FROM fact_ratings ORDER BY user_id, movie_id, date_id, rating LIMIT 5"
    )


def trend_by_month_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of events of which some have a time beyond any date."""
    fact = star.fact_ratings(clean_ratings(fixtures.wrongly_timed(spark, sf_dir)))
    return marts.trend_by_month(fact, star.dim_date(fact))


def _reports(name: str, build: Callable[[SparkSession, str], Star]) -> dict[str, Query]:
    def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = build(spark, sf_dir)
        return marts.top_items(built.fact_ratings, built.dim_item)

    def trend_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = build(spark, sf_dir)
        return marts.trend_by_month(built.fact_ratings, built.dim_date)

    def location_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = build(spark, sf_dir)
        return marts.location_genre(built.fact_ratings, built.dim_user, built.dim_item)

    return {
        f"top_items{name}": top_items,
        f"trend_by_month{name}": trend_by_month,
        f"location_genre{name}": location_genre,
    }


# --- submissions ------------------------------------------------------------


def validate_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_submissions(
        fixtures.submissions(spark, sf_dir), time_column="received_at"
    )


def validate_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = fixtures.submission_bodies(spark, sf_dir)
    return validate.validate_submissions(
        validate.parse_submissions(bodies, keep=["received_at"]), time_column="received_at"
    )


def validate_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many submissions are stamped with the current time, to the hour."""
    checked = validate.validate_submissions(fixtures.submissions(spark, sf_dir))
    age = F.unix_timestamp() - F.col("timestamp")
    return checked.agg(
        F.count("*").alias("n_rows"), F.count_if(age.between(-3600, 3600)).alias("n_current")
    )


# --- recommender ------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return recommend.split_ratings(ratings_table(spark, sf_dir))


def trial_model(spark: SparkSession, sf_dir: str) -> ALSModel:
    return _once(
        spark, sf_dir, "trial model", lambda: recommend.fit_als(_split(spark, sf_dir)[0])
    )


def full_model(spark: SparkSession, sf_dir: str) -> ALSModel:
    return _once(
        spark, sf_dir, "full model", lambda: recommend.fit_als(ratings_table(spark, sf_dir))
    )


def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, test = _split(spark, sf_dir)
    return training.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.predict(trial_model(spark, sf_dir), _split(spark, sf_dir)[1])


def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test rows get a prediction: those whose user and item were trained."""
    return predictions(spark, sf_dir).select("user_id", "movie_id", "rating", "timestamp")


def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.rmse(predictions(spark, sf_dir))


def rmse_resubmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of first ratings taken as predictions of the opposite ones."""
    rated = fixtures.rated_events(spark, sf_dir)
    return recommend.rmse(rated.select("rating", (6 - F.col("rating")).alias("prediction")))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.flatten(recommend.recommend(full_model(spark, sf_dir)))


def recommendations_pruned_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, items of the lists found without scoring all pairs, and ranks at which
    their scores differ from those over all pairs."""
    pruned = recommend.flatten(top_lists(full_model(spark, sf_dir)).lists)
    both = recommendations(spark, sf_dir).join(
        pruned.select("user_id", "rank", F.col("score").alias("pruned")), ["user_id", "rank"], "full"
    )
    off = F.coalesce(F.abs(F.col("score") - F.col("pruned")) > 1e-4, F.lit(True))
    return both.groupBy("user_id").agg(F.count("pruned").alias("n_items"), F.count_if(off).alias("n_off"))


def recommendation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: number of items, of distinct items, and of rises in score."""
    items = F.col("recommendations.movie_id")
    scores = F.col("recommendations.rating")
    rises = F.filter(
        F.arrays_zip(scores.alias("score"), F.slice(scores, 2, 1 << 30).alias("following")),
        lambda pair: pair["following"] > pair["score"],
    )
    return recommend.recommend(full_model(spark, sf_dir)).select(
        "user_id",
        F.size(items).alias("n_items"),
        F.size(F.array_distinct(items)).alias("n_distinct"),
        F.size(rises).alias("n_rises"),
    )


def _artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations, exported as JSON and read back."""

    def export() -> str:
        path = fresh_folder(spark, "recommendations")
        export_recommendations(recommend.recommend(full_model(spark, sf_dir)), path)
        return path

    return read_recommendations(spark, _once(spark, sf_dir, "artifact", export))


def rec_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for their recommendations."""
    users = star.dim_user(fixtures.profiles(spark, sf_dir))
    found = serve.lookup(_artifact(spark, sf_dir), users)
    return found.select(
        "user_id",
        "status",
        F.coalesce(F.array_size("recommendations"), F.lit(0)).alias("n_items"),
    )


def rec_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = events_star(spark, sf_dir).dim_item
    return serve.enrich(recommend.flatten(_artifact(spark, sf_dir)), items)


def rating_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display columns for event values as scores; items beyond the catalog by number."""
    scored = fixtures.rated_events(spark, sf_dir).select(
        "event_id", "user_id", "movie_id", (F.col("value") / 50).alias("score")
    )
    return serve.enrich(scored, events_star(spark, sf_dir).dim_item)


def _factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("movie_id"), F.col("features").alias("i"))
    return users, items


def _product() -> Column:
    """Inner product of the factors u and i, summed up in double precision."""
    parts = F.zip_with("u", "i", lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)


def predictions_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, predictions and how many differ from the product of the factors."""
    users, items = _factors(trial_model(spark, sf_dir))
    found = predictions(spark, sf_dir).join(users, "user_id").join(items, "movie_id")
    off = F.abs(F.col("prediction") - _product()) > 1e-4
    return found.groupBy("user_id").agg(F.count("*").alias("n_rows"), F.count_if(off).alias("n_off"))


def rmse_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the error of the trial model, and whether it can be recomputed."""
    users, items = _factors(trial_model(spark, sf_dir))
    test = _split(spark, sf_dir)[1].join(users, "user_id").join(items, "movie_id")
    error = F.col("rating") - _product()
    again = test.agg(F.count("*").alias("n_rows"), F.sqrt(F.avg(error * error)).alias("again"))
    return again.join(rmse(spark, sf_dir)).select(
        "n_rows", (F.abs(F.col("again") - F.col("rmse")) < 1e-4).alias("agrees")
    )


def top_lists_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, listed items, wrong scores, and items that beat the last listed one.

    All pairs are scored again, in blocks of users and items.
    """
    users, items = _factors(full_model(spark, sf_dir))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(recommend.USER_BLOCKS - 1))).alias("block")
    listed = recommendations(spark, sf_dir)
    last = listed.groupBy("user_id").agg(F.min("score").alias("last"), F.count("*").alias("n_items"))
    asked = users.join(last, "user_id").withColumn("block", F.pmod("user_id", F.lit(recommend.USER_BLOCKS)))
    pairs = asked.join(items.select("movie_id", "i", blocks), "block")
    beaten = pairs.groupBy("user_id").agg(
        F.first("n_items").alias("n_items"), F.count_if(_product() > F.col("last") + 1e-4).alias("n_above")
    )
    scored = listed.join(users, "user_id").join(items, "movie_id")
    wrong = (
        scored.withColumn("product", _product())
        .join(last.select("user_id", "last"), "user_id")
        .groupBy("user_id")
        .agg(
            F.count_if(F.abs(F.col("score") - F.col("product")) > 1e-4).alias("n_off"),
            F.count_if(F.col("product") > F.col("last") + 1e-4).alias("n_own"),
        )
    )
    return beaten.join(wrong, "user_id").select(
        "user_id", "n_items", "n_off", (F.col("n_above") - F.col("n_own")).alias("n_better")
    )


def flatten_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best ratings of every user as a list, unpacked."""
    best_first = Window.partitionBy("user_id").orderBy(F.desc("rating"), "movie_id", "timestamp")
    best = ratings_table(spark, sf_dir).withColumn("n", F.row_number().over(best_first)).where("n <= 5")
    item = F.struct("n", "movie_id", F.col("rating").cast("float").alias("rating"))
    lists = best.groupBy("user_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return recommend.flatten(
        lists.select(
            "user_id",
            F.transform("items", lambda x: F.struct(x["movie_id"].alias("movie_id"), x["rating"].alias("rating"))).alias(
                "recommendations"
            ),
        )
    )


def train_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a cycle would train on the events of each wave; there is no fourth."""
    rated = fixtures.rated_events(spark, sf_dir)
    waves = [(wave, cycle.has_rows(rated.where(F.col("wave") == wave))) for wave in range(4)]
    return spark.createDataFrame(waves, "wave int, trains boolean")


# --- the whole pipeline -----------------------------------------------------


def run_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that one cycle over the streamed events leaves."""
    base = fresh_folder(spark, "cycle")
    paths = cycle.Paths(
        _bronze(spark, sf_dir), f"{base}/silver", f"{base}/gold", f"{base}/recommendations"
    )
    items, profiles = fixtures.items(spark, sf_dir), fixtures.profiles(spark, sf_dir)
    cycle.run_cycle(spark, paths, items, profiles)
    tables = {
        "bronze": read_bronze(spark, paths.bronze),
        "silver": read_silver(spark, paths.silver),
        **cycle.read_gold(spark, paths).tables(),
        "recommendations": read_recommendations(spark, paths.recommendations),
    }
    counts = [
        table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, table in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


# Tables and models that several queries share; made once per application.
PREPARED: dict[str, Callable[[SparkSession, str], object]] = {
    "bronze": _bronze,
    "compacted bronze": _compacted,
    "silver with totals": _silver_with_totals,
    "ratings table": ratings_table,
    "events star": events_star,
    "orders star": orders_star,
    "trial model": trial_model,
    "full model": full_model,
    "artifact": _artifact,
}

QUERIES: dict[str, Query] = {
    "parse_events": parse_events,
    "encode_events": encode_events,
    "bronze_stream": bronze_stream,
    "snapshot_v0": snapshot_v0,
    "snapshot_sample": snapshot_sample,
    "bronze_compacted": bronze_compacted,
    "snapshot_v0_compacted": snapshot_v0_compacted,
    "silver": silver,
    "silver_count": silver_count,
    "silver_latest": silver_latest,
    "silver_large": silver_large,
    "silver_refreshed": silver_refreshed,
    "silver_with_totals": silver_with_totals,
    "top_items_refreshed": top_items_refreshed,
    "trend_by_month_refreshed": trend_by_month_refreshed,
    "location_genre_refreshed": location_genre_refreshed,
    "dim_item": lambda spark, sf_dir: star.dim_item(fixtures.items(spark, sf_dir)),
    "dim_user": lambda spark, sf_dir: star.dim_user(fixtures.profiles(spark, sf_dir)),
    "dim_date": lambda spark, sf_dir: events_star(spark, sf_dir).dim_date,
    "dim_date_large": lambda spark, sf_dir: orders_star(spark, sf_dir).dim_date,
    "fact_ratings": lambda spark, sf_dir: events_star(spark, sf_dir).fact_ratings,
    "fact_ratings_large": lambda spark, sf_dir: orders_star(spark, sf_dir).fact_ratings,
    "fact_sample": fact_sample,
    "star_check": star_check,
    "star_check_raw": star_check_raw,
    **_reports("", events_star),
    "top_items_from_raw": _reports("", raw_star)["top_items"],
    **_reports("_large", orders_star),
    "trend_by_month_unknown": trend_by_month_unknown,
    "validate": validate_submissions,
    "validate_bodies": validate_bodies,
    "validate_now": validate_now,
    "train_split": train_split,
    "predictions": predictions,
    "prediction_rows": prediction_rows,
    "rmse": rmse,
    "predictions_check": predictions_check,
    "rmse_check": rmse_check,
    "top_lists_check": top_lists_check,
    "flatten_ratings": flatten_ratings,
    "train_guard": train_guard,
    "rmse_resubmitted": rmse_resubmitted,
    "recommendations": recommendations,
    "recommendation_counts": recommendation_counts,
    "recommendations_pruned_check": recommendations_pruned_check,
    "rec_lookup": rec_lookup,
    "rec_enriched": rec_enriched,
    "rating_display": rating_display,
    "run_cycle": run_cycle,
}
