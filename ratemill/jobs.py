"""Jobs for ``spark-submit``; the session comes with the cluster's settings.

    spark-submit ratemill_job.py ingest --format kafka \\
        --option kafka.bootstrap.servers=broker:9092 --option subscribe=movie_ratings \\
        --option startingOffsets=earliest --bronze B --checkpoint C --every "20 seconds"
    spark-submit ratemill_job.py cycle --bronze B --silver S --gold G \\
        --recommendations R --items I --profiles P
    spark-submit ratemill_job.py report top_items --silver S --gold G --out O
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ratemill.operators import marts, validate
from ratemill.operators.decode import encode_events, parse_events
from ratemill.operators.recommend import ITEM_BLOCKS, USER_BLOCKS
from ratemill.plans import cycle
from ratemill.plans.silver import (
    has_totals,
    merge_silver,
    read_changes,
    read_silver,
    read_totals,
    refresh_silver,
)
from ratemill.plans.star import FACT_TABLE, Star
from ratemill.sources.bronze import compact_bronze, read_bronze
from ratemill.sources.documents import read_recommendations
from ratemill.sources.events import publish_events, read_event_stream
from ratemill.sources.storage import exists, fresh_folder, remove
from ratemill.sources.tables import overwrite_table, read_table
from ratemill.sources.warehouse import loaded_version, merge_warehouse, write_warehouse
from ratemill.streaming.bronze import write_bronze

REPORTS = {
    "top_items": lambda s, t: marts.top_items(t.by_item if t else s.fact_ratings, s.dim_item),
    "trend_by_month": lambda s, t: marts.trend_by_month(t.by_date if t else s.fact_ratings, s.dim_date),
    "location_genre": lambda s, t: marts.location_genre(
        t.by_pair if t else s.fact_ratings, s.dim_user, s.dim_item
    ),
    "sample": lambda s, t: marts.sample(s.fact_ratings),
    "check": lambda s, t: Star.check(s),
}

# Rows of a table that a job prints; reports are written in full.
SHOWN = 20


def _paths(args: argparse.Namespace) -> cycle.Paths:
    return cycle.Paths(
        *[getattr(args, name, None) for name in ("bronze", "silver", "gold", "recommendations")]
    )


#: Primary keys of the dimensions, and what tells facts apart when they are merged.
KEYS = {"dim_movie": ["movie_id"], "dim_user": ["user_id"], "dim_date": ["date_id"]}
FACT_GROUP = ("user_id", "movie_id", "date_id")


def _load(spark: SparkSession, args: argparse.Namespace):
    """What loads a star into the warehouse: all of it, or the facts that changed.

    A star's version is read before its facts: a refresh meanwhile can bring in facts
    early, which the next load sends again, and never leaves one out.
    """
    if args.jdbc_url is None:
        return None
    url, login = args.jdbc_url, dict(args.jdbc_option)

    def load(star: Star) -> None:
        version = star.version
        if not args.jdbc_changes:
            write_warehouse(star.tables(), url, login, KEYS, {FACT_TABLE: version})
            return
        since = loaded_version(spark, url, login, FACT_TABLE)
        if since is None or since > version:
            raise ValueError(f"the warehouse holds version {since}, Silver {version}: load it whole")
        scratch = fresh_folder(spark, "changes")
        overwrite_table(read_changes(spark, args.silver, since, FACT_GROUP, args.fmt), scratch)
        changes = read_table(spark, scratch)
        merge_warehouse(
            star.dimensions(), FACT_TABLE, changes, FACT_GROUP, url, login, KEYS, since=since, version=version
        )
        remove(spark, scratch)

    return load


def _model(args: argparse.Namespace) -> dict[str, int | bool]:
    return {"user_blocks": args.user_blocks, "item_blocks": args.item_blocks, "pruned": args.pruned}


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    events = parse_events(read_event_stream(spark, args.format, dict(args.option)))
    write_bronze(events, args.bronze, args.checkpoint, trigger, args.fmt).awaitTermination()


def submit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Publish the valid ones of submitted JSON bodies and keep the others.

    ``--batch`` names the input. It is read, checked and stamped with the time once, to
    a table below ``--rejects``; a retry goes on from that table, replaces the rejects
    of its batch, and publishes the same events, whose copies cleaning removes.
    """
    checked_path = f"{args.rejects}/_checked/batch={args.batch}"
    if not exists(spark, f"{checked_path}/_SUCCESS"):
        bodies = spark.read.text(args.bodies)
        overwrite_table(validate.validate_submissions(validate.parse_submissions(bodies)), checked_path)
    checked = read_table(spark, checked_path)
    validate.rejected(checked).write.mode("overwrite").json(f"{args.rejects}/batch={args.batch}")
    publish_events(encode_events(validate.accepted(checked)), args.format, dict(args.option))


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    version = refresh_silver(
        spark, args.bronze, args.silver, since=args.since, fmt=args.fmt, totals=not args.no_totals
    )
    print(f"Silver holds version {version}")


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge runs of Silver; beside readers and refreshes, whenever it suits."""
    print(f"{merge_silver(spark, args.silver, args.fmt)} runs fewer")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge the parts of old batches; also while an ingest job writes to the table."""
    print(f"Compacted up to version {compact_bronze(spark, args.bronze)}")


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    items, profiles = read_table(spark, args.items), read_table(spark, args.profiles)
    star = cycle.write_gold(spark, _paths(args), items, profiles, args.fmt)
    load = _load(spark, args)
    if load:
        load(star)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    ratings = read_silver(spark, args.silver, args.fmt)
    rmse, edition = cycle.train(ratings, args.recommendations, **_model(args))
    print(f"RMSE {rmse}, recommendations in {edition}")


def run_cycle(spark: SparkSession, args: argparse.Namespace) -> None:
    items, profiles = read_table(spark, args.items), read_table(spark, args.profiles)
    print(
        cycle.run_cycle(
            spark, _paths(args), items, profiles, args.since, _load(spark, args), fmt=args.fmt, **_model(args)
        )
    )


def snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    _show(marts.sample(read_bronze(spark, args.bronze, args.version, args.fmt)))


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write the whole report where ``--out`` says, and show its head."""
    totals = read_totals(spark, args.silver, args.fmt) if has_totals(spark, args.silver) else None
    found = REPORTS[args.name](cycle.read_gold(spark, _paths(args), args.fmt), totals)
    overwrite_table(found.coalesce(1), args.out, "json")
    _show(spark.read.json(args.out))


def lookup(spark: SparkSession, args: argparse.Namespace) -> None:
    _show(read_recommendations(spark, args.recommendations, args.user_id))


def _show(df: DataFrame) -> None:
    rows = df.count()
    df.show(SHOWN, truncate=False)
    if rows > SHOWN:
        print(f"{rows - SHOWN} more rows are not shown")


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ratemill", description=__doc__.splitlines()[0])
    top.add_argument("--fmt", default="parquet", help="format of Bronze, Silver and Gold")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *paths):
        added = jobs.add_parser(name)
        added.set_defaults(run=run)
        for path in paths:
            added.add_argument(f"--{path}", required=True)
        return added

    def messages(added):
        added.add_argument("--format", default="kafka")
        added.add_argument("--option", type=_pair, action="append", default=[])

    def warehouse(added):
        added.add_argument("--jdbc-url")
        added.add_argument("--jdbc-option", type=_pair, action="append", default=[])
        added.add_argument("--jdbc-changes", action="store_true", help="send only facts that changed")

    added = job("ingest", ingest, "bronze", "checkpoint")
    messages(added)
    added.add_argument("--every", help="pause between batches; without it, one pass")
    messages(job("submit", submit, "bodies", "rejects", "batch"))
    def model(added):
        added.add_argument("--pruned", action="store_true", help="top lists without scoring all pairs")
        added.add_argument("--user-blocks", type=int, default=USER_BLOCKS, help="of ALS: its parallelism")
        added.add_argument("--item-blocks", type=int, default=ITEM_BLOCKS)

    added = job("silver", silver, "bronze", "silver")
    added.add_argument("--since", type=int)
    added.add_argument("--no-totals", action="store_true", help="a first build without totals for reports")
    job("merge", merge, "silver")
    job("compact", compact, "bronze")
    warehouse(job("gold", gold, "silver", "gold", "items", "profiles"))
    model(job("train", train, "silver", "recommendations"))
    added = job(
        "cycle", run_cycle, "bronze", "silver", "gold", "recommendations", "items", "profiles"
    )
    warehouse(added)
    model(added)
    added.add_argument("--since", type=int)
    job("snapshot", snapshot, "bronze").add_argument("--version", type=int, default=0)
    job("report", report, "silver", "gold", "out").add_argument("name", choices=sorted(REPORTS))
    job("lookup", lookup, "recommendations").add_argument("--user-id", type=int, required=True)
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("ratemill").getOrCreate(), args)
