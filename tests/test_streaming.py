import pytest

from ratemill.operators import marts
from ratemill.operators.cleanse import clean_ratings
from ratemill.operators.decode import encode_events, parse_events
from ratemill.plans import cycle
from ratemill.plans.silver import read_silver, rebuild_silver, refresh_silver, silver_version
from ratemill.sources.bronze import (
    bronze_versions,
    compact_bronze,
    latest_version,
    read_batches,
    read_bronze,
)
from ratemill.sources.commits import newest
from ratemill.sources.documents import read_recommendations
from ratemill.sources.events import publish_events, read_event_stream, read_events
from ratemill.sources.storage import fresh_folder
from ratemill.streaming.bronze import append_batch, write_bronze
from ratemill.streaming.refresh import write_and_refresh

DAY = 86400


class Lake:
    def __init__(self, spark, base):
        self.spark = spark
        self.incoming, self.bronze, self.checkpoint, self.silver = (
            str(base / name) for name in ("incoming", "bronze", "checkpoint", "silver")
        )

    def publish(self, df):
        publish_events(encode_events(df), "text", {"path": self.incoming})

    def ingest(self, checkpoint=None):
        stream = read_event_stream(self.spark, "text", {"path": self.incoming})
        write_bronze(
            parse_events(stream), self.bronze, checkpoint or self.checkpoint, {"availableNow": True}
        ).awaitTermination()

    def versions(self):
        return bronze_versions(self.spark, self.bronze)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


WAVES = [
    [(1, 1, 3.0, 10), (2, 1, 4.0, DAY + 10)],
    [(1, 1, 5.0, 10), (3, 1, 1.0, 2 * DAY), (2, 2, 2.0, 10**15)],
    [(2, 1, 2.0, DAY + 10), (4, 4, 4.0, DAY), (2, 2, 3.0, 10**15), (1, 1, 5.0, 10)],
]


def test_versions(lake, spark, ratings):
    for wave in WAVES:
        lake.publish(ratings(wave))
        lake.ingest()
    assert lake.versions() == [0, 1, 2]
    for version in range(3):
        expected = sorted(row for wave in WAVES[: version + 1] for row in wave)
        assert rows(read_bronze(spark, lake.bronze, version)) == expected
    assert rows(read_bronze(spark, lake.bronze)) == rows(read_bronze(spark, lake.bronze, 2))
    with pytest.raises(ValueError):
        read_bronze(spark, lake.bronze, 3)


def test_nothing_new_adds_nothing(lake, spark, ratings):
    lake.publish(ratings(WAVES[0]))
    lake.ingest()
    lake.ingest()
    assert lake.versions() == [0]
    assert read_bronze(spark, lake.bronze).count() == 2


def test_replayed_batch_replaces_itself(lake, spark, ratings):
    lake.publish(ratings(WAVES[0]))
    lake.ingest()
    append_batch(ratings(WAVES[1]), 1, lake.bronze)
    append_batch(ratings(WAVES[1]), 1, lake.bronze)
    assert read_bronze(spark, lake.bronze).count() == 5


def test_lost_checkpoint_is_refused(lake, spark, ratings, tmp_path):
    lake.publish(ratings(WAVES[0]))
    lake.ingest()
    with pytest.raises(ValueError):
        lake.ingest(checkpoint=str(tmp_path / "another"))
    assert read_bronze(spark, lake.bronze).count() == 2


def test_batch_read_of_messages(lake, spark, ratings):
    lake.publish(ratings(WAVES[0]))
    assert rows(parse_events(read_events(spark, "text", {"path": lake.incoming}))) == sorted(WAVES[0])


def test_undecodable_messages_stay_in_bronze(lake, spark):
    publish_events(spark.createDataFrame([("junk",)], "value string"), "text", {"path": lake.incoming})
    lake.ingest()
    assert rows(read_bronze(spark, lake.bronze)) == [(None, None, None, None)]


def test_refreshed_silver_equals_a_rebuild(lake, spark, ratings, tmp_path):
    for wave in WAVES:
        lake.publish(ratings(wave))
        lake.ingest()
    rebuild_silver(spark, lake.bronze, lake.silver, 0)
    assert refresh_silver(spark, lake.bronze, lake.silver, 1, since=0) == 1
    assert refresh_silver(spark, lake.bronze, lake.silver) == 2
    assert refresh_silver(spark, lake.bronze, lake.silver) == 2
    whole = str(tmp_path / "whole")
    rebuild_silver(spark, lake.bronze, whole)
    assert rows(read_silver(spark, lake.silver)) == rows(read_silver(spark, whole))
    assert (2, 2, 3.0, 10**15) in rows(read_silver(spark, whole))


def test_batches_are_read_by_range(lake, spark, ratings):
    for number, wave in enumerate(WAVES):
        append_batch(ratings(wave), number, lake.bronze)
    for _ in range(2):
        assert rows(read_batches(spark, lake.bronze, 0, 2)) == sorted(WAVES[1] + WAVES[2])
        assert rows(read_batches(spark, lake.bronze, 1, 2)) == sorted(WAVES[2])
        assert rows(read_batches(spark, lake.bronze, 2, 2)) == []
        compact_bronze(spark, lake.bronze, before=2)


def test_compaction_changes_no_version(lake, spark, ratings, tmp_path):
    more = [[(7, 7, 1.0, 70)], [(8, 8, 2.0, 80)]]
    for number, wave in enumerate(WAVES):
        append_batch(ratings(wave), number, lake.bronze)
    assert compact_bronze(spark, lake.bronze, before=2) == 1
    for number, wave in enumerate(more, 3):
        append_batch(ratings(wave), number, lake.bronze)

    def check():
        assert lake.versions() == [0, 1, 2, 3, 4] and latest_version(spark, lake.bronze) == 4
        for version in range(5):
            expected = sorted(row for wave in [*WAVES, *more][: version + 1] for row in wave)
            assert rows(read_bronze(spark, lake.bronze, version)) == expected
        with pytest.raises(ValueError):
            read_bronze(spark, lake.bronze, 5)

    check()
    assert compact_bronze(spark, lake.bronze) == 4
    check()
    assert compact_bronze(spark, lake.bronze) is None
    assert [(part.first, part.last, part.level) for part in newest(spark, lake.bronze).parts] == [(0, 1, 1), (2, 4, 1)]


def test_stream_compacts_old_batches(lake, spark, ratings, tmp_path):
    for wave in WAVES:
        lake.publish(ratings(wave).coalesce(1))
    stream = read_event_stream(spark, "text", {"path": lake.incoming, "maxFilesPerTrigger": "1"})
    write_bronze(
        parse_events(stream), lake.bronze, lake.checkpoint, {"availableNow": True}, compact_every=2
    ).awaitTermination()
    assert lake.versions() == [0, 1, 2]
    assert [(part.first, part.last) for part in newest(spark, lake.bronze).parts] == [(2, 2), (0, 1)]
    assert rows(read_bronze(spark, lake.bronze)) == sorted(sum(WAVES, []))


def test_wrong_since_is_refused(lake, spark, ratings):
    for number, wave in enumerate(WAVES):
        append_batch(ratings(wave), number, lake.bronze)
    rebuild_silver(spark, lake.bronze, lake.silver, 0)
    with pytest.raises(ValueError):
        refresh_silver(spark, lake.bronze, lake.silver, 2, since=1)
    assert silver_version(spark, lake.silver) == 0
    refresh_silver(spark, lake.bronze, lake.silver)
    assert silver_version(spark, lake.silver) == 2 and read_silver(spark, lake.silver).count() == 5


def test_an_older_version_is_a_rebuild(lake, spark, ratings):
    for number, wave in enumerate(WAVES):
        append_batch(ratings(wave), number, lake.bronze)
    refresh_silver(spark, lake.bronze, lake.silver)
    refresh_silver(spark, lake.bronze, lake.silver, 0)
    assert silver_version(spark, lake.silver) == 0 and read_silver(spark, lake.silver).count() == 2


def test_a_table_without_a_complete_edition_is_not_read(lake, spark, ratings):
    lake.publish(ratings(WAVES[0]))
    lake.ingest()
    with pytest.raises(FileNotFoundError):
        read_silver(spark, lake.silver)
    rebuild_silver(spark, lake.bronze, lake.silver)
    assert read_silver(spark, lake.silver).count() == 2


def test_times_beyond_any_date_have_an_unknown_one(lake, spark, ratings, tmp_path):
    append_batch(ratings([(1, 1, 3.0, 1_700_000_000_000), (2, 1, 4.0, 1_700_000_000)]), 0, lake.bronze)
    paths = cycle.Paths(lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recs"))
    refresh_silver(spark, lake.bronze, lake.silver)
    built = cycle.write_gold(spark, paths, *_dimensions(spark))
    trend = marts.trend_by_month(built.fact_ratings, built.dim_date).collect()
    assert [(r["year"], r["month"], r["total_ratings"]) for r in trend] == [(2023, 11, 1), (0, 0, 1)]
    assert built.check().where("table_name = 'dim_date' AND bad_rows > 0").isEmpty()


def _dimensions(spark):
    items = spark.createDataFrame(
        [(m, f"t{m}", "g", 2000) for m in range(1, 5)],
        "movie_id int, title string, genre string, release_year int",
    )
    profiles = spark.createDataFrame(
        [(u, f"u{u}", 30, "F", "here", "Basic") for u in range(1, 5)],
        "user_id int, username string, age int, gender string, location string, subscription_tier string",
    )
    return items, profiles


def test_cycles(lake, spark, ratings, tmp_path):
    paths = cycle.Paths(
        lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recommendations")
    )
    loaded = []
    since = None
    for wave in WAVES:
        lake.publish(ratings(wave))
        lake.ingest()
        report = cycle.run_cycle(
            spark, paths, *_dimensions(spark), since=since, load=loaded.append, user_blocks=1, item_blocks=1
        )
        since = report.version
    assert since == 2 and len(loaded) == 3
    star = cycle.read_gold(spark, paths)
    assert star.fact_ratings.count() == read_silver(spark, paths.silver).count() == 5
    assert star.dim_date.count() == 4  # three days, and that of a time beyond any
    assert read_recommendations(spark, paths.recommendations).count() == 4
    kept = {path.name for path in (tmp_path / "recommendations").iterdir()}
    assert kept == {"edition=1", "edition=2", "model", "trial-model"}


def test_stream_with_a_cycle_per_batch(lake, spark, ratings, tmp_path):
    paths = cycle.Paths(lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recs"))
    for wave in WAVES:
        lake.publish(ratings(wave).coalesce(1))
    stream = read_event_stream(
        spark, "text", {"path": lake.incoming, "maxFilesPerTrigger": "1"}
    )
    write_and_refresh(
        parse_events(stream),
        paths,
        *_dimensions(spark),
        lake.checkpoint,
        {"availableNow": True},
        user_blocks=1,
        item_blocks=1,
    ).awaitTermination()
    assert lake.versions() == [0, 1, 2]
    assert rows(read_silver(spark, paths.silver)) == rows(
        clean_ratings(read_bronze(spark, lake.bronze))
    )
    assert (tmp_path / "recs" / "edition=2" / "_SUCCESS").exists()


def test_cycle_over_unusable_events_skips_the_model(lake, spark, tmp_path):
    publish_events(spark.createDataFrame([("junk",)], "value string"), "text", {"path": lake.incoming})
    lake.ingest()
    paths = cycle.Paths(lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recs"))
    report = cycle.run_cycle(spark, paths, *_dimensions(spark))
    assert report == cycle.Report(0, None, None, 10, 10)


def test_cycle_without_events_is_an_error(lake, spark, tmp_path):
    paths = cycle.Paths(lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recs"))
    with pytest.raises(ValueError):
        cycle.run_cycle(spark, paths, *_dimensions(spark))


def test_failed_step_ends_the_cycle(lake, spark, ratings, tmp_path):
    lake.publish(ratings(WAVES[0]))
    lake.ingest()
    paths = cycle.Paths(lake.bronze, lake.silver, str(tmp_path / "gold"), str(tmp_path / "recs"))

    def broken(star):
        raise RuntimeError("warehouse is down")

    with pytest.raises(RuntimeError):
        cycle.run_cycle(spark, paths, *_dimensions(spark), load=broken)
    with pytest.raises(FileNotFoundError):
        read_recommendations(spark, paths.recommendations)


def test_fresh_folders_follow_the_session_setting(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None)
    folder = fresh_folder(spark, "x")
    assert folder != fresh_folder(spark, "x")
    assert setting is None or folder.startswith(setting)
