import pytest
from conftest import SF_DIR

from ratemill import jobs
from ratemill.plans import fixtures
from ratemill.plans.silver import read_silver
from ratemill.sources import storage
from ratemill.sources.bronze import read_bronze
from ratemill.sources.documents import read_recommendations
from ratemill.sources.tables import overwrite_table

BODIES = [
    '{"user_id": "1", "movie_id": 3, "rating": "5"}',
    '{"user_id": "2", "movie_id": 4.9, "rating": 2}',
    '{"user_id": "2", "movie_id": 3, "rating": "1.5"}',
    '{"user_id": "x", "movie_id": 3, "rating": "5"}',
]


def test_jobs_in_order(spark, tmp_path, capsys):
    def at(name):
        return [f"--{name}", str(tmp_path / name)]

    spark.createDataFrame([(b,) for b in BODIES], "value string").write.text(at("bodies")[1])
    overwrite_table(fixtures.items(spark, SF_DIR), at("items")[1])
    overwrite_table(fixtures.profiles(spark, SF_DIR), at("profiles")[1])
    topic = ["--format", "text", "--option", f"path={tmp_path / 'topic'}"]

    submit = ["submit", *topic, *at("bodies"), *at("rejects"), "--batch"]
    jobs.main([*submit, "one"])
    (reject,) = spark.read.json(at("rejects")[1]).collect()
    assert reject["reason"] == "invalid_user_id"

    jobs.main(["ingest", *topic, *at("bronze"), *at("checkpoint")])
    assert read_bronze(spark, at("bronze")[1]).count() == 3

    jobs.main(["silver", *at("bronze"), *at("silver")])
    jobs.main(["gold", *at("silver"), *at("gold"), *at("items"), *at("profiles")])
    jobs.main(["train", *at("silver"), *at("recommendations")])
    assert "Silver holds version 0" in capsys.readouterr().out
    assert read_recommendations(spark, at("recommendations")[1]).count() == 2

    jobs.main([*submit, "one"])  # a retry: the same events, and no second reject
    jobs.main([*submit, "two"])
    assert spark.read.json(at("rejects")[1]).count() == 2
    jobs.main(["ingest", *topic, *at("bronze"), *at("checkpoint")])
    everything = ["bronze", "silver", "gold", "recommendations", "items", "profiles"]
    blocks = ["--user-blocks", "2", "--item-blocks", "3", "--pruned"]
    jobs.main(["cycle", *[word for name in everything for word in at(name)], "--since", "0", *blocks])
    shown = capsys.readouterr().out
    assert "version=1" in shown and "user_blocks=2, item_blocks=3" in shown

    assert read_silver(spark, at("silver")[1]).count() <= 6 < read_bronze(spark, at("bronze")[1]).count()

    for name in sorted(jobs.REPORTS):
        jobs.main(["report", name, *at("silver"), *at("gold"), *at("out")])
    jobs.main(["compact", *at("bronze")])
    jobs.main(["merge", *at("silver")])
    jobs.main(["snapshot", *at("bronze")])
    jobs.main(["lookup", *at("recommendations"), "--user-id", "2"])
    shown = capsys.readouterr().out
    assert "average_rating" in shown and "orphan_fact" in shown and "recommendations" in shown


def test_what_is_not_shown_is_said(spark, capsys):
    jobs._show(spark.range(jobs.SHOWN))
    assert "more rows" not in capsys.readouterr().out
    jobs._show(spark.range(jobs.SHOWN + 3))
    assert "3 more rows are not shown" in capsys.readouterr().out


def test_unknown_report_is_refused():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["report", "nothing", "--silver", "s", "--gold", "g", "--out", "o"])


class Cluster:
    """Just enough of a session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "yarn"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(monkeypatch, master):
    monkeypatch.setattr(Cluster.sparkContext, "master", master)
    with pytest.raises(ValueError):
        storage.shared_folder(Cluster)
