import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ratemill.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(name="ratemill tests")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture
def no_broadcast(spark):
    """Every dimension counts as too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="session")
def ratings(spark):
    """Builds a frame of (user, item, rating, seconds) tuples."""
    from ratemill.schemas import EVENT

    return lambda rows: spark.createDataFrame(rows, EVENT)
