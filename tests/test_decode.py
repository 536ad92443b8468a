import json

import pytest

from ratemill.operators.decode import encode_events, parse_events
from ratemill.schemas import EVENT

GOOD = '{"user_id": 1, "movie_id": 2, "rating": 4.5, "timestamp": 1700000000}'
NOTHING = (None, None, None, None)

CASES = {
    GOOD: (1, 2, 4.5, 1700000000),
    GOOD.replace("4.5", "5"): (1, 2, 5.0, 1700000000),
    "not json": NOTHING,
    GOOD[:12]: NOTHING,
    GOOD[:-1]: NOTHING,
    "{}": NOTHING,
    "null": NOTHING,
    "": NOTHING,
    '{"user_id": 1, "movie_id": 2, "timestamp": 3}': (1, 2, None, 3),
    GOOD.replace("1,", '"1",', 1): (None, 2, 4.5, 1700000000),
    GOOD.replace("1,", "99999999999,", 1): (None, 2, 4.5, 1700000000),
    GOOD.replace("1,", "1.5,", 1): (None, 2, 4.5, 1700000000),
    GOOD.replace("1700000000", "1.7e9"): (1, 2, 4.5, None),
    GOOD.replace("{", '{"extra": [1], '): (1, 2, 4.5, 1700000000),
    f"[{GOOD}]": NOTHING,
}


@pytest.mark.parametrize("text", CASES)
def test_parse(spark, text):
    messages = spark.createDataFrame([(text,)], "value string")
    assert [tuple(row) for row in parse_events(messages).collect()] == [CASES[text]]


def test_parse_null_message(spark):
    messages = spark.createDataFrame([(None,)], "value string")
    assert [tuple(row) for row in parse_events(messages).collect()] == [NOTHING]


def test_parse_nan_token(spark):
    messages = spark.createDataFrame([(GOOD.replace("4.5", "NaN"),)], "value string")
    (row,) = parse_events(messages).collect()
    assert row["rating"] != row["rating"]


def test_parse_bytes_and_schema(spark):
    messages = spark.createDataFrame([(bytearray(GOOD.encode()),)], "value binary")
    events = parse_events(messages)
    assert events.schema == EVENT
    assert tuple(events.first()) == CASES[GOOD]


def test_later_filters_do_not_decode_again(spark):
    messages = spark.createDataFrame([(GOOD,)], "value string")
    plan = parse_events(messages).where("user_id > 0 AND rating > 1")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_encode_round_trip(spark, ratings):
    rows = [(1, 2, 4.5, 1700000000), (-3, 4, 0.0, 0)]
    messages = encode_events(ratings(rows))
    assert json.loads(messages.first()["value"]) == json.loads(GOOD)
    assert sorted(tuple(row) for row in parse_events(messages).collect()) == sorted(rows)
