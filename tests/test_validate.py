import time

import pytest

from ratemill.operators.validate import accepted, parse_submissions, rejected, validate_submissions

SCHEMA = "user_id string, movie_id string, rating string"


@pytest.mark.parametrize(
    "body, expected",
    [
        (("1", "2", "4"), (1, 2, 4.0, None)),
        ((" 10 ", "2", "4"), (10, 2, 4.0, None)),
        ((None, "2", "4"), (None, 2, 4.0, "missing_user_id")),
        (("1", "10.9", "4"), (1, None, 4.0, "invalid_movie_id")),
        (("1", "2", "nan"), (1, 2, None, "invalid_rating")),
        (("1", "2", "inf"), (1, 2, None, "invalid_rating")),
        (("1", "2", "-7.5"), (1, 2, -7.5, None)),
        (("abc", None, None), (None, None, None, "invalid_user_id")),
    ],
)
def test_reasons(spark, body, expected):
    checked = validate_submissions(spark.createDataFrame([body], SCHEMA))
    row = checked.drop("timestamp").first()
    assert tuple(row) == expected
    assert accepted(checked).count() == (expected[3] is None)
    assert rejected(checked).count() == (expected[3] is not None)


def test_rating_range_is_an_option(spark):
    df = spark.createDataFrame([("1", "2", "6")], SCHEMA)
    assert validate_submissions(df).first()["reason"] is None
    assert validate_submissions(df, rating_range=(1, 5)).first()["reason"] == "invalid_rating"


def test_time_is_stamped_or_given(spark):
    df = spark.createDataFrame([("1", "2", "6", 99)], SCHEMA + ", at int")
    assert validate_submissions(df, time_column="at").first()["timestamp"] == 99
    assert abs(validate_submissions(df).first()["timestamp"] - time.time()) < 60


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"user_id": 10.9, "movie_id": "3", "rating": 4}', (10, 3, 4.0, None)),
        ('{"user_id": -10.9, "movie_id": "3", "rating": 4}', (-10, 3, 4.0, None)),
        ('{"user_id": "10.9", "movie_id": 3, "rating": 4}', (None, 3, 4.0, "invalid_user_id")),
        ('{"user_id": 1, "movie_id": 3, "rating": null}', (1, 3, None, "missing_rating")),
        ('{"user_id": 1, "movie_id": 99999999999, "rating": "5"}', (1, None, 5.0, "invalid_movie_id")),
        ('{"user_id": 1, "rating": "5"}', (1, None, 5.0, "missing_movie_id")),
        ('{"user_id": [1], "movie_id": 1, "rating": "5"}', (None, 1, 5.0, "invalid_user_id")),
        ("garbage", (None, None, None, "missing_user_id")),
    ],
)
def test_json_bodies(spark, body, expected):
    bodies = spark.createDataFrame([(body,)], "value string")
    row = validate_submissions(parse_submissions(bodies)).drop("timestamp").first()
    assert tuple(row) == expected
