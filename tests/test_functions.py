import datetime

import pytest
from pyspark.sql import functions as F

from ratemill.functions import calendar, hashing, numbers


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert value(spark, calendar.date_id(F.lit(1704067207))) == 20240101
        assert value(spark, calendar.date_id(F.lit(1704067199))) == 20231231
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "seconds, expected",
    [
        (0, 19700101),
        (-1, 19691231),
        (951782400, 20000229),
        (calendar.FIRST_SECOND, 10000101),
        (calendar.LAST_SECOND, 99991231),
        (calendar.FIRST_SECOND - 1, calendar.UNKNOWN_DATE),
        (calendar.LAST_SECOND + 1, calendar.UNKNOWN_DATE),
        (9223372036854775807, calendar.UNKNOWN_DATE),
        (-9223372036854775808, calendar.UNKNOWN_DATE),
        (None, None),
    ],
)
def test_date_range(spark, seconds, expected):
    column = F.lit(seconds).cast("bigint")
    assert value(spark, calendar.date_id(column)) == expected
    day = value(spark, calendar.utc_date(column))
    known = expected or None  # the unknown date is no day
    assert day == (known and datetime.datetime.strptime(str(expected), "%Y%m%d").date())


def test_date_parts(spark):
    key = F.lit(20240229)
    parts = (calendar.year_of(key), calendar.month_of(key), calendar.day_of(key))
    assert [value(spark, part) for part in parts] == [2024, 2, 29]


@pytest.mark.parametrize(
    "rating, percent",
    [(5.0, 100), (5.01, 100), (5.05, 99), (9.0, 99), (0.0, 0), (-1.0, -20), (4.6081, 92),
     (1e300, 99), (-1e300, None), (None, None)],
)
def test_match_percent(spark, rating, percent):
    assert value(spark, numbers.match_percent(F.lit(rating).cast("double"))) == percent


@pytest.mark.parametrize("number, digits, expected", [(3.005, 2, 3.01), (2.25, 1, 2.3), (-2.25, 1, -2.3)])
def test_round_half_up(spark, number, digits, expected):
    assert value(spark, numbers.round_half_up(F.lit(number), digits)) == expected


def test_mean_of_nothing_is_null(spark):
    assert value(spark, numbers.mean(F.lit(None).cast("double"), F.lit(0), 2)) is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("10", 10), (" 10 ", 10), ("+5", 5), ("-5", -5), ("007", 7),
        ("10.9", None), ("1e3", None), ("abc", None), ("", None), ("99999999999", None), (None, None),
    ],
)
def test_ids(spark, text, expected):
    assert value(spark, numbers.to_id(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("4", 4.0), (" 4.5 ", 4.5), ("1e1", 10.0), (".5", 0.5), ("5.", 5.0), ("-1", -1.0),
        ("nan", None), ("inf", None), ("-Infinity", None), ("1e999", None), ("4d", None),
        ("4f", None), ("0x1p3", None), ("", None), (None, None),
    ],
)
def test_rating_text(spark, text, expected):
    assert value(spark, numbers.to_rating(F.lit(text).cast("string"))) == expected


def test_hash_share(spark):
    share = (
        spark.range(100000)
        .select(F.avg((hashing.unit_hash("id") < hashing.hash_bound(0.8)).cast("int")).alias("x"))
        .first()["x"]
    )
    assert abs(share - 0.8) < 0.01
    for impossible in (-0.1, 0.0, 1e-12, 1 - 1e-12, 1.0, 1.5):
        with pytest.raises(ValueError):
            hashing.hash_bound(impossible)
