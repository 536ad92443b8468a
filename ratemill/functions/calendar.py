"""Dates of Unix seconds, in UTC whatever the session time zone is."""

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400

# Years 1000 to 9999, where yyyyMMdd has eight digits.
FIRST_SECOND = -30610224000
LAST_SECOND = 253402300799

# The date key of a time outside those years, year, month and day 0: such a fact
# has an unknown date, and still counts.
UNKNOWN_DATE = 0


def has_date(seconds: Column) -> Column:
    """Whether a Unix time falls in the years 1000 to 9999."""
    return seconds.between(FIRST_SECOND, LAST_SECOND)


def utc_date(seconds: Column) -> Column:
    """Date of a Unix time in seconds; NULL outside the years 1000 to 9999.

    Plain day arithmetic: no time zone is read, and a garbage value cannot
    overflow because the range is tested first.
    """
    days = F.floor(seconds / SECONDS_PER_DAY).cast("int")
    return F.when(has_date(seconds), F.date_from_unix_date(days))


def date_id(seconds: Column) -> Column:
    """The date as an integer yyyyMMdd; ``UNKNOWN_DATE`` outside the years 1000 to 9999.

    NULL for a NULL time.

    Arithmetic on the calendar fields, several times faster than formatting
    the date as text and parsing that.
    """
    day = F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))
    known = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(has_date(seconds), known).when(seconds.isNotNull(), UNKNOWN_DATE)


def year_of(date_key: Column) -> Column:
    return F.floor(date_key / 10000).cast("int")


def month_of(date_key: Column) -> Column:
    return (F.floor(date_key / 100) % 100).cast("int")


def day_of(date_key: Column) -> Column:
    return (date_key % 100).cast("int")
