"""Repeatable row hashes."""

from pyspark.sql import Column, functions as F

HASH_SPACE = 1 << 32


def unit_hash(*columns: Column) -> Column:
    """First eight hex digits of an MD5 over the columns, lower case.

    Fixed-width hex compares as text the way it compares as a number, so a
    share of the rows is a plain string comparison with ``hash_bound``.
    """
    return F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8)


def hash_bound(share: float) -> str:
    """Upper bound, exclusive, that a ``share`` of the hashes lies below."""
    bound = round(share * HASH_SPACE)
    if not 0 < bound < HASH_SPACE:
        raise ValueError("share must lie between 0 and 1")
    return f"{bound:08x}"
