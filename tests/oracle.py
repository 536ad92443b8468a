"""Compare a Spark result with DuckDB on the same parquet tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql):
    """Difference of the two results as text; empty when they are equal."""
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    only_ours, only_theirs = ours - theirs, theirs - ours
    if only_ours or only_theirs:
        return f"only Spark {list(only_ours)[:3]}, only SQL {list(only_theirs)[:3]}"
    return ""
