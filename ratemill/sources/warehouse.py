"""The star schema in a relational warehouse, over JDBC, or as SQL views."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


STAGING = "_staging"
#: Which version of the lake each merged table holds; kept in the warehouse itself.
LOADS = "ratemill_loads"


@dataclass(frozen=True)
class Exactly:
    """A statement that has to change so many rows, or the transaction is undone."""

    sql: str
    rows: int


def write_warehouse(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    keys: Mapping[str, Sequence[str]] | None = None,
    versions: Mapping[str, int] | None = None,
) -> dict[str, int]:
    """Replace one warehouse table per entry, all of them at once.

    Every table is loaded into ``<name>_staging`` and its rows are counted on both
    sides, because a task that is run again after it committed would leave its rows
    twice; a difference is an error, and the live tables are as before. Then one
    transaction drops the live tables, in reverse, and renames the staged ones, with
    the primary keys in ``keys``. List dimensions before facts. ``properties`` go to
    the JDBC driver (``numPartitions`` bounds the writer's connections). Pass written
    tables, whose count is in their file footers. ``versions`` of tables that
    ``merge_warehouse`` will bring up to date are noted with the swap. Returns the rows
    per table.
    """
    written = _stage(tables, url, properties)
    if tables:
        session = next(iter(tables.values())).sparkSession
        noted = note_statements(versions) if versions else []
        run_in_transaction(session, url, properties, [*swap_statements(list(tables), keys or {}), *noted])
    return written


def merge_warehouse(
    tables: Mapping[str, DataFrame],
    name: str,
    changes: DataFrame,
    match: Sequence[str],
    url: str,
    properties: Mapping[str, str],
    keys: Mapping[str, Sequence[str]] | None = None,
    *,
    since: int,
    version: int,
) -> dict[str, int]:
    """Replace ``tables`` and bring the table ``name`` from version ``since`` to ``version``.

    ``changes`` holds all rows that the table shall have for the values of ``match``
    that occur in it; rows with other values stay. Only those are sent. They are staged
    and counted like the rest; then one transaction swaps ``tables``, deletes and inserts,
    and notes the version. It is undone if the warehouse does not hold ``since``, so
    that neither a second loader nor a repeated load can mix versions; a load that failed
    is repeated as it is. Columns of ``match`` must not be null.
    """
    session = changes.sparkSession
    written = _stage({**tables, name: changes}, url, properties)
    statements = [
        Exactly(f"UPDATE {LOADS} SET version = {version} WHERE table_name = '{name}' AND version = {since}", 1),
        *swap_statements(list(tables), keys or {}),
        *merge_statements(name, changes.columns, match, written[name]),
    ]
    run_in_transaction(session, url, properties, statements)
    return written


def _stage(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str]) -> dict[str, int]:
    written = {}
    for name, table in tables.items():
        staged = f"{name}{STAGING}"
        table.write.jdbc(url, staged, mode="overwrite", properties=dict(properties))
        count = f"(SELECT COUNT(*) AS n FROM {staged}) counted"
        stored = int(read_warehouse(table.sparkSession, url, count, properties).first()[0])
        sent = table.count()
        if stored != sent:
            raise RuntimeError(f"{name}: {sent} rows sent, {stored} stored")
        written[name] = stored
    return written


def swap_statements(names: Sequence[str], keys: Mapping[str, Sequence[str]]) -> list[str]:
    """SQL that puts staged tables in the place of live ones."""
    dropped = [f"DROP TABLE IF EXISTS {name}" for name in reversed(names)]
    renamed = [f"ALTER TABLE {name}{STAGING} RENAME TO {name}" for name in names]
    keyed = [f"ALTER TABLE {name} ADD PRIMARY KEY ({', '.join(keys[name])})" for name in names if name in keys]
    return [*dropped, *renamed, *keyed]


def merge_statements(name: str, columns: Sequence[str], match: Sequence[str], rows: int) -> list[str | Exactly]:
    """SQL that puts staged rows in the place of those with the same values of ``match``."""
    same = " AND ".join(f"staged.{column} = {name}.{column}" for column in match)
    listed = ", ".join(columns)
    return [
        f"DELETE FROM {name} WHERE EXISTS (SELECT 1 FROM {name}{STAGING} staged WHERE {same})",
        Exactly(f"INSERT INTO {name} ({listed}) SELECT {listed} FROM {name}{STAGING}", rows),
        f"DROP TABLE {name}{STAGING}",
    ]


def note_statements(versions: Mapping[str, int]) -> list[str]:
    """SQL that notes the versions of tables that were replaced whole."""
    created = f"CREATE TABLE IF NOT EXISTS {LOADS} (table_name VARCHAR(200) PRIMARY KEY, version BIGINT)"
    noted = [
        statement
        for name, version in versions.items()
        for statement in (
            f"DELETE FROM {LOADS} WHERE table_name = '{name}'",
            f"INSERT INTO {LOADS} (table_name, version) VALUES ('{name}', {version})",
        )
    ]
    return [created, *noted]


def loaded_version(spark: SparkSession, url: str, properties: Mapping[str, str], name: str) -> int | None:
    """The version that ``write_warehouse`` or ``merge_warehouse`` noted last; None if
    the table was never noted. The table of notes has to exist."""
    query = f"(SELECT version FROM {LOADS} WHERE table_name = '{name}') noted"
    found = read_warehouse(spark, url, query, properties).first()
    return None if found is None else int(found[0])


def run_in_transaction(
    spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str | Exactly]
) -> None:
    """Execute SQL over one JDBC connection of the driver, all of it or nothing."""
    login = spark._jvm.java.util.Properties()
    for name, value in properties.items():
        login.setProperty(name, str(value))
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            if isinstance(statement, Exactly):
                changed = connection.createStatement().executeUpdate(statement.sql)
                if changed != statement.rows:
                    raise RuntimeError(f"{changed} rows instead of {statement.rows}: {statement.sql}")
            else:
                connection.createStatement().execute(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def read_warehouse(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str]
) -> DataFrame:
    """A warehouse table, or a query in parentheses with an alias.

    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    among the properties split a large table over tasks.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the star schema answer ``spark.sql`` under its table names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
