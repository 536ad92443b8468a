"""What the operators share: safe column names, row keys, tables written once."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratemill.sources.storage import fresh_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores in front until no column of ``df`` has them."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        found.append(name)
    return found


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names have."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all executors share, and read again.

    What reads it does not depend on the executors that made it. The folder has
    a name of its own and stays until the owner of the shared folder removes it.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_plain_read(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of a file, in every read again: a table,
    or columns and filtered rows of one, and no join, explode, limit or sample."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation") or node.nodeName().startswith("Relation")


def with_row_key(docs: DataFrame, file: str, row: str) -> DataFrame:
    """``docs`` with two numbers that tell its rows apart, in any later read too.

    A table read from Parquet files has them: the file and the position in it,
    which do not depend on how tasks split the files. Anything else is written
    first, as numbers given while it is computed can differ the next time.
    """
    for table in (docs, None):
        if table is None:
            table = written(docs, "rows")
        elif not _is_plain_read(table):
            continue
        try:
            where = table.metadataColumn("_metadata")
            return table.select(
                "*",
                F.xxhash64(where.getField("file_path")).alias(file),
                where.getField("row_index").alias(row),
            )
        except AnalysisException:
            continue
    raise ValueError("the shared folder does not keep Parquet row positions")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def digest_of(parts: Column) -> Column:
    """Lowercase SHA-256 of an array of strings joined by commas."""
    return F.sha2(F.array_join(parts, ","), 256)
