"""What a table takes in memory, counted by the job that writes it.

Rows, and bytes of texts per column, are stored beside the files together with the
schema, and go to readers in the metadata of the columns. A reader then knows them
without a job of its own. A task that runs again can be counted twice, so they are upper
bounds, which is what a size check needs.
"""

import json

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ratemill.sources.storage import create_once, exists, read_text
from ratemill.sources.tables import overwrite_table, read_table

#: Beside the files; what starts with an underscore is no data to Spark.
FILE = "_statistics"
ROWS, TEXT_BYTES = "ratemill.rows", "ratemill.text_bytes"
#: Formats that take a schema from the reader, and so need no job to find it.
WITH_SCHEMA = ("parquet", "orc", "json", "csv")
# Plan nodes that add neither rows nor, by themselves, bytes.
_NARROWING = ("Project", "Filter", "SubqueryAlias")


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table to a new folder, and what it holds beside it."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    seen = Observation()
    sums = [F.sum(F.octet_length(name)).alias(f"bytes_{i}") for i, name in enumerate(texts)]
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), path, fmt)
    found = seen.get
    text_bytes = {name: found[f"bytes_{i}"] or 0 for i, name in enumerate(texts)}
    stored = {"schema": df.schema.jsonValue(), "rows": found["rows"], "text_bytes": text_bytes}
    create_once(df.sparkSession, f"{path}/{FILE}", json.dumps(stored))


def read_counted(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table, with its counts where it was written with them."""
    if not exists(spark, f"{path}/{FILE}"):
        return read_table(spark, path, fmt)
    stored = json.loads(read_text(spark, f"{path}/{FILE}"))
    metadata = {
        name: {ROWS: stored["rows"], TEXT_BYTES: stored["text_bytes"].get(name, 0)}
        for name in StructType.fromJson(stored["schema"]).fieldNames()
    }
    if fmt in WITH_SCHEMA:
        schema = StructType.fromJson(stored["schema"])
        for field in schema.fields:
            field.metadata = {**field.metadata, **metadata[field.name]}
        return spark.read.format(fmt).schema(schema).load(path)
    table = read_table(spark, path, fmt)
    for name, counts in metadata.items():
        table = table.withMetadata(name, counts)
    return table


def stored_size(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes of texts) that ``df`` has at most, or None where that is not known.

    Known it is of columns and filtered rows of one counted table, and of nothing that a
    join, a generator or an expression made of it.
    """
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in _NARROWING:
        node = node.children().head()
    counts = [field.metadata for field in df.schema.fields]
    if node.children().size() or not counts or any(ROWS not in c for c in counts):
        return None
    return max(c[ROWS] for c in counts), sum(c[TEXT_BYTES] for c in counts)
