"""From raw documents to token ids, in five stages.

Each stage takes (session, documents, folder of the tables) and works on all that the
one before it kept; all but the last return the columns of documents. ``run`` writes
every stage's result to the shared folder and reads it again for the next.

Null and empty texts go through all stages (near duplicates leave one of them), rows
without a doc_id too; repeated rows are near duplicates of each other. An empty table
gives no rows, missing labels or benchmark items remove nothing.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratemill.llm import bpe, decontaminate, lines, quality, simhash
from ratemill.llm.queries import vocabulary
from ratemill.llm.tables import read, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on them, does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three-line passages; n_chars follows the text."""
    shorter = lines.deduplicate(docs)
    if "n_chars" not in docs.columns:
        return shorter
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return shorter.withColumn("n_chars", n_chars)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one_of_each(docs, shingle_words=3, max_bits=3)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document and of the text they decode to."""
    return bpe.token_digests(docs, vocabulary())


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontaminate", without_benchmarks),
    ("bpe", token_ids),
]

#: No SQL: two stages hold a trained model and a hash that DuckDB lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
