"""One rule for any share of labelled documents."""

import pytest
from pyspark.sql import functions as F

from ratemill.llm import quality

GOOD = {i: f"The river number {i} runs slowly, and people of the town walk along it." for i in range(40)}
BAD = {i: f"$$ {i} ## BUY!! now!! now!! {i}{i} ||| <<>>" for i in range(40, 80)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*GOOD.items(), *BAD.items()], "doc_id long, text string")


def kept(spark, docs, labelled):
    labels = spark.createDataFrame([(i, int(i in GOOD)) for i in labelled], "doc_id long, quality int")
    return {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}


def test_no_labels_reject_nothing(spark, docs):
    assert kept(spark, docs, []) == {*GOOD, *BAD}


def test_too_few_labels_reject_nothing(spark, docs):
    assert kept(spark, docs, range(quality.LEAST_ROWS - 1)) == {*GOOD, *BAD}


@pytest.mark.parametrize(
    "labelled",
    [range(0, 80, 2), set(range(80)) - {3}, set(range(80)) - {43}, set(range(80)) - {3, 43}, range(80)],
    ids=["half", "all but a good one", "all but a bad one", "all but two", "all"],
)
def test_good_documents_stay_at_any_coverage(spark, docs, labelled):
    assert kept(spark, docs, labelled) == set(GOOD)


def test_a_labelled_document_is_in_both_samples(spark, docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    outside = docs.where(quality.fold_of(F.col("doc_id")) != 0)
    positive, mixture = outside.select("doc_id").limit(5), outside.select("doc_id")
    trusted, mixed = quality._measured(docs, positive, mixture, "text", "doc_id")
    assert len(trusted) == 5 and len(mixed) == outside.count()
    assert quality.learn(docs, labels).prior > 0.5
