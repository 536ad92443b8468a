"""What each filter removes, in every order in which filters can be applied.

Each filter has a stored table of the ids that fail it. What a filter removes after a
prefix of others is its table without the ids of theirs: a chain of left-anti joins, in
which every row goes on both with and without the next filter before its own, so that
one chain covers all prefixes. Left-semi joins with the ids of good and of toxic
documents give the losses of labels. All joins have the id as key, so failing ids are
shuffled once, and the chain runs in the partitions that they have then.

What holds of a prefix does not depend on the order of its filters, so the orders share
the counts of the prefixes.
"""

import json
from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratemill.llm.tables import with_row_key, written
from ratemill.sources.storage import fresh_folder

_SPACE = r"[\x20\x09-\x0D]+"

Test = Callable[[Column, Column], Column]  # of a text and its words: whether it fails

#: Filters that look at one document, as the audit's contract states them.
TESTS: dict[str, Test] = {
    "A": lambda text, words: F.size(words) < 100,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
    "C": lambda text, words: 100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    > 10 * F.char_length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The filter that a text fails if a smaller id has the same.
REPEATED = "E"

_ID = ["file", "row"]


def failing_ids(
    docs: DataFrame,
    tests: dict[str, Test] = TESTS,
    repeated: str | None = REPEATED,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All rows as (file, row, part, doc_id), and the rows that fail each filter: one
    table in the shared folder per filter. Texts are read once, and none is shuffled.

    A row is known by its place (``file``, ``row``), so repeated ids are rows of their
    own; a null text is empty and a null part the empty string. A row without an id
    neither fails ``repeated`` nor makes others fail it.
    """
    chosen = with_row_key(docs.select(F.col(part).alias("part"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), *_ID)
    body = F.coalesce("text", F.lit(""))
    seen = chosen.select(
        *_ID,
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        "doc_id",
        body.alias("text"),
        F.array_remove(F.split(body, _SPACE), "").alias("words"),
    )
    fails = [F.when(test(F.col("text"), F.col("words")), F.lit(name)) for name, test in tests.items()]
    digest = F.unhex(F.sha2("text", 256)) if repeated else F.lit(None).cast("binary")
    rows = written(
        seen.select(*_ID, "part", "doc_id", digest.alias("digest"), F.array_compact(F.array(*fails)).alias("failed")),
        "audit-rows",
    )
    columns = [*_ID, "part", "doc_id"]
    failing = rows.select(*columns, F.explode("failed").alias("filter"))
    if repeated:
        # The smallest id of a text is told to no row: the rows that are not it are what
        # is left over, so a text that many rows share never meets in one task.
        named = rows.where(F.col("doc_id").isNotNull())
        first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
        later = named.join(first, ["digest", "doc_id"], "left_anti")
        failing = failing.unionByName(later.select(*columns, F.lit(repeated).alias("filter")))
    path = fresh_folder(docs.sparkSession, "llm-audit-ids")
    failing.write.partitionBy("filter").parquet(path)
    spark, schema = docs.sparkSession, failing.schema
    names = [*tests, *([repeated] if repeated else [])]
    stored = spark.read.schema(schema).parquet(path)
    return rows.select(*columns), {n: stored.where(F.col("filter") == n).select(*columns) for n in names}


def prefix_counts(failing: dict[str, DataFrame], good: DataFrame, toxic: DataFrame) -> DataFrame:
    """(part, filter, prefix, removed, good_lost, toxic_lost): what a filter removes after
    the filters whose bits are set in ``prefix``, bit 0 being the first of ``failing``.
    ``good`` and ``toxic`` hold ids, in a column ``doc_id``; nothing removed is no row."""
    tagged = None
    for name, ids in failing.items():
        ids = ids.select("*", F.lit(name).alias("filter"))
        tagged = ids if tagged is None else tagged.unionByName(ids)
    measures = {"removed": tagged}
    for measure, labelled in (("good_lost", good), ("toxic_lost", toxic)):
        measures[measure] = tagged.join(labelled.select("doc_id"), "doc_id", "left_semi")
    state = None
    for measure, ids in measures.items():
        ids = ids.select(*_ID, "part", "filter", F.lit(measure).alias("measure"), F.lit(0).alias("prefix"))
        state = ids if state is None else state.unionByName(ids)
    for bit, (name, ids) in enumerate(failing.items()):
        # With and without this filter before the row's own.
        both, without = F.array(F.lit(0), F.lit(1 << bit)), F.array(F.lit(0))
        state = state.select("*", F.explode(F.when(F.col("filter") == name, without).otherwise(both)).alias("put"))
        gone = ids.select(F.col("file").alias("gone_file"), F.col("row").alias("gone_row"))
        same = (F.col("file") == F.col("gone_file")) & (F.col("row") == F.col("gone_row"))
        state = state.join(gone, same & (F.col("put") != 0), "left_anti").select(
            *_ID, "part", "filter", "measure", (F.col("prefix") + F.col("put")).alias("prefix")
        )
    counts = [F.count_if(F.col("measure") == measure).alias(measure) for measure in measures]
    return state.groupBy("part", "filter", "prefix").agg(*counts)


def orders(names: list[str]) -> list[dict[str, object]]:
    """Every step of every order: the filter it applies and the prefix before it."""
    steps = []
    for order in permutations(range(len(names))):
        prefix = 0
        for step, bit in enumerate(order, 1):
            steps.append(
                {"filter_order": "".join(names[b] for b in order), "step": step, "filter": names[bit], "prefix": prefix}
            )
            prefix |= 1 << bit
    return steps


def audit(
    docs: DataFrame,
    labels: DataFrame,
    tests: dict[str, Test] = TESTS,
    repeated: str | None = REPEATED,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley): one row for each part, order and step.

    ``labels`` has doc_id, quality and toxic; an id with several labels counts as good,
    or toxic, if one of them says so, and null labels say nothing. What rows are is
    stated by ``failing_ids``. An empty table has no parts and gives no rows. Filters
    are at most seven, as their orders are listed.
    """
    names = [*tests, *([repeated] if repeated else [])]
    if len(names) > 7:
        raise ValueError("at most seven filters can be audited in every order")
    rows, failing = failing_ids(docs, tests, repeated, text, doc_id, part)
    good, toxic = (labels.where(F.col(c) == 1).select("doc_id").distinct() for c in ("quality", "toxic"))
    counts = prefix_counts(failing, good, toxic)
    listed = F.from_json(
        F.lit(json.dumps(orders(names))),
        "array<struct<filter_order: string, step: int, filter: string, prefix: int>>",
    )
    totals = rows.groupBy("part").agg(F.count("*").alias("total"))
    grid = totals.select("part", "total", F.inline(listed))
    measures = ("removed", "good_lost", "toxic_lost")
    filled = grid.join(counts, ["part", "filter", "prefix"], "left").fillna(0, measures)
    of_filter, of_order = Window.partitionBy("part", "filter"), Window.partitionBy("part", "filter_order")
    so_far = of_order.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    others = (1 << len(names)) - 1 - sum(
        (F.when(F.col("filter") == name, 1 << bit).otherwise(0) for bit, name in enumerate(names)), F.lit(0)
    )

    def after(prefix: int | Column) -> Column:
        return F.max(F.when(F.col("prefix") == prefix, F.col("removed"))).over(of_filter)

    return filled.select(
        "part",
        "filter_order",
        "step",
        "filter",
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (after(0) - F.col("removed")).alias("redundant"),
        after(others).alias("unique_fails"),
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(of_filter).alias("shapley"),
    )
