"""Joins of many rows with a dimension, safe for hot keys and large dimensions."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from ratemill.operators.parts import spread
from ratemill.sources.statistics import stored_size

# What a row takes in a broadcast table besides its values.
ROW_BYTES = 48


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is below the session's broadcast threshold in memory.

    The bound is rows times width and the bytes of all texts. Both are known, without a
    job, of a table that was written with its counts (``sources.statistics``). Otherwise
    rows are counted first, which for a written table reads file footers only; texts are
    measured where that does not rule the table out. Bytes on disk bound neither: five
    million ids may take 140 kB there. Pass written tables.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    width = ROW_BYTES + 8 * len(df.columns)
    stored = stored_size(df)
    if stored:
        rows, text_bytes = stored
        return rows * width + text_bytes <= limit
    bound = df.count() * width
    if bound > limit:
        return False
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not texts:
        return True
    lengths = [F.coalesce(F.sum(F.octet_length(name)), F.lit(0)) for name in texts]
    return bound + sum(df.agg(*[n.alias(f"n{i}") for i, n in enumerate(lengths)]).first()) <= limit


def join_dimension(rows: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join ``rows`` with ``dimension`` on ``key`` (inner or left).

    A dimension within the threshold is broadcast. A larger one is shuffled, by a hint,
    because Spark's own estimate goes by bytes on disk; AQE then splits the partition of
    a hot key, as the dimension has one row per key.
    """
    hint = "broadcast" if fits_broadcast(dimension) else "merge"
    return rows.join(dimension.hint(hint), key, how)


@dataclass(frozen=True)
class Dimension:
    """A dimension table, the key facts refer to it by, and wanted attributes."""

    table: DataFrame
    key: str
    attributes: tuple[str, ...]

    def narrow(self) -> DataFrame:
        return self.table.select(self.key, *self.attributes)


def rating_totals(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Sum and count of ratings per combination of dimension attributes.

    ``fact`` holds facts, or partial totals of them per the dimensions' keys
    (``rating_sum``, ``rating_count``). Same result as joining every fact row and grouping at the end, with the
    facts collapsed early. With several dimensions, those within the broadcast
    threshold join row by row without a shuffle. Facts are then added up per
    key of the rest, with a map-side combine, so that a hot key no longer
    matters and a shuffled join sees partial sums only. A large key with others may
    differ for most facts: many facts, where their number is stored, are then dealt by
    all of them first (``parts.spread``, which spreads a hot key), so that no task holds
    sums for too many, and their sums by the key of the first join.
    """
    small = [d for d in dimensions if len(dimensions) > 1 and fits_broadcast(d.narrow())]
    large = [d for d in dimensions if d not in small]

    added = {"rating_sum": F.sum("rating"), "rating_count": F.count("rating")}
    if "rating_count" in fact.columns:
        added = {name: F.sum(name) for name in added}
    values = ["rating"] if "rating" in fact.columns else list(added)
    rows = fact.select(*{d.key: None for d in dimensions}, *values)
    known: list[str] = []
    for dimension in small:
        rows = rows.join(F.broadcast(dimension.narrow()), dimension.key)
        known += dimension.attributes
    open_keys = [d.key for d in large]
    stored = stored_size(fact) if large and len(dimensions) > 1 else None
    n_facts = stored and stored[0]
    rows = spread(rows, n_facts, *known, *open_keys)
    totals = rows.groupBy(*known, *open_keys).agg(*[total.alias(name) for name, total in added.items()])
    for dimension in large:
        if dimension is large[0]:
            totals = spread(totals, n_facts, dimension.key)
        open_keys.remove(dimension.key)
        totals = join_dimension(totals, dimension.narrow(), dimension.key)
        known += dimension.attributes
        totals = totals.groupBy(*known, *open_keys).agg(
            F.sum("rating_sum").alias("rating_sum"),
            F.sum("rating_count").alias("rating_count"),
        )
    return totals
