"""Tables that grow by runs and are merged on read.

A change of the table adds a run: a folder with the rows of the change, at most one per
key. What holds of a key is what its rows of all runs add up to, by an aggregate that
does not depend on their order. Reading merges the runs; a step beside it writes runs of
like size as one, so that a row is written again once for each size, not for each change.
Runs are parts of commits, several kinds of them in one table: a change is seen whole.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ratemill.sources import commits
from ratemill.sources.commits import Commit, Conflict, Part, new_folder, newest
from ratemill.sources.storage import remove

#: Runs of like size that are merged, and rows up to which runs count as of like size.
FAN, SMALL = 8, 100_000
#: Commits after which a run goes that was merged or replaced; stated to readers.
KEEP = 10


@dataclass(frozen=True)
class Kind:
    """Rows of a table: their key, and how several rows of a key become one."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    merge: Callable[[str], Column]

    @property
    def values(self) -> list[str]:
        return [name for name in self.schema.fieldNames() if name not in self.key]

    def merged(self, rows: DataFrame) -> DataFrame:
        sums = [self.merge(name).alias(name) for name in self.values]
        return rows.groupBy(*self.key).agg(*sums).select(*self.schema.fieldNames())


def read_runs(spark: SparkSession, path: str, runs: list[Part], kind: Kind, fmt: str = "parquet") -> DataFrame:
    """The rows of runs as they are, several for a key where several runs have it."""
    if not runs:
        return spark.createDataFrame([], kind.schema)
    reader = spark.read.format(fmt).schema(kind.schema)
    if fmt == "parquet":
        return reader.load([f"{path}/{run.folder}" for run in runs])
    rows = None
    for run in runs:
        one = reader.load(f"{path}/{run.folder}")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def read_kind(spark: SparkSession, path: str, now: Commit, kind: Kind, fmt: str = "parquet") -> DataFrame:
    """One row per key; a single run has no key twice, so it is read as it is."""
    runs = now.of(kind.name)
    rows = read_runs(spark, path, runs, kind, fmt)
    return rows if len(runs) < 2 else kind.merged(rows)


def write_run(
    rows: DataFrame, path: str, now: Commit, kind: Kind, span: tuple[int, int], fmt: str = "parquet"
) -> Part:
    """A run in a folder that nobody reads until it is committed."""
    folder, seen = new_folder(now), Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.format(fmt).save(f"{path}/{folder}")
    return Part(folder, *span, rows=seen.get["rows"], kind=kind.name)


def _size(run: Part, fan: int, small: int) -> int:
    return max(0, math.floor(math.log(max(run.rows, 1) / small, fan)) + 1)


def merge_runs(
    spark: SparkSession, path: str, kinds: list[Kind], fmt: str = "parquet", fan: int = FAN, small: int = SMALL
) -> int:
    """Merge runs of like size while there are ``fan`` of them; returns how many went.

    It may run beside readers and writers: where another merge or a rebuild was first,
    nothing is changed.
    """
    commits.sweep(spark, path, KEEP)
    gone = 0
    for kind in kinds:
        while True:
            now = newest(spark, path)
            by_size: dict[int, list[Part]] = {}
            for run in now.of(kind.name):
                by_size.setdefault(_size(run, fan, small), []).append(run)
            full = [runs for _, runs in sorted(by_size.items()) if len(runs) >= fan]
            if not full:
                break
            runs = full[0]
            rows = read_runs(spark, path, runs, kind, fmt)
            # Ranges of the key serve the merge too, and let readers skip files; the
            # first column is the one that is asked for by ranges.
            ranged = kind.merged(rows.repartitionByRange(*kind.key)).sortWithinPartitions(*kind.key)
            span = min(run.first for run in runs), max(run.last for run in runs)
            merged = write_run(ranged, path, now, kind, span, fmt)
            try:
                commits.update(spark, path, lambda now: now.replaced(runs, merged), KEEP)
            except Conflict:
                remove(spark, f"{path}/{merged.folder}")
                break
            gone += len(runs) - 1
    return gone
