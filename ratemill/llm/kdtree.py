"""Exact top-k inner products with a KD-tree per shard of vectors.

Vectors are dealt by a hash to shards of bounded size; a shard's tree splits at the
median of its widest dimension and keeps the tight box of every node. A query goes
through a tree best-first: the box gives the highest inner product any vector in it
can have, the node with the highest is opened next, and the search ends when that is
below the k-th best score so far. That score is propagated: each query first searches
one shard, and its k-th score there is where the search of every other shard starts.

Queries are dealt to blocks of bounded size too; each pair of block and shard is a
group of its own, so neither all queries nor all vectors meet in one task.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratemill.llm.tables import unused, with_row_key, written

SHARD_ROWS = 16384
BLOCK_ROWS = 8192
LEAF_ROWS = 128
#: Whole numbers up to here are exact as doubles.
EXACT = 2**53
FOUND = "q_file long, q_row long, query_id long, vec_id long, c_file long, c_row long, score long"


class Tree:
    """Median splits of whole-number vectors with tight boxes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(vectors))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high, smallest = [], [], []
        open_spans = [(0, len(vectors), None)]
        while open_spans:
            start, end, above = open_spans.pop()
            node, rows = len(self.spans), self.order[start:end]
            box = vectors[rows].min(0), vectors[rows].max(0)
            low.append(box[0])
            high.append(box[1])
            smallest.append(ids[rows].min())
            self.spans.append((start, end))
            self.children.append(None)
            if above is not None:
                left, _ = self.children[above] or (None, None)
                self.children[above] = (node, -1) if left is None else (left, node)
            widths = box[1] - box[0]
            if end - start > leaf_rows and widths.max(initial=0) > 0:
                middle = (end - start) // 2
                split = np.argpartition(vectors[rows, widths.argmax()], middle)
                self.order[start:end] = rows[split]
                open_spans += [(start + middle, end, node), (start, start + middle, node)]
        self.low, self.high, self.smallest = np.array(low), np.array(high), np.array(smallest)
        self.vectors, self.ids = vectors[self.order], ids[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Highest inner product of each query with any point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query, bounds, k: int, kth, own: int | None):
        """(row, score) of the k best rows that reach ``kth``; ``own`` takes no part."""
        best = np.empty(0, np.int64)
        scores = np.empty(0, self.vectors.dtype)
        worst = None  # smallest score and its largest id, once k rows are known
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if worst and (-bound, -self.smallest[node]) < worst:
                continue
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, end = self.spans[node]
            here = self.vectors[start:end] @ query
            rows = np.nonzero(here >= kth)[0]
            if own is not None:
                rows = rows[self.order[start + rows] != own]
            if not len(rows):
                continue
            best = np.concatenate([best, rows + start])
            scores = np.concatenate([scores, here[rows]])
            order = np.lexsort((self.ids[best], -scores))[:k]
            best, scores = best[order], scores[order]
            if len(best) == k:
                kth, worst = scores[-1], (scores[-1], -self.ids[best[-1]])
        return self.order[best], scores


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _search_group(k: int, leaf_rows: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = [field.split()[0] for field in FOUND.split(", ")]
        found: dict[str, list] = {name: [] for name in names}
        if vectors.num_rows and queries.num_rows:
            points, asked = _matrix(vectors["v"]), _matrix(queries["v"])
            ids, file, row = (vectors[n].to_numpy() for n in ("vec_id", "file", "row"))
            q_ids, q_file, q_row = (queries[n].to_numpy() for n in ("vec_id", "file", "row"))
            largest = [np.abs(x).max(initial=0) for x in (points, asked)]
            if int(largest[0]) * int(largest[1]) * max(1, points.shape[1]) < EXACT:
                points, asked = points.astype(np.float64), asked.astype(np.float64)
            tree = Tree(points, ids, leaf_rows)
            place = {at: i for i, at in enumerate(zip(file.tolist(), row.tolist()))}
            kth = queries["kth"].to_pandas().to_numpy(dtype=np.float64, na_value=-math.inf)
            for at in range(0, len(asked), 512):
                bounds = tree.bounds(asked[at : at + 512])
                for i, bound in enumerate(bounds, at):
                    own = place.get((int(q_file[i]), int(q_row[i])))
                    rows, scores = tree.search(asked[i], bound, k, kth[i], own)
                    found["q_file"] += [q_file[i]] * len(rows)
                    found["q_row"] += [q_row[i]] * len(rows)
                    found["query_id"] += [q_ids[i]] * len(rows)
                    found["vec_id"] += ids[rows].tolist()
                    found["c_file"] += file[rows].tolist()
                    found["c_row"] += row[rows].tolist()
                    found["score"] += scores.astype(np.int64).tolist()
        return pa.table({name: pa.array(found[name], pa.int64()) for name in names})

    return search


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where one is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~bad, numbers)


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_file", "q_row", "query_id").orderBy(
        F.desc("score"), "vec_id", "c_file", "c_row"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row with ``is_query``.

    Scores are inner products of whole numbers, ties go to the smaller vec_id. All
    rows but the query's own are candidates, also rows that repeat it; a query row
    that is repeated is answered as often. A null vector, one with a null or
    non-finite component, and a row without vec_id take no part. Vectors are compared
    with those of their own length only, empty ones score 0. Fewer than k candidates
    give fewer rows; an empty table none. Other columns do not matter.
    """
    file, row = unused(table, "file", "row")
    rows = with_row_key(table, file, row).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        whole_numbers(F.col(vector), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.col(file).alias("file"),
        F.col(row).alias("row"),
    )
    rows = written(rows.where("v is not null and vec_id is not null"), "vectors")
    n_rows, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1))).first()
    shards = max(1, math.ceil(n_rows / shard_rows))
    blocks = max(1, math.ceil(n_queries / block_rows))
    spread = F.xxhash64("file", "row")
    vectors = rows.select(
        F.size("v").alias("length"), F.pmod(spread, F.lit(shards)).alias("shard"), *rows.columns
    )
    queries = vectors.where("is_query").withColumn(
        "block", F.pmod(F.xxhash64("row", "file", "vec_id"), F.lit(blocks))
    )

    def searched(asked: DataFrame) -> DataFrame:
        copies = _each(blocks).alias("block")
        groups = ["length", "shard", "block"]
        left = vectors.select("length", "shard", copies, "vec_id", "file", "row", "v")
        right = asked.select(
            *[F.col(c).alias(c) for c in (*groups, "vec_id", "file", "row", "v", "kth")]
        )  # columns of its own, as both sides come from one table
        return (
            left.groupBy(*groups)
            .cogroup(right.groupBy(*groups))
            .applyInArrow(_search_group(k, leaf_rows), FOUND)
        )

    first = written(searched(queries.withColumn("kth", F.lit(None).cast("long"))), "first-shard")
    kth = (
        first.groupBy("q_file", "q_row", "query_id")
        .agg(F.min("score").alias("kth"), F.count("*").alias("n"))
        .where(F.col("n") == k)
        .select(F.col("q_file").alias("file"), F.col("q_row").alias("row"), "kth")
    )
    rest = (
        queries.join(kth, ["file", "row"], "left")
        .withColumn("home", F.col("shard"))
        .withColumn("shard", _each(shards))
        .where("shard <> home")
    )
    found = first if shards == 1 else first.union(searched(rest))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
