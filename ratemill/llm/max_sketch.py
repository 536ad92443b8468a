"""Ranked lexical search with hashed sketches of coordinatewise maxima.

A term of a document has an impact that grows with how often it occurs and falls with
the document's length. A sketch has two halves, and a term is hashed to a coordinate in
each; a coordinate keeps the maximum over the document's terms: a byte that holds the
count which the impact follows from, as the length is the same for all of them. The less
of a term's two coordinates bounds its impact. Sketches do not depend on any query, nor
on the weights of terms, which belong to the query.

A block of items is looked up in all sketches at once: the impacts in the coordinates of
the items' terms, times the terms' weights, is one matrix product, and gives a bound that
no score exceeds. Documents with the highest bounds are scored exactly first, and their
k-th best score is a threshold. Every document whose bound reaches it is then scored in
descending order of bounds, until the bounds fall below the k-th score that has risen
meanwhile. What is left out cannot be among the best k, so the result is exact.
"""

import math
import re
from bisect import insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratemill.llm.tables import with_row_key, written
from ratemill.sources.storage import fresh_folder

#: Coordinates of a sketch; a text of prose has some hundred different terms.
WIDTH = 8192
#: Counts from here on are one: their impact is taken as the greatest possible.
MOST = 255
#: Terms of the items that are looked up together; an item with more is alone.
TERMS_AT_ONCE = 4096
#: Documents scored first, for each of the k.
FIRST = 4
#: Rows of sketches read together, and terms that a task counts before it hands on.
ROWS_AT_ONCE, TERMS_KEPT = 1024, 150_000
#: Rows of one product that stay in a core's cache.
IN_CACHE = 256
#: Scored documents that go to all tasks with the plan: 24 bytes each.
BROADCAST_ROWS = 200_000

#: The terms of a text (in bytes, where all of a letter beyond ASCII
#: belongs to a term), and the constants of a score.
TERM = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, TIMES_COUNT, TIMES_LENGTH, SLOPE, WHOLE = 1_000_000_000, 1000, 8, 90, 100

_ID = ["file", "row"]


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case."""
    return re.findall(TERM, (text or b"").lower())


def coordinates_of(term: bytes, width: int) -> tuple[int, int]:
    """A coordinate in either half of a sketch."""
    hashed, half = xxhash.xxh64_intdigest(term), width // 2
    return (hashed & 0xFFFFFFFF) % half, half + (hashed >> 32) % half


def length_norm(n: int, count: int, total: int) -> int:
    """m of a document with ``n`` terms, among ``count`` with ``total``."""
    return WHOLE - SLOPE + SLOPE * n * count // total


def weight_of(count: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))


def impact(tf: int, m: int) -> int:
    return SCALE * tf // (TIMES_COUNT * tf + TIMES_LENGTH * m)


class _Coordinates(dict):
    """Both coordinates of each term in one number, worked out once."""

    def __init__(self, width: int):
        self.width = width

    def __missing__(self, term: bytes) -> int:
        first, second = coordinates_of(term, self.width)
        self[term] = both = first << 32 | second
        return both


def sketches(counts: list[Counter], coordinates: _Coordinates) -> np.ndarray:
    """A row of maxima for each document's counts."""
    folded = np.zeros(len(counts) * coordinates.width, np.uint8)
    sizes = np.fromiter(map(len, counts), np.int64, len(counts))
    starts = np.repeat(np.arange(len(counts)) * coordinates.width, sizes)
    both = np.fromiter(map(coordinates.__getitem__, chain.from_iterable(counts)), np.int64, len(starts))
    tf = np.fromiter(chain.from_iterable(found.values() for found in counts), np.int64, len(starts))
    tf = np.minimum(tf, MOST).astype(np.uint8)
    for at in (both >> 32, both & 0xFFFFFFFF):
        np.maximum.at(folded, starts + at, tf)
    return folded.reshape(len(counts), coordinates.width)


def packed(folded: np.ndarray) -> list[bytes]:
    """Sketches as bytes: the coordinates that are not zero, then their maxima."""
    rows, at = np.nonzero(folded)
    ends = np.cumsum(np.bincount(rows, minlength=len(folded))).tolist()
    at, maxima = at.astype("<u2").tobytes(), folded[folded != 0].tobytes()
    return [at[2 * start : 2 * end] + maxima[start:end] for start, end in zip([0, *ends], ends)]


def unpacked(sketch: list[bytes], width: int) -> np.ndarray:
    sizes = [len(row) // 3 for row in sketch]
    at = np.frombuffer(b"".join(row[: 2 * size] for row, size in zip(sketch, sizes)), "<u2")
    maxima = np.frombuffer(b"".join(row[2 * size :] for row, size in zip(sketch, sizes)), np.uint8)
    folded = np.zeros(len(sketch) * width, np.uint8)
    folded[np.repeat(np.arange(len(sketch)) * width, sizes) + at] = maxima
    return folded.reshape(-1, width)


@dataclass(frozen=True)
class Index:
    """Tables in the shared folder, and the texts they belong to."""

    rows: DataFrame  # file, row, doc_id, text
    documents: DataFrame  # file, row, doc_id, n, sketch; of documents with a term
    terms: DataFrame  # term, df; a term has a row for each task that met it
    width: int


_INDEXED = pa.schema(
    [
        ("kind", pa.string()),
        ("file", pa.int64()),
        ("row", pa.int64()),
        ("n", pa.int64()),
        ("sketch", pa.binary()),
        ("term", pa.binary()),
        ("df", pa.int64()),
    ]
)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> Index:
    """Sketches and counts of all documents, in one pass over their texts.

    Rows are known by their place, so repeated rows and ids are documents of their own,
    and an id may be null. A null or empty text has no terms and is no document of the
    index; a text of any length is counted whole. Other columns do not matter.
    """
    if not 2 <= width <= 1 << 16 or width % 2:
        raise ValueError("a sketch has two halves, and at most 65536 coordinates")
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = with_row_key(named, *_ID).select(*_ID, "doc_id", "text")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates, df = _Coordinates(width), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                counts = [Counter(terms_of(t)) for t in part["text"].cast(pa.binary()).to_pylist()]
                there = [i for i, found in enumerate(counts) if found]
                part, counts = part.take(pa.array(there, pa.int64())), [counts[i] for i in there]
                for found in counts:
                    df.update(found.keys())
                folded = sketches(counts, coordinates)
                yield pa.RecordBatch.from_pydict(
                    {
                        "kind": ["document"] * len(counts),
                        "file": part["file"],
                        "row": part["row"],
                        "n": [found.total() for found in counts],
                        "sketch": packed(folded),
                        "term": [None] * len(counts),
                        "df": [None] * len(counts),
                    },
                    _INDEXED,
                )
                if len(df) > TERMS_KEPT:
                    yield from listed(df)
                    df.clear()
                if len(coordinates) > TERMS_KEPT:
                    coordinates.clear()
        yield from listed(df)

    def listed(df: Counter) -> Iterator[pa.RecordBatch]:
        columns = dict.fromkeys(("file", "row", "n", "sketch"), [None] * len(df))
        counted = {"kind": ["term"] * len(df), "term": list(df), "df": list(df.values())}
        yield pa.RecordBatch.from_pydict(columns | counted, _INDEXED)

    path = fresh_folder(docs.sparkSession, "llm-max-sketches")
    columns = "kind string, file long, row long, n long, sketch binary, term binary, df long"
    found = rows.select(*_ID, "text").mapInArrow(indexed, columns)
    found.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(columns).parquet(path)
    documents = stored.where("kind = 'document'").select(*_ID, "n", "sketch")
    terms = stored.where("kind = 'term'").select("term", "df")
    return Index(rows, documents, terms, width)


@dataclass(frozen=True)
class Block:
    """Items that are looked up together; what goes to the tasks."""

    items: list[list[int]]  # numbers of the terms of each item
    weights: dict[bytes, int]  # of the terms, in the order of their numbers
    count: int
    total: int
    width: int

    @cached_property
    def _coordinates(self) -> np.ndarray:
        return np.array([coordinates_of(term, self.width) for term in self.weights]).T

    @cached_property
    def _per_item(self) -> np.ndarray:
        """Weights of the terms (rows) in the items (columns)."""
        per_item = np.zeros((len(self.weights), len(self.items)), np.float32)
        for number, terms in enumerate(self.items):
            per_item[terms, number] = [self._weights[t] for t in terms]
        return per_item

    @cached_property
    def _numbers(self) -> dict[bytes, int]:
        return {term: number for number, term in enumerate(self.weights)}

    @cached_property
    def _weights(self) -> list[int]:
        return list(self.weights.values())

    def bounds(self, n: np.ndarray, sketch: np.ndarray) -> np.ndarray:
        """No less than the score of each document (rows) for each item (columns)."""
        first, second = self._coordinates
        m = np.array([length_norm(x, self.count, self.total) for x in n.tolist()], np.float32)
        found = [np.zeros((0, len(self.items)), np.float32)]
        for at in range(0, len(n), IN_CACHE):
            some = sketch[at : at + IN_CACHE]
            tf = np.minimum(some.take(first, axis=1), some.take(second, axis=1))
            highest = tf.astype(np.float32)
            highest /= TIMES_COUNT * highest + TIMES_LENGTH * m[at : at + IN_CACHE, None]
            most = tf == MOST
            if most.any():
                highest[most] = 1 / TIMES_COUNT
            found.append(highest @ self._per_item)
        # Single precision can fall short by far less than this.
        return np.concatenate(found).astype(np.float64) * (SCALE * (1 + 1e-4))

    def contributions(self, terms: list[bytes]) -> dict[int, int]:
        """What each term of the block adds to the scores of a document, by its number."""
        m, numbers = length_norm(len(terms), self.count, self.total), self._numbers
        known = ((numbers[term], tf) for term, tf in Counter(terms).items() if term in numbers)
        return {number: self._weights[number] * impact(tf, m) for number, tf in known}

    def score(self, item: int, added: dict[int, int]) -> int:
        return sum(map(added.get, self.items[item], repeat(0)))


_CANDIDATE = "item int, file long, row long, bound double"


def _highest_bounds(index: Index, block: Block, first: int) -> DataFrame:
    """(item, file, row, bound): of each item, some documents of the highest bounds."""

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for found in _bounds(block, batches):
            if best is not None:
                found = [np.concatenate(pair) for pair in zip(best, found)]
            file, row, bound = found
            # A document that is among the first of no item is let go.
            some = min(first, len(bound))
            top = np.unique(np.argpartition(-bound, some - 1, axis=0)[:some])
            best = file[top], row[top], bound[top]
        if best is not None:
            file, row, bound = best
            at, item = np.nonzero(bound > 0)
            yield _candidates(item, file[at], row[at], bound[at, item])

    found = index.documents.mapInArrow(looked_up, _CANDIDATE)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), *_ID)
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= first)
    return ranked.drop("place")


def _reaching(index: Index, block: Block, thresholds: list[int]) -> DataFrame:
    """(item, file, row, bound): documents whose bound reaches the item's threshold."""
    least = np.array(thresholds, np.float64)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, row, bound in _bounds(block, batches):
            at, item = np.nonzero(bound >= least)
            yield _candidates(item, file[at], row[at], bound[at, item])

    return index.documents.mapInArrow(looked_up, _CANDIDATE)


def _bounds(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            sketch = unpacked(part["sketch"].to_pylist(), block.width)
            yield part["file"].to_numpy(), part["row"].to_numpy(), block.bounds(part["n"].to_numpy(), sketch)


def _candidates(item, file, row, bound) -> pa.RecordBatch:
    arrays = [pa.array(item, pa.int32()), pa.array(file), pa.array(row), pa.array(bound)]
    return pa.RecordBatch.from_arrays(arrays, names=["item", "file", "row", "bound"])


def _scored(index: Index, block: Block, candidates: DataFrame, k: int) -> DataFrame:
    """(item, rank, doc_id, score): the best ``k`` candidates of each item, by their
    exact scores."""
    per_document = candidates.groupBy(*_ID).agg(F.collect_list(F.struct("item", "bound")).alias("items"))
    per_document = written(per_document, "max-sketch-candidates")
    if per_document.count() <= BROADCAST_ROWS:
        per_document = F.broadcast(per_document)
    texts = index.rows.join(per_document, _ID).select(*_ID, "doc_id", "text", "items")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = defaultdict(list)  # of each item, the best k of the task, in order
        for batch in batches:
            texts, found = batch["text"].cast(pa.binary()), {}
            ids, places = batch["doc_id"].to_pylist(), list(zip(batch["file"].to_pylist(), batch["row"].to_pylist()))
            wanted = [
                (entry["bound"], at, entry["item"])
                for at, entries in enumerate(batch["items"].to_pylist())
                for entry in entries
            ]
            for bound, at, item in sorted(wanted, key=lambda x: -x[0]):
                kept = best[item]
                if len(kept) == k and bound < -kept[-1][0]:
                    continue
                if at not in found:
                    found[at] = block.contributions(terms_of(texts[at].as_py()))
                score = block.score(item, found[at])
                if score > 0:
                    insort(kept, (-score, ids[at] is None, ids[at], *places[at]), key=_order)
                    del kept[k:]
        flat = [(item, -kept[0], *kept[2:]) for item, of_item in best.items() for kept in of_item]
        item, score, doc_id, file, row = map(list, zip(*flat)) if flat else [[]] * 5
        columns = {"item": item, "score": score, "doc_id": doc_id, "file": file, "row": row}
        yield pa.RecordBatch.from_pydict(columns, pa.schema([(c, kinds[c]) for c in columns]))

    kinds = {"item": pa.int32(), "score": pa.int64(), "file": pa.int64(), "row": pa.int64()}
    doc_id = index.rows.schema["doc_id"].dataType
    kinds["doc_id"] = to_arrow_type(doc_id)
    scored = texts.mapInArrow(exact, f"item int, score long, doc_id {doc_id.simpleString()}, file long, row long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), *_ID)
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item", "rank", "doc_id", "score")


def _order(kept: tuple) -> tuple:
    """Best first; ids that are null come last and are not compared."""
    score, no_id, doc_id, *place = kept
    return (score, no_id, *place) if no_id else (score, no_id, doc_id, *place)


def _blocks(items: DataFrame, at_once: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(item_id, different terms) of items, up to a number of terms together."""
    block, size = [], 0
    for row in items.toLocalIterator():
        terms = sorted(set(terms_of((row["text"] or "").encode())))
        if block and size + len(terms) > at_once:
            yield block
            block, size = [], 0
        block.append((row["item_id"], terms))
        size += len(terms)
    if block:
        yield block


def search(
    index: Index,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    terms_at_once: int = TERMS_AT_ONCE,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, those with
    equal scores by their id, nulls last; only scores above 0.

    Items are the stated queries and pass through the driver a block at a time; every
    row of them is an item, also one with a repeated or null id. A null text has no
    terms and no documents; an empty table of items or documents gives no rows.
    """
    spark = items.sparkSession
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    sums = index.documents.agg(F.count("*").alias("count"), F.sum("n").alias("total")).first()
    id_type, doc_type = items.schema["item_id"].dataType.simpleString(), index.rows.schema["doc_id"].dataType.simpleString()
    found_type = f"item_id {id_type}, rank int, doc_id {doc_type}, score long"
    path = fresh_folder(spark, "llm-ranked")
    wrote = False
    for number, block in enumerate(_blocks(items, terms_at_once) if sums["count"] else ()):
        best = _search_block(index, block, sums["count"], sums["total"], k)
        if best is not None:
            ids = spark.createDataFrame([(at, item) for at, (item, _) in enumerate(block)], f"item int, item_id {id_type}")
            best = best.join(F.broadcast(ids), "item")
            best.select("item_id", "rank", "doc_id", "score").write.parquet(f"{path}/block={number}")
            wrote = True
    if not wrote:
        return spark.createDataFrame([], found_type)
    return spark.read.schema(found_type).parquet(path).select("item_id", "rank", "doc_id", "score")


def _search_block(index: Index, items: list[tuple[object, list[bytes]]], count: int, total: int, k: int) -> DataFrame | None:
    spark = index.documents.sparkSession
    wanted = sorted({term for _, terms in items for term in terms})
    asked = spark.createDataFrame([(bytearray(t),) for t in wanted], "term binary")
    df = index.terms.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weights = {bytes(r["term"]): weight_of(count, r["df"]) for r in df.collect()}
    numbers = {term: at for at, term in enumerate(weights)}
    if not numbers:
        return None
    known = [[numbers[t] for t in terms if t in numbers] for _, terms in items]
    block = Block(known, weights, count, total, index.width)
    first = _scored(index, block, _highest_bounds(index, block, FIRST * k), k)
    thresholds = [1] * len(items)
    for row in first.where(F.col("rank") == k).select("item", "score").collect():
        thresholds[row["item"]] = row["score"]
    return _scored(index, block, _reaching(index, block, thresholds), k)
