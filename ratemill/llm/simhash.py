"""SimHash near-duplicates by an index of fingerprint bytes with count filtering.

A fingerprint has eight bytes at eight positions. Two fingerprints that differ in
at most d bits differ in at most d bytes, so they share at least 8 - d bytes at
the same positions: the minimum a pair has to reach. The index lists fingerprints
by the bytes they hold at given positions. A list per single byte would make every
pair meet (an eighth of all fingerprints' pairs share one), so a list here needs
several positions at once, chosen so that no pair that reaches the minimum is
missed: for d up to 3 the 14 sets of four positions whose numbers XOR to zero, of
which at least one avoids any three positions. Pairs that meet in a list have
their shared bytes tallied; those that reach the minimum have their bits compared.

Lists of more than ``LIST_ROWS`` fingerprints are not compared but split: the bits
a list does not fix are cut into d + 1 parts, one of which a linked pair must share
too, so each part makes a finer list, until lists are short. Nothing is dropped.
Equal fingerprints are one entry, and a list gives a tree of links, not its pairs.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from ratemill.llm.components import smallest_reachable
from ratemill.llm.tables import columns_of, unused, written

BYTES = 8
SEED = 42
#: Longest list that is compared pair by pair; 2 ** 8 so that 8 free bits always fit.
LIST_ROWS = 256
#: Shingles whose bits are counted at once.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, shingle_words: int) -> int:
    """64-bit SimHash of a text as a signed number; 0 where there are no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle_words:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        last = len(words) - shingle_words + 1
        starts, ends = (stops - lengths)[:last].tolist(), stops[shingle_words - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, BYTES)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text, shingle_words: int = 3):
    @pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(text, shingle_words) for text in texts], dtype="int64")

    return fingerprints(text)


def position_masks(max_bits: int) -> list[int]:
    """Bit masks of the position sets that index a fingerprint, signed."""
    if not 0 <= max_bits < BYTES:
        raise ValueError(f"max_bits must be from 0 to {BYTES - 1}")
    if max_bits <= 3:
        sets = [c for c in combinations(range(BYTES), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    else:
        sets = combinations(range(BYTES), BYTES - max_bits)
    masks = [sum(0xFF << (8 * position) for position in chosen) for chosen in sets]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """``mask`` with each of max_bits + 1 parts of its free bits added."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    parts = [free[i :: max_bits + 1] for i in range(max_bits + 1)]
    masks = [(mask % (1 << 64)) | sum(1 << bit for bit in part) for part in parts if part]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def _forest(low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    """A tree of links for each group that the links (low, high) connect."""
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    for x, y in zip(low.tolist(), high.tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    rows = [(node, above) for node, above in parent.items() if node != above]
    return pd.DataFrame(rows, columns=["a", "b"], dtype="int64")


def linked_in_lists(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Links among the fingerprints of whole lists, rows sorted by list."""
    prints = rows.fp.to_numpy(np.int64)
    mask, bits = rows["mask"].to_numpy(), rows["bits"].to_numpy()
    low, high, apart = [], [], 1
    left = np.arange(len(prints))
    while len(left := left[left + apart < len(prints)]):
        left = left[(mask[left] == mask[left + apart]) & (bits[left] == bits[left + apart])]
        differing = prints[left] ^ prints[left + apart]
        shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
        reached = shared >= BYTES - max_bits
        near = reached & (np.bitwise_count(differing.view(np.uint64)) <= max_bits)
        low.append(prints[left[near]])
        high.append(prints[left[near] + apart])
        apart += 1
    empty = [np.empty(0, np.int64)]
    return _forest(np.concatenate(low or empty), np.concatenate(high or empty))


def _links(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    kept = None
    for batch in batches:
        if batch.empty:
            continue
        batch = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        last = batch.iloc[-1]
        open_list = (batch["mask"] == last["mask"]) & (batch["bits"] == last["bits"])
        kept = batch[open_list]
        yield linked_in_lists(batch[~open_list], max_bits)
    if kept is not None:
        yield linked_in_lists(kept, max_bits)


def _finer(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for mask, rows in batch.groupby("mask"):
            for finer in finer_masks(int(mask), max_bits):
                prints = rows.fp.to_numpy()
                yield pd.DataFrame({"mask": finer, "bits": prints & finer, "fp": prints})


def links(prints: DataFrame, max_bits: int = 3, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``max_bits`` of each other.

    ``prints`` has one column fp without repeats. The links connect exactly what
    the pairs within ``max_bits`` connect, and each is such a chain's shortcut.
    """
    masks = F.explode(F.array(*[F.lit(mask) for mask in position_masks(max_bits)]))
    lists = prints.select("fp", masks.alias("mask")).select(
        "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("bits"), "fp"
    )
    found, list_rows = None, max(list_rows, 2 ** (max_bits + 1))
    while True:
        sizes = lists.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
        met = written(lists.join(sizes, ["mask", "bits"]), "lists")
        short = met.where(F.col("n") <= list_rows).select("mask", "bits", "fp")
        here = (
            short.repartition("mask", "bits")
            .sortWithinPartitions("mask", "bits", "fp")
            .mapInPandas(lambda batches: _links(batches, max_bits), "a long, b long")
        )
        found = here if found is None else found.union(here)
        long = met.where(F.col("n") > list_rows).select("mask", "bits", "fp")
        if long.isEmpty():
            return found
        lists = long.mapInPandas(
            lambda batches: _finer(batches, max_bits), "mask long, bits long, fp long"
        ).distinct()


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """(doc_id, text_hash, fp, component, root): documents grouped by near fingerprints.

    Words are what ASCII white space separates, A-Z lower-cased; the fingerprint is
    the bitwise majority over XXH64 (seed 42) of all shingles, repeats included.
    ``component`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, and ``root`` the smallest fingerprint: it alone tells
    groups apart, as an id can be in several. One row for each row of ``docs``:
    repeated rows and equal ids stay. A null or empty text has no words and fingerprint 0, and is
    linked like any other; a text of fewer words than a shingle is one shingle. A
    null doc_id never is the smallest, unless a group has no other (then
    ``component`` is null). An empty table gives no rows; other columns do not matter.
    """
    prints = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
            fingerprint_column(F.col(text), shingle_words).alias("fp"),
        ),
        "fingerprints",
    )
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = smallest_reachable(links(distinct.select("fp"), max_bits))
    grouped = distinct.join(
        roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left"
    ).select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component"))
    named = grouped.join(lowest, "root").select("fp", "component", "root")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "component", "root")


def keep_one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the smallest doc_id.

    Of rows that share this doc_id and the text, one stays, as the order of a hash
    over their other columns has it. Each group without any doc_id keeps one row too,
    and groups that share their smallest doc_id keep one each. The columns are those
    of ``docs``.
    """
    text, doc_id = parameters.get("text", "text"), parameters.get("doc_id", "doc_id")
    found = near_duplicates(docs, **parameters)
    kept = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
        .select("first.doc_id", "first.text_hash")
    )
    hash_name, rank_name, id_name, kept_hash = unused(docs, "text_hash", "rank", "kept_id", "kept_hash")
    hashed = docs.withColumn(hash_name, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = kept.select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(kept_hash))
    same = hashed[doc_id].eqNullSafe(kept[id_name]) & (hashed[hash_name] == kept[kept_hash])
    # Equal fingerprints are linked, so rows with this id and text are all of one group.
    order = Window.partitionBy(doc_id, hash_name).orderBy(F.xxhash64(F.to_json(F.struct(*columns_of(docs)))))
    return (
        hashed.join(kept, same, "left_semi")
        .withColumn(rank_name, F.row_number().over(order))
        .where(F.col(rank_name) == 1)
        .select(*columns_of(docs))
    )
