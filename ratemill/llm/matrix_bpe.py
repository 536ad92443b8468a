"""Byte-level BPE by rounds over padded matrices, and decoding by an offset table.

The pattern cuts a text into pieces, and merges never cross them. Different pieces are
gathered and sorted into buckets of like length; a bucket is a matrix of token ids with
a piece in each row, padded at the end, and beside it the rank of every neighbouring
pair, found in a hash table of all pairs that make a token. In a round every row merges
its leftmost pair of least rank: the column is taken out of the row, and the two pairs
beside it are looked up anew. Rows without a pair that merges leave the matrix. A piece
that is a token as a whole is that token, as in the published encoder.

Very long pieces are matrices of one row. A round there merges more than one pair: all
of the least rank, from the left, up to the first whose merge makes a pair of a lower
rank; the others would have been merged in the next rounds.
"""

from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

#: Pieces whose ids a task keeps before it starts over: bounds its memory.
REMEMBERED = 400_000
#: Characters encoded together, and tokens decoded together.
TOGETHER = 1 << 20
#: Cells of a matrix; and bytes from which a piece has a matrix of its own.
CELLS, LONG = 1 << 20, 256

NEVER = np.int32(2**31 - 1)
PAD = np.int32(-1)


class PairTable:
    """Rank of the token that two tokens make, by open addressing: numpy arrays only."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(4 * len(left)).bit_length())
        size = 1 << self.bits
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NEVER, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slots, waiting = self._slots(keys), np.arange(len(keys))
        while len(waiting):
            free = waiting[self.keys[slots[waiting]] < 0]
            taken, first = np.unique(slots[free], return_index=True)
            self.keys[taken], self.ranks[taken] = keys[free[first]], ranks[free[first]]
            waiting = waiting[self.keys[slots[waiting]] != keys[waiting]]
            slots[waiting] = (slots[waiting] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # Fibonacci hashing
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NEVER`` where they make no token; ``PAD`` is in no pair."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        slots = self._slots(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.ranks[slots], NEVER)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found


def width_of(length: int) -> int:
    """Columns of the bucket for a piece: its length, beyond 16 at most a quarter more."""
    if length <= 16:
        return length
    step = 1 << (length.bit_length() - 3)
    return -(-length // step) * step


class Ranks:
    """A vocabulary given as ranks: bytes of every token, the rank being the id."""

    def __init__(self, tokens: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        if any(bytes([byte]) not in tokens for byte in range(256)):
            raise ValueError("every single byte has to be a token")
        self.tokens, self.pattern, self.remembered = tokens, pattern, remembered
        self._known: dict[str, bytes] = {}

    @classmethod
    def from_tiktoken(cls, content: bytes, pattern: str) -> "Ranks":
        """A file of lines with a token in base64 and its rank, given as its content."""
        rows = (line.split() for line in content.splitlines() if line.strip())
        return cls({b64decode(token): int(rank) for token, rank in rows}, pattern)

    @cached_property
    def _pairs(self) -> PairTable:
        splits = [
            (self.tokens[token[:cut]], self.tokens[token[cut:]], rank)
            for token, rank in self.tokens.items()
            for cut in range(1, len(token))
            if token[:cut] in self.tokens and token[cut:] in self.tokens
        ]
        return PairTable(*np.array(splits, np.int32).reshape(-1, 3).T)

    @cached_property
    def _byte_ids(self) -> np.ndarray:
        return np.array([self.tokens[bytes([byte])] for byte in range(256)], np.int32)

    @cached_property
    def _cut(self):
        return regex.compile(self.pattern)

    # --- merging --------------------------------------------------------------

    def merge_bucket(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of at most ``width`` bytes, as little-endian 32-bit numbers."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        octets = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8)
        ids = self._byte_ids[octets].reshape(len(pieces), width)
        ids[np.arange(width) >= lengths[:, None]] = PAD
        ranks = self._pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), -1)
        rows, done = np.arange(len(pieces)), [b""] * len(pieces)
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NEVER)
            ready = best == NEVER
            if ready.any():
                self._hand_out(ids[ready], rows[ready], done)
                ids, ranks, rows, at, best = (x[~ready] for x in (ids, ranks, rows, at, best))
            if not len(rows):
                return done
            ids, ranks = self._merged(ids, ranks, at, best)

    def _merged(self, ids, ranks, at, best):
        """Every row with the pair at ``at`` joined, one column less."""
        every, width = np.arange(len(ids)), ids.shape[1]
        ids[every, at] = best
        ids = ids[np.arange(width) != (at + 1)[:, None]].reshape(len(ids), width - 1)
        ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(len(ids), width - 2)
        before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
        to_left, to_right = at[before], at[after]
        ranks[before, to_left - 1] = self._pairs.find(ids[before, to_left - 1], ids[before, to_left])
        ranks[after, to_right] = self._pairs.find(ids[after, to_right], ids[after, to_right + 1])
        return ids, ranks

    @staticmethod
    def _hand_out(ids: np.ndarray, rows: np.ndarray, done: list[bytes]) -> None:
        real = ids != PAD
        ends = (4 * np.cumsum(real.sum(axis=1))).tolist()
        packed, start = ids[real].astype("<u4").tobytes(), 0
        for row, end in zip(rows.tolist(), ends):
            done[row] = packed[start:end]
            start = end

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one piece of any length, pairs of the same rank merged together."""
        ids = self._byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self._pairs.find(ids[:-1], ids[1:])
        while len(ranks):
            best = ranks.min()
            if best == NEVER:
                break
            at = np.flatnonzero(ranks == best)
            # In a run of neighbouring pairs, each second one is left after a merge.
            fresh = np.concatenate(([True], np.diff(at) != 1))
            starts = np.flatnonzero(fresh)
            at = at[(np.arange(len(at)) - starts[np.cumsum(fresh) - 1]) % 2 == 0]
            beside = np.concatenate(([False], np.diff(at) == 2))
            left = np.where(beside, best, ids[np.maximum(at - 1, 0)])
            right = ids[np.minimum(at + 2, len(ids) - 1)]
            joined = np.full(len(at), best, np.int32)
            lower = (self._pairs.find(left, joined) < best) & (at > 0)
            lower |= (self._pairs.find(joined, right) < best) & (at + 2 < len(ids))
            if lower.any():
                at = at[: lower.argmax() + 1]
            ids[at] = best
            ids = np.delete(ids, at + 1)
            ranks = np.delete(ranks, at)
            now = at - np.arange(len(at))
            for near in (now[now > 0] - 1, now[now < len(ids) - 1]):
                ranks[near] = self._pairs.find(ids[near], ids[near + 1])
        return ids.astype("<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Keep the ids of pieces that are not known yet."""
        buckets: dict[int, list[str]] = {}
        for piece in pieces:
            octets = piece.encode()
            whole = self.tokens.get(octets)
            if whole is not None:
                self._known[piece] = whole.to_bytes(4, "little")
            elif len(octets) > LONG:
                self._known[piece] = self.merge_long(octets)
            else:
                buckets.setdefault(width_of(len(octets)), []).append(piece)
        for width, bucket in buckets.items():
            rows = max(1, CELLS // width)
            for at in range(0, len(bucket), rows):
                some = bucket[at : at + rows]
                self._known.update(zip(some, self.merge_bucket([p.encode() for p in some], width)))

    # --- texts ----------------------------------------------------------------

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a very long one's a block at a time."""
        if len(text) <= TOGETHER:
            yield self._cut.findall(text)
            return
        found = (match[0] for match in self._cut.finditer(text))
        while block := list(islice(found, TOGETHER // 4)):
            yield block

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        encoded, waiting, size = [], [], 0
        for text in texts:
            whole = []
            for block in self._blocks(text):
                waiting.append((whole, block))
                size += sum(map(len, block))
                if size >= TOGETHER:
                    self._flush(waiting)
                    waiting, size = [], 0
            encoded.append(whole)
        self._flush(waiting)
        return [b"".join(parts) for parts in encoded]

    def _flush(self, waiting: list[tuple[list[bytes], list[str]]]) -> None:
        needed = set().union(*(block for _, block in waiting))
        if len(self._known) + len(needed) > self.remembered:
            self._known.clear()
        self._learn(needed.difference(self._known))
        for whole, block in waiting:
            whole.append(b"".join(map(self._known.__getitem__, block)))

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens after one another, and where each begins."""
        by_id = {rank: token for token, rank in self.tokens.items()}
        rows = [by_id.get(at, b"") for at in range(max(by_id) + 1)]
        return np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])

    def decode(self, ids: np.ndarray) -> bytes:
        octets, offsets = self._table
        parts = []
        for at in range(0, len(ids), TOGETHER):
            some = ids[at : at + TOGETHER]
            lengths = offsets[some + 1] - offsets[some]
            ends = np.cumsum(lengths)
            parts.append(octets[np.arange(ends[-1]) + np.repeat(offsets[some] - ends + lengths, lengths)].tobytes())
        return b"".join(parts)


def _slices(sizes: list[int], limit: int = 4 * TOGETHER) -> Iterator[slice]:
    """Runs of rows of about ``limit`` together, so that no batch that is handed on is
    much larger than its largest row."""
    start = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(start, at)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def encode(docs: DataFrame, ranks: Ranks, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the token ids of each text, in order, as an array of integers.

    One row for each row of ``docs``. A null or empty text has no ids, a piece of any
    length is merged whole; repeated rows and null ids stay; an empty table gives no
    rows; other columns do not matter. A task keeps one batch of texts and the ids of
    ``ranks.remembered`` pieces.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0).to_pylist()
            for some in _slices(sizes):
                part = batch.slice(some.start, some.stop - some.start)
                packed = ranks.encode(t or "" for t in part["text"].to_pylist())
                offsets = np.cumsum([0, *(len(p) // 4 for p in packed)])
                values = np.frombuffer(b"".join(packed), "<i4")
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids], names=["doc_id", "ids"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ids = StructField("ids", ArrayType(IntegerType(), containsNull=False))
    return chosen.mapInArrow(encoded, StructType([chosen.schema["doc_id"], ids]))


def decode(tokens: DataFrame, ranks: Ranks) -> DataFrame:
    """(doc_id, ids, decoded): rows of ``encode`` with the bytes of their ids.

    Null ids decode to no bytes; an id beyond the vocabulary is an error.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            found = []
            for at in range(len(lists)):
                row = lists[at].values
                found.append(ranks.decode(row.to_numpy()) if row is not None else b"")
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], lists, pa.array(found, pa.binary())], names=["doc_id", "ids", "decoded"]
            )

    chosen = tokens.select("doc_id", "ids")
    return chosen.mapInArrow(decoded, StructType([*chosen.schema.fields, StructField("decoded", BinaryType())]))
