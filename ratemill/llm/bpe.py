"""Exact byte-pair encoding without running merges, and decoding by an offset table.

The pattern cuts a text into pieces, as the tokenizer file says; merges never cross
them. Inside a piece, an Aho-Corasick automaton over the vocabulary's bytes finds the
longest token at every position in one pass. The encoder goes from left to right
taking the longest token that is compatible with the one before it; where none is, it
takes a shorter prefix, and where none is left it steps back one token. A position
that was stepped back from is never tried again, so the work is linear.

Two tokens are compatible if merging their joined bytes gives just these two back. The
table for that holds pairs already decided, and is filled by undoing merges along the
border: the pair is incompatible as soon as some merge across the border would have
come before the merges that made the two. The result equals applying all merges.

Decoding is one gather: a table of offsets into the joined bytes of all tokens.
"""

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import sha256

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

#: Pieces and pairs that a task remembers before it starts over: bounds its memory.
REMEMBERED = 400_000
#: Tokens decoded at once.
DECODED_AT_ONCE = 1 << 18


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1
    characters stand for themselves, the others follow from 256 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [byte for byte in range(256) if byte not in plain]
    letters = {chr(byte): byte for byte in plain}
    return letters | {chr(256 + at): byte for at, byte in enumerate(other)}


@dataclass
class Vocabulary:
    """Tokens as bytes, merges by rank, special strings, and the piece pattern."""

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]  # left, right, joined; in order of rank
    specials: dict[str, int]
    pattern: str
    remembered: int = REMEMBERED
    _ids: dict[str, bytes] = field(default_factory=dict)
    _compatible: dict[tuple[int, int], bool] = field(default_factory=dict)

    @classmethod
    def from_json(cls, content: str, pattern: str) -> "Vocabulary":
        """A byte-level BPE file of the tokenizers library, given as its text."""
        file = json.loads(content)
        model, letters = file["model"], byte_of_letter()
        before = file["pre_tokenizer"]
        plain = file["normalizer"] is None and before["type"] == "ByteLevel" and not before["add_prefix_space"]
        odd = model.get("ignore_merges") or model.get("dropout") or model["type"] != "BPE"
        if not plain or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are supported")
        ids = model["vocab"]
        tokens = {at: bytes(letters[c] for c in text) for text, at in ids.items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        return cls(tokens, merges, {t["content"]: t["id"] for t in file["added_tokens"]}, pattern)

    @cached_property
    def _rank(self) -> dict[int, int]:
        """Rank of the merge that makes a token; single bytes come before all."""
        return {at: -1 for at in self.tokens} | {joined: rank for rank, (_, _, joined) in enumerate(self.merges)}

    @cached_property
    def _joined(self) -> dict[tuple[int, int], int]:
        return {(left, right): rank for rank, (left, right, _) in enumerate(self.merges)}

    @cached_property
    def _halves(self) -> dict[int, tuple[int, int]]:
        return {joined: (left, right) for left, right, joined in self.merges}

    @cached_property
    def _lengths(self) -> dict[int, int]:
        return {at: len(token) for at, token in self.tokens.items()}

    @cached_property
    def _automaton(self):
        found = ahocorasick.Automaton()
        for at, token in self.tokens.items():
            found.add_word(token.decode("latin-1"), (len(token), at))
        found.make_automaton()
        return found

    @cached_property
    def _shorter(self) -> dict[int, int]:
        """The longest other token that a token starts with."""
        by_bytes = {token: at for at, token in self.tokens.items()}
        shorter = {}
        for at, token in self.tokens.items():
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in by_bytes:
                    shorter[at] = by_bytes[token[:end]]
                    break
        return shorter

    @cached_property
    def _cut(self):
        return regex.compile(self.pattern).findall

    @cached_property
    def _special(self):
        longest_first = sorted(self.specials, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart when their joined bytes are encoded."""
        known = self._compatible.get((left, right))
        if known is None:
            if len(self._compatible) >= self.remembered:
                self._compatible.clear()
            known = self._compatible[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo merges at the border, latest first; a border pair whose own merge
        would have come before the one undone last joins the two sides."""
        rank, never = self._rank, len(self.merges)
        until, from_left = never, False
        while True:
            merge = self._joined.get((left, right), never)
            # Of equal ranks the merge further left comes first: a merge undone in
            # the left token was made before, one in the right token after.
            if merge < until or (merge == until != never and not from_left):
                return False
            ranks = rank[left], rank[right]
            if max(ranks) < 0:
                return True
            from_left = ranks[0] > ranks[1]
            until = max(ranks)
            if from_left:
                left = self._halves[left][1]
            else:
                right = self._halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The encoding of a piece. Tokens that are pairwise compatible are the only
        such ones, so if the longest matches in a row are, nothing is left to try."""
        letters = piece.decode("latin-1")
        row = [at for _, (_, at) in self._automaton.iter_long(letters)]
        known, decide = self._compatible.get, self.compatible
        for number, pair in enumerate(zip(row, row[1:]), 1):
            fits = known(pair)
            if fits is None:
                fits = decide(*pair)
            if not fits:
                return self._backtrack(letters, row, number)
        return row

    def _backtrack(self, letters: str, row: list[int], number: int) -> list[int]:
        """Go on from the first ``number`` tokens of ``row``, longest matches in a row."""
        lengths, shorter, long_from = self._lengths, self._shorter, self._automaton.iter_long
        known, decide = self._compatible.get, self.compatible
        longest, start = {}, 0
        for token in row:
            longest[start] = token
            start += lengths[token]
        found, token = row[:number], row[number]
        at, size = sum(lengths[before] for before in found), len(letters)
        closed = set()
        while at < size:
            end = at + lengths[token]
            fits = end not in closed
            if fits and found:
                pair = (found[-1], token)
                fits = known(pair)
                if fits is None:
                    fits = decide(*pair)
            if fits:
                found.append(token)
                at = end
                token = longest.get(at)
                if token is None and at < size:
                    token = longest[at] = next(long_from(letters, at))[1][1]
                continue
            token = shorter.get(token)
            if token is None:
                closed.add(at)
                token = found.pop()
                at -= lengths[token]
        return found

    def _packed(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit numbers."""
        if len(self._ids) >= self.remembered:
            self._ids.clear()
        packed = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self._ids[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers; special strings get their id."""
        parts = self._special.split(text) if self._special else [text]
        packed = []
        for number, part in enumerate(parts):
            if number % 2:
                packed.append(np.array([self.specials[part]], "<u4").tobytes())
                continue
            known, slow = self._ids.get, self._packed
            packed += [known(piece) or slow(piece) for piece in self._cut(part)]
        return b"".join(packed)

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Joined bytes of all tokens, and the offset where each begins."""
        every = self.tokens | {at: text.encode() for text, at in self.specials.items()}
        size = max(every, default=-1) + 1
        lengths = np.zeros(size + 1, np.int64)
        for at, token in every.items():
            lengths[at + 1] = len(token)
        return np.frombuffer(b"".join(every.get(at, b"") for at in range(size)), np.uint8), np.cumsum(lengths)

    def decode(self, packed: bytes) -> str:
        """Text of ids; bytes that are not UTF-8 become the replacement character."""
        octets, offsets = self._table
        ids = np.frombuffer(packed, "<u4")
        parts = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[at : at + DECODED_AT_ONCE]
            starts, lengths = offsets[some], offsets[some + 1] - offsets[some]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
            parts.append(octets[places].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


def tokenize(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, ids, decoded): token ids as little-endian 32-bit numbers, and their text.

    One row for each row of ``docs``, in tasks that keep one batch of texts. A null or
    empty text has no ids and decodes to the empty text; repeated rows and null ids
    stay; an empty table gives no rows; other columns do not matter.
    """

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [vocabulary.encode(t or "") for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "decoded": map(vocabulary.decode, ids)})

    return _mapped(docs, text, doc_id, encoded, "ids binary, decoded string")


def token_digests(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``tokenize`` gives."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch["text"]:
                ids = vocabulary.encode(t or "")
                decoded = vocabulary.decode(ids)
                rows.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest()))
            found = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield found.assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", *found.columns]]

    return _mapped(docs, text, doc_id, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _mapped(docs: DataFrame, text: str, doc_id: str, function, columns: str) -> DataFrame:
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInPandas(function, f"doc_id {kind}, {columns}")
