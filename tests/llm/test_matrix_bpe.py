"""Byte-level BPE in matrices against the published encoder, and a plain one."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR

from ratemill.llm import matrix_bpe
from ratemill.llm.queries import QUERIES, ranks
from ratemill.llm.tables import read


@pytest.fixture(scope="module")
def vocab():
    return ranks()


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.tokens, special_tokens={}
    )


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def odd_texts():
    rnd = random.Random(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "abc", "éß日本 1!\n'", "etaoin"]
    mixed = [
        "".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.randrange(1, 600))) for _ in range(150)
    ]
    single = ["a" * 30_000, "".join(rnd.choices(alphabets[0], k=20_000)), "ab" * 4000, "日本語" * 300]
    return ["", " ", "\n\n  \t x", "'s't ll'll", " " * 3000 + "x", "0123456789" * 90, "\U0001f986" * 50, *single, *mixed]


def test_matches_the_library_on_odd_texts(vocab, library):
    texts = odd_texts()
    for text, packed in zip(texts, vocab.encode(texts)):
        assert ids_of(packed) == library.encode_ordinary(text), text[:40]
        assert vocab.decode(np.frombuffer(packed, "<u4")) == text.encode()


def test_long_pieces_merge_as_short_ones(vocab):
    rnd = random.Random(5)
    for letters in ("aaab", "etaoinshrdlu", "ab"):
        for _ in range(60):
            piece = "".join(rnd.choices(letters, k=rnd.randrange(2, 300))).encode()
            assert [vocab.merge_long(piece)] == vocab.merge_bucket([piece], len(piece) + 5)


def plain(tokens, piece):
    """One merge at a time, the leftmost of the least rank."""
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(tokens.get(a + b, 1 << 30), at) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not found or min(found)[0] == 1 << 30:
            return [tokens[p] for p in parts]
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_ranks_that_no_training_gives():
    """Random ranks: a merge can make a pair of a lower rank, which then comes first."""
    rnd = random.Random(8)
    for _ in range(40):
        longer = {bytes(rnd.choices(b"abc", k=rnd.randrange(2, 6))) for _ in range(30)}
        order = [bytes([b]) for b in range(256)] + rnd.sample(sorted(longer), len(longer))
        vocab = matrix_bpe.Ranks({token: at for at, token in enumerate(order)}, r"[a-c]+")
        for _ in range(10):
            piece = bytes(rnd.choices(b"abc", k=rnd.randrange(1, 40)))
            want = plain(vocab.tokens, piece)
            assert ids_of(vocab.merge_bucket([piece], len(piece))[0]) == want
            assert ids_of(vocab.merge_long(piece)) == want


def test_forgetting_changes_nothing(library):
    small = ranks()
    small.remembered = 10
    texts = odd_texts()[-60:]
    assert [ids_of(p) for t in texts for p in small.encode([t])] == [library.encode_ordinary(t) for t in texts]


def test_a_byte_without_a_token_is_an_error():
    with pytest.raises(ValueError):
        matrix_bpe.Ranks({b"a": 0}, "a")


def test_query_matches_the_library(spark, library):
    texts = read(spark, SF_DIR, "documents").select("doc_id", "text").toPandas().set_index("doc_id").text
    found = QUERIES["op13_matrix_bpe"](spark, SF_DIR).toPandas()
    assert sorted(found.doc_id) == sorted(texts.index)
    for row in found.itertuples():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_tables(spark, vocab, library):
    long = " ".join(f"word{i}" for i in range(300_000)) + "z" * 5000
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, long)]
    docs = spark.createDataFrame(
        [(d, t, "x", "y", "z") for d, t in rows], "doc_id long, text string, ids string, decoded string, `a.b` string"
    )
    found = matrix_bpe.decode(matrix_bpe.encode(docs, vocab), vocab).collect()
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in found), key=str)
    want = [(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows]
    assert got == sorted(want, key=str)
    empty = matrix_bpe.encode(docs.limit(0), vocab)
    assert empty.columns == ["doc_id", "ids"] and empty.isEmpty()
    assert matrix_bpe.decode(empty, vocab).isEmpty()
