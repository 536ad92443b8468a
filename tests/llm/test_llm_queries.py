"""Registered queries of the subpackage against SQL, or plain Python, at sf0.01."""

import hashlib
import re

import numpy as np
import pytest
from conftest import SF_DIR
from oracle import compare, duck

import corpus_pipeline
from ratemill.llm import lines, pii, quality, simhash
from ratemill.llm.queries import ORACLES, QUERIES, vocabulary
from ratemill.llm.tables import read

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF_DIR, "documents").select("doc_id", "text").toPandas()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_operators():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in NAMES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) == ""


def test_op1_matches_all_pairs(spark, docs):
    found = QUERIES["op1_simhash_near_dedup"](spark, SF_DIR).toPandas().set_index("doc_id")
    prints = np.array([simhash.fingerprint_of(t, 3) for t in docs.text], np.int64)
    assert [f"{p % (1 << 64):016x}" for p in prints.tolist()] == found.fingerprint[docs.doc_id].tolist()
    component = components(docs.doc_id.tolist(), prints, 3)
    assert found.component_id[docs.doc_id].tolist() == [component[d] for d in docs.doc_id]


def components(ids, prints, max_bits):
    """Smallest id reachable, over all pairs."""
    group = {d: d for d in ids}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for at, one in enumerate(prints):
        for other in np.nonzero(np.bitwise_count((prints ^ one).view(np.uint64)) <= max_bits)[0]:
            a, b = sorted((top(ids[at]), top(ids[int(other)])))
            group[b] = a
    return {d: top(d) for d in ids}


def test_op3_base_spans_match_plain_patterns(spark, docs):
    found = QUERIES["op3_pii"](spark, SF_DIR).toPandas().set_index("doc_id")
    hit = 0
    for doc_id, text in zip(docs.doc_id, docs.text):
        spans = plain_spans(text)
        row = found.loc[doc_id]
        assert row.base_sha256 == sha(",".join(spans))
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(row.spans.split(",")) or not spans
        hit += bool(spans)
    assert hit > 20


def plain_spans(text):
    """The contract's patterns as they stand, with their checks."""
    found = []

    def add(rank, pattern, check):
        found.extend((m.start(), rank, m.end()) for m in re.finditer(pattern, text) if check(m))

    def luhn(digits):
        total = 0
        for at, d in enumerate(reversed(digits)):
            d = int(d) * (1 + at % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    add(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", bool)
    add(1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m[0].split("."))) <= 255)
    add(2, r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)))
    add(3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)
    return [f"{pii.KINDS[rank]}:{start}:{end}" for start, rank, end in sorted(found)]


def test_op4_finds_the_notices(spark, docs):
    """The corpus holds five notices word for word; nothing else is confirmed."""
    notices = {
        "apache": "Apache License", "gpl": "GNU General Public", "mit": "MIT License",
        "cc-by-nc": "CC BY-NC", "reserved": "All rights reserved",
    }
    found = QUERIES["op4_licences"](spark, SF_DIR).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text):
        assert found.families[doc_id] == ",".join(sorted(k for k, v in notices.items() if v in text))
        assert found.n_paragraphs[doc_id] == text.count("\n") + 1


def test_op5_matches_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op5_bpe"](spark, SF_DIR).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = library.encode(text, add_special_tokens=False).ids
        row = found.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_op7_tells_held_out_documents_apart(spark):
    found = QUERIES["op7_quality"](spark, SF_DIR)
    assert found.count() == 1000
    judged = found.where("held_out").join(read(spark, SF_DIR, "labels"), "doc_id").toPandas()
    assert (judged.predicted == judged.quality).mean() > 0.95
    assert judged[judged.quality == 1].predicted.mean() > 0.97
    assert found.where("score is null or score < 0 or score > 1").isEmpty()


def test_pipeline_matches_plain_python(spark, docs):
    """Every stage in plain Python on whole tables; the model is the fitted one."""
    everything = read(spark, SF_DIR, "documents")
    model, kinds = quality.learn(everything, read(spark, SF_DIR, "labels")), quality.kinds_table()
    rows = [
        (d, t)
        for d, t in zip(docs.doc_id, docs.text)
        if model.score(quality.features(t, kinds)) >= quality.THRESHOLD
    ]
    assert 800 < len(rows) < 900
    rows = plain_line_dedup(rows)
    prints = np.array([simhash.fingerprint_of(t, 3) for _, t in rows], np.int64)
    component = components([d for d, _ in rows], prints, 3)
    rows = [(d, t) for d, t in rows if component[d] == d]
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def windows(text):
        found = words.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text))
        return [tuple(found[i : i + 10]) for i in range(max(1, len(found) - 9))] if found else []

    known = {w for item in read(spark, SF_DIR, "benchmark").collect() for w in windows(item["text"])}
    rows = [(d, t) for d, t in rows if not known & set(windows(t))]
    vocab = vocabulary()
    want = {d: (hashlib.sha256(vocab.encode(t)).hexdigest(), sha(t)) for d, t in rows}
    got = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert {d: (i, t) for d, i, t in zip(got.doc_id, got.ids_sha256, got.decoded_sha256)} == want
    assert len(got) == len(want)


def plain_line_dedup(rows, window=lines.WINDOW):
    seen, kept = set(), []
    for doc_id, text in sorted(rows):
        parts, covered = text.split("\n"), set()
        for at in range(len(parts) - window + 1):
            here = tuple(parts[at : at + window])
            if here in seen:
                covered.update(range(at, at + window))
            seen.add(here)
        kept.append((doc_id, "\n".join(p for at, p in enumerate(parts) if at not in covered)))
    return kept


def test_stages_keep_the_columns(spark):
    docs = read(spark, SF_DIR, "documents").limit(60)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "bpe"]
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, SF_DIR).schema.simpleString() == docs.schema.simpleString()
