"""The scan of licences against plain Python, and templates of any length."""

from functools import lru_cache

import numpy as np
import pytest
from conftest import SF_DIR

from ratemill.llm import licences
from ratemill.llm.licences import grams, words
from ratemill.llm.queries import QUERIES
from ratemill.llm.tables import read


def in_order(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def pairs_of(found):
    return list(zip(found, found[1:]))


class Plain:
    """What ``scan`` states, one document at a time."""

    def __init__(self, model):
        self.model, self.places = model, {name: at for at, name in enumerate(model.features)}

    @lru_cache(maxsize=None)
    def judged(self, known):
        logits = self.model.logits(np.array([[float(f in known) for f in self.model.features]]))[0]
        chances = np.exp(logits - logits.max())
        at = int(logits.argmax())
        return (licences.UNKNOWN, *licences.FAMILIES)[at], 1 - chances[0] / chances.sum()

    def family(self, found):
        family, chance = self.judged(frozenset(grams(found) & self.places.keys()))
        return family if family != licences.UNKNOWN and chance >= licences.LEAST_PROBABILITY else None

    def stretches(self, found):
        """(template, start, stop) of the notices of a paragraph, none mostly in another."""
        close = []
        for t, (_, template) in enumerate(licences.NOTICES):
            own, n = set(pairs_of(template)), len(template)
            starts = {
                max(at - place, 0)
                for at, pair in enumerate(pairs_of(found))
                if pair in own
                for place, theirs in enumerate(pairs_of(template))
                if pair == theirs
            }
            for start in starts:
                part = found[start : start + n + n // 4]
                share = (in_order(template, part) + len(own & set(pairs_of(part)))) / (n + len(own))
                if share >= licences.LEAST_SHARE:
                    close.append((-share, t, start, min(start + n, len(found))))
        kept = []
        for _, t, start, stop in sorted(close):
            if not any(2 * (min(e, stop) - max(s, start)) > min(e - s, stop - start) for _, s, e in kept):
                kept.append((t, start, stop))
        return kept

    def scan(self, text):
        """(line, family, confirmed), in order."""
        lines = [words(line) for line in text.split("\n")]
        notices, at = [], 0
        while at < len(lines):
            end = at
            while end < len(lines) and lines[end]:
                end += 1
            found = sum(lines[at:end], [])
            of_word = [n for n in range(at, end) for _ in lines[n]]
            for t, start, stop in self.stretches(found):
                family = licences.NOTICES[t][0]
                if self.family(found[start:stop]) == family:
                    notices.append((of_word[start], of_word[stop - 1], family))
            at = max(end, at + 1)
        rows = {(first, family, True) for first, _, family in notices}
        for n, line in enumerate(lines):
            family = self.family(line) if line else None
            if family and not any(f == family and first <= n <= last for first, last, f in notices):
                rows.add((n, family, False))
        return sorted(rows)


WRAPPED = """# Permission is hereby granted, free of charge, to any person
# obtaining a copy of this software and associated documentation files, to deal
# in the Software without restriction.

All rights reserved. Released under the MIT License.
Licensed under
the Apache License, Version 2.0.

released under a licence, all rights to the mozilla
MIT\n\nGNU General Public"""


def test_scan_matches_plain_python(spark):
    docs = read(spark, SF_DIR, "documents").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, WRAPPED), (-2, "GNU"), (-3, "")], docs.schema))
    model = licences.train(docs)
    plain, texts = Plain(model), {r["doc_id"]: r["text"] for r in docs.collect()}
    found = licences.licences(docs, model=model).collect()
    assert len(found) == len(texts)
    for row in found:
        got = [(f["paragraph"], f["family"], f["confirmed"]) for f in row["found"]]
        assert sorted(got) == plain.scan(texts[row["doc_id"]]), row["doc_id"]
    confirmed = {f for _, f, sure in plain.scan(WRAPPED) if sure}
    assert confirmed == {"mit", "reserved", "apache"}


def test_query_follows_the_scan(spark):
    docs = read(spark, SF_DIR, "documents").select("doc_id", "text")
    plain = Plain(licences.train(docs))
    for row, text in zip(*[sorted(x.collect()) for x in (QUERIES["op4_licences"](spark, SF_DIR), docs)]):
        rows = plain.scan(text["text"])
        sure = [(line, family) for line, family, confirmed in rows if confirmed]
        assert row["n_predicted"] == len(rows) and row["n_confirmed"] == len(sure)
        assert row["families"] == ",".join(sorted({family for _, family in sure}))
        assert sorted(row["places"].split(",")) == sorted(f"{f}:{n}" for n, f in sure) or not sure


@pytest.mark.parametrize("size", [1, 59, 60, 61, 63, 64, 150, 1000])
def test_a_template_of_any_length(size):
    whole = [f"w{i}" for i in range(size)]
    cut = licences.pieces(whole)
    assert sum(cut, []) == whole and max(map(len, cut)) <= licences.PIECE
    assert min(map(len, cut)) > size // len(cut) - 1


def test_a_long_template_is_confirmed(spark, monkeypatch):
    """Its own words as the text: every piece of it is a notice of the family."""
    long = [f"clause{i}" for i in range(150)]
    notices = licences.NOTICES + [("mit", piece) for piece in licences.pieces(long)]
    monkeypatch.setattr(licences, "NOTICES", notices)
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:20]))], "doc_id int, text string")
    found = licences.licences(docs, model=licences.fit([], {}, 0))
    by_id = {r["doc_id"]: [(f["family"], f["confirmed"]) for f in r["found"]] for r in found.collect()}
    assert by_id[1] == [("mit", True)] and ("mit", True) not in by_id[2]


def test_calibration_holds_templates_out():
    """Rows that a model was fitted to would make it surer than it may be."""
    model = licences.fit([], {}, 0)
    assert model.temperature > 1
