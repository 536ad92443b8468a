"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs are runs of lines with words; the marks of comments are none, so a notice
wrapped over lines is one text. Features are word unigrams and bigrams (ASCII letters
and digits, lower case) that occur in licence templates and are rare in other text. A
sparse logistic regression over them, with a class for unknown text, is trained from
varied templates and from lines of the corpus; its probabilities are calibrated on
held-out rows. It classifies every line, and every stretch of a paragraph that holds
enough of a template in its order; the latter confirms a prediction of that family. A
line without any feature gets the bias alone, which training makes unknown, so only
lines with features are scored: in SQL functions, projections over the documents.
"""

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Notices by which the families are known.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "reserved": (
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = "unknown"
#: Bounds of the training rows: lines of the corpus, and words of one that are put beside a template.
CORPUS_LINES, AROUND = 3000, 12
#: Words of a template, from which on it is cut; and parts of the rows held out in turn.
PIECE, FOLDS = 60, 4
#: Families that may have a word in common before it says nothing: three are GNU's.
SHARED = 3
#: Variants of each template, and the share of corpus lines above which an n-gram is no feature.
VARIANTS, COMMON = 40, 0.01
#: A prediction needs this probability of not being unknown, a confirmation this share of a template.
LEAST_PROBABILITY, LEAST_SHARE = 0.5, 0.6


def words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda c: c[0].lower(), text))


def grams(found: list[str]) -> set[str]:
    return set(found) | set(map(" ".join, zip(found, found[1:])))


def pieces(found: list[str], longest: int = PIECE) -> list[list[str]]:
    """A template's words in pieces of like length: their places are bits of a long."""
    n = -(-len(found) // longest)
    return [found[len(found) * at // n : len(found) * (at + 1) // n] for at in range(n)]


#: (family, words) of every template; of a long one, each piece is a template.
NOTICES = [(family, piece) for family in FAMILIES for t in TEMPLATES[family] for piece in pieces(words(t))]


@dataclass
class Model:
    features: list[str]
    weights: np.ndarray  # (features + 1, classes), the last row is the bias
    temperature: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.weights[:-1] + self.weights[-1]) / self.temperature


def _softmax(logits: np.ndarray) -> np.ndarray:
    found = np.exp(logits - logits.max(1, keepdims=True))
    return found / found.sum(1, keepdims=True)


def _matrix(rows: list[set[str]], features: list[str]) -> np.ndarray:
    place = {gram: at for at, gram in enumerate(features)}
    found = np.zeros((len(rows), len(features)))
    for at, row in enumerate(rows):
        found[at, [place[gram] for gram in row if gram in place]] = 1
    return found


def fit(
    lines: list[tuple[list[str], list[str]]], common: dict[str, int], n_lines: int, steps: int = 400, sparsity: float = 2e-4
) -> Model:
    """Train on varied templates and on lines of a corpus that hold no template.

    ``lines`` are their template n-grams and first words; ``common`` counts, of all
    ``n_lines`` such lines of the corpus, those that hold an n-gram.
    """
    random = np.random.default_rng(11)
    known = [grams(template) for _, template in NOTICES]
    features = sorted(g for g in set().union(*known) if common.get(g, 0) <= COMMON * n_lines)
    rows, classes, folds = [], [], []
    of_family = {family: 0 for family in FAMILIES}
    for family, whole in NOTICES:
        fold, of_family[family] = of_family[family] % FOLDS, of_family[family] + 1
        for variant in range(VARIANTS):
            kept = [w for w in whole if variant == 0 or random.random() > 0.15] or whole
            around = lines[int(random.integers(0, len(lines)))][1] if lines and variant % 2 else []
            rows.append(grams(kept + around))
            classes.append(FAMILIES.index(family) + 1)
            folds.append(fold)
    unknown = [set(found) for found, _ in lines]
    # A word alone is unknown text as well if many families have it.
    owners = {word: {family for family, template in NOTICES if word in template} for k in known for word in k}
    unknown += [{word} for word in sorted(owners) if " " not in word and len(owners[word]) > SHARED]
    unknown += [set()] * 50
    rows += unknown
    classes += [0] * len(unknown)
    folds += [at % FOLDS for at in range(len(unknown))]
    x, y, fold = _matrix(rows, features), np.array(classes), np.array(folds)
    weights = _descend(x, y, steps, sparsity)
    used = np.abs(weights[:-1]).sum(1) > 0
    model = Model([f for f, u in zip(features, used) if u], np.vstack([weights[:-1][used], weights[-1:]]), 1.0)
    # Calibration: the temperature under which rows are likeliest that a model was not
    # fitted to, nor to any variant of their template, though to others of the family.
    logits = np.zeros((len(y), weights.shape[1]))
    several = np.isin(y, [0, *(at + 1 for at, family in enumerate(FAMILIES) if of_family[family] > 1)])
    for held in range(FOLDS):
        inside = (fold != held) | ~several
        without = _descend(x[inside], y[inside], steps, sparsity)
        logits[~inside] = x[~inside] @ without[:-1] + without[-1]
    choices = np.geomspace(0.25, 4, 33)
    losses = [-np.log(_softmax(logits[several] / t)[np.arange(several.sum()), y[several]] + 1e-12).mean() for t in choices]
    model.temperature = float(choices[int(np.argmin(losses))])
    return model


def _descend(x: np.ndarray, y: np.ndarray, steps: int, sparsity: float) -> np.ndarray:
    """Weights (features and bias, classes) by proximal steps; classes count alike."""
    one_hot = np.eye(len(FAMILIES) + 1)[y]
    importance = (1 / np.maximum(np.bincount(y, minlength=len(FAMILIES) + 1), 1))[y]
    importance[y == 0] *= 4
    importance /= importance.sum()
    rows, weights = np.hstack([x, np.ones((len(y), 1))]), np.zeros((x.shape[1] + 1, len(FAMILIES) + 1))
    for _ in range(steps):
        error = _softmax(rows @ weights) - one_hot
        weights -= 4.0 * (rows.T @ (error * importance[:, None]))
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - 4.0 * sparsity, 0)
    return weights


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model for a corpus: n-grams are counted over all its lines, and the rows to
    fit are at most ``CORPUS_LINES`` different ones (by their hash), whole.

    Lines that hold a template, or of which most word pairs are a template's (a part of
    a wrapped notice), are no unknown text and left out of both.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line")).where("length(line) > 0")
    # Template n-grams only: a small and fixed set, so that rows are short.
    hashes = lines.select(F.xxhash64("line").alias("hash")).distinct().orderBy("hash").limit(CORPUS_LINES)
    counts = _unknown_lines(lines).select(F.explode(F.concat("grams", F.array(F.lit("")))).alias("gram"))
    common = {row["gram"]: row["count"] for row in counts.groupBy("gram").count().collect()}
    some = lines.withColumn("hash", F.xxhash64("line")).join(F.broadcast(hashes), "hash")
    # At most CORPUS_LINES rows, as equal lines count once.
    once = some.groupBy("hash").agg(F.min("line").alias("line"))
    rows = _unknown_lines(once, "hash").orderBy("hash").select("grams", F.slice("words", 1, AROUND).alias("head")).collect()
    # Every line also counts under the empty n-gram.
    return fit([(sorted(row["grams"]), row["head"]) for row in rows], common, common.get("", 0))


def _unknown_lines(lines: DataFrame, *kept: str) -> DataFrame:
    """(words, grams) of the lines that have words and are no part of a notice."""
    every = sorted(set().union(*(grams(template) for _, template in NOTICES)))
    pairs = [gram for gram in every if " " in gram]
    sizes = [sorted(grams(template)) for _, template in NOTICES]
    part = f"size(x.words) > 2 AND size(filter(x.held, gram -> gram IN ({_quoted(pairs)}))) >= {LEAST_SHARE}D * (size(x.words) - 1)"
    # The costly comparison is for lines that hold the larger part of a template in any order.
    near = f"""exists({_constant(sizes, 'array<array<string>>')}, template -> if(size(x.grams) >= 0.5D * size(template),
        size(array_intersect(template, x.grams)) >= 0.5D * size(template), false))"""
    line = "array(struct(0 AS first, array(size(x.known)) AS sizes, x.known AS known))"
    whole = _notices(_candidates(line))
    # One expression, as a filter on columns would compute them again for each mention.
    both = f"transform(transform(array({_words('line')}), words -> struct(words AS words, {_known('words')} AS known)), "
    held = f"""{both} x -> struct(x.words AS words, x.known AS known,
        concat({_among('x.known', every)}, {_among(_pairs('x.known'), every)}) AS held))"""
    distinct = f"""transform({held}, x -> struct(x.words AS words, x.known AS known, x.held AS held,
        array_distinct(x.held) AS grams))"""
    unknown = f"""filter({distinct}, x -> size(x.words) > 0 AND NOT if({part}, true, if({near}, size({whole}) > 0, false)))"""
    return lines.select(*kept, F.expr(f"inline(transform({unknown}, x -> struct(x.words AS words, x.grams AS grams)))"))


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _constant(value, kind: str) -> str:
    return f"from_json('{json.dumps(value)}', '{kind}')"


def _words(line: str) -> str:
    # Words are ASCII, so that lower() changes A-Z only.
    return f"transform(regexp_extract_all({line}, '[A-Za-z0-9]+', 0), word -> lower(word))"


def _known(words: str) -> str:
    """The words with null in the place of those that no template has."""
    every = sorted({word for _, template in NOTICES for word in template})
    return f"transform({words}, word -> if(word IN ({_quoted(every)}), word, null))"


def _pairs(known: str) -> str:
    """Words next to each other, in order; null where either is, and for the last."""
    pair = "if(a IS NULL, null, if(b IS NULL, null, concat(a, ' ', b)))"
    return f"zip_with({known}, slice({known}, 2, size({known})), (a, b) -> {pair})"


def _among(found: str, values) -> str:
    return f"filter({found}, gram -> gram IN ({_quoted(values)}))"


def _candidates(paragraphs: str) -> str:
    """Paragraphs with the stretches that could be a template, as template << 32 | start.

    A share of ``LEAST_SHARE`` takes a word pair of the template, and the pair's place in
    it says where the stretch starts. Paragraphs without any such pair are left out.
    """
    places: dict[str, list[dict[str, int]]] = {}
    for at, (_, template) in enumerate(NOTICES):
        for place, pair in enumerate(map(" ".join, zip(template, template[1:]))):
            places.setdefault(pair, []).append({"t": at, "place": place})
    hits = f"""filter(transform({_pairs('p.known')}, (pair, at) -> if(pair IN ({_quoted(places)}), struct(pair, at), null)),
        hit -> hit IS NOT NULL)"""
    starts = f"""array_distinct(flatten(transform({hits}, hit -> transform(
        element_at({_constant(places, 'map<string,array<struct<t:bigint,place:int>>>')}, hit.pair),
        o -> o.t * 4294967296 + greatest(hit.at - o.place, 0)))))"""
    return f"""filter(transform({paragraphs}, p -> struct(p.first AS first, p.sizes AS sizes,
        p.known AS known, {starts} AS starts)), p -> size(p.starts) > 0)"""


def _notices(paragraphs: str) -> str:
    """Confirmed stretches as (first, last, known, family, similarity), lines from 0.

    Of a template's words and word pairs those count that a stretch of its length and a
    quarter holds: words in the template's order (the longest common subsequence, by
    bits), pairs next to each other. Of stretches that mostly overlap the closest stays.
    """
    lengths = [len(template) for _, template in NOTICES]
    masks = [
        {word: sum(1 << at for at, w in enumerate(template) if w == word) for word in template} for _, template in NOTICES
    ]
    pairs = [sorted(set(map(" ".join, zip(template, template[1:])))) for _, template in NOTICES]
    n = f"element_at({_constant(lengths, 'array<int>')}, c.t + 1)"
    every = f"element_at({_constant([(1 << length) - 1 for length in lengths], 'array<bigint>')}, c.t + 1)"
    mask = f"coalesce(element_at(element_at({_constant(masks, 'array<map<string,bigint>>')}, c.t + 1), word), 0L)"
    own = f"element_at({_constant(pairs, 'array<array<string>>')}, c.t + 1)"
    in_order = f"""({n} - bit_count(aggregate(transform(c.stretch, word -> {mask}), {every},
        (v, m) -> ((v + (v & m)) | (v & ~m)) & {every})))"""
    share = f"({in_order} + size(array_intersect({own}, {_pairs('c.stretch')}))) / ({n} + size({own}))"
    stretches = f"""transform(transform(p.starts, code -> struct(int(code div 4294967296) AS t, int(code % 4294967296) AS start)),
        c -> struct(c.t AS t, c.start AS start, least(c.start + {n}, size(p.known)) AS stop,
            slice(p.known, c.start + 1, {n} + {n} div 4) AS stretch))"""
    close = f"""array_sort(filter(transform({stretches}, c -> struct(-({share}) AS far, c.t AS t, c.start AS start, c.stop AS stop)),
        c -> c.far <= -{LEAST_SHARE}D))"""
    kept = f"""aggregate({close}, cast(array() AS array<struct<far:double,t:int,start:int,stop:int>>), (kept, c) ->
        if(exists(kept, k -> 2 * (least(k.stop, c.stop) - greatest(k.start, c.start)) > least(k.stop - k.start, c.stop - c.start)),
            kept, concat(kept, array(c))))"""

    def line(place: str) -> str:
        return f"""p.first + aggregate(p.sizes, struct(0 AS words, 0 AS lines), (s, n) -> struct(s.words + n AS words,
            s.lines + if(s.words + n <= {place}, 1, 0) AS lines), s -> s.lines)"""

    family = f"element_at(array({_quoted(family for family, _ in NOTICES)}), k.t + 1)"
    return f"""flatten(transform({paragraphs}, p -> transform({kept}, k -> struct({line('k.start')} AS first,
        {line('k.stop - 1')} AS last, slice(p.known, k.start + 1, k.stop - k.start) AS known,
        {family} AS family, -k.far AS similarity))))"""


def scan(docs: DataFrame, model: Model, text: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with an array ``found`` of predictions, in order of lines.

    Each is (paragraph, family, probability, similarity, confirmed). A stretch of a
    paragraph that holds ``LEAST_SHARE`` of a template, and that the model takes for that
    family, is confirmed; ``paragraph`` is the line (from 0) where it starts, and
    ``similarity`` its share. A family is listed once per such line, however many lines a
    notice runs over and families a paragraph holds. Lines that the model takes for a
    family without such a stretch are predictions that are not confirmed; their
    similarity is the largest share of a template's n-grams in the line, in any order.
    What is likeliest unknown, or known with less than ``LEAST_PROBABILITY``, is left
    out; ``probability`` is that of the family. Null and
    empty texts have none. Words are letters and digits, so that they need no quoting.
    """
    lines = F.expr(
        f"""transform(transform(split({text}, '\n'), line -> {_words('line')}),
            (words, at) -> struct(at AS at, {_known('words')} AS known))"""
    )
    # A paragraph is a run of lines that have words; marks of comments are no words.
    firsts, ends = (
        f"""filter(transform({found}, (line, i) -> if(size(line.known) > 0 AND if({border}, true, size({found}[{beside}].known) = 0),
            {value}, null)), i -> i IS NOT NULL)"""
        for border, beside, value in (("i = 0", "i - 1", "i"), (f"i = size({found}) - 1", "i + 1", "i + 1"))
    )
    paragraphs = f"""transform(zip_with({firsts}, {ends}, (a, b) -> struct(a AS first,
        slice({found}, a + 1, b - a) AS lines)),
        p -> struct(p.first AS first, transform(p.lines, line -> size(line.known)) AS sizes,
            flatten(p.lines.known) AS known))"""

    def with_grams(part: str, kept: str, rest: str) -> str:
        return f"""filter(transform({part}, x -> struct({rest}, x.known AS known,
            array_distinct(concat({_among('x.known', model.features)}, {_among(_pairs('x.known'), model.features)})) AS grams)),
            x -> {kept})"""

    # Lines without a feature have the bias alone; they need no score if that is unknown.
    scored_lines = "size(x.grams) > 0" if int(np.argmax(model.weights[-1])) == 0 else "true"
    as_line = "x.at AS first, x.at AS last, string(null) AS wanted, double(null) AS similarity"
    as_notice = "x.first AS first, x.last AS last, x.family AS wanted, x.similarity AS similarity"
    parts = F.expr(f"struct({with_grams(found, scored_lines, as_line)} AS lines, {_candidates(paragraphs)} AS paragraphs)")
    notices = F.expr(f"struct({found}.lines AS lines, {_notices(found + '.paragraphs')} AS notices)")
    together = F.expr(f"concat({with_grams(found + '.notices', 'true', as_notice)}, {found}.lines)")
    by_gram = {gram: (row / model.temperature).tolist() for gram, row in zip(model.features, model.weights)}
    bias = (model.weights[-1] / model.temperature).tolist()
    rest = "x.first AS first, x.last AS last, x.wanted AS wanted, x.similarity AS similarity, x.known AS known"
    scored = F.expr(
        f"""transform({found}, x -> struct({rest},
            aggregate(x.grams, {_constant(bias, 'array<double>')}, (sums, gram) ->
                zip_with(sums, element_at({_constant(by_gram, 'map<string,array<double>>')}, gram), (a, b) -> a + b)) AS logits))"""
    )
    likeliest = F.expr(
        f"""filter(transform({found}, x -> struct({rest},
            element_at(array({_quoted((UNKNOWN, *FAMILIES))}), int(array_position(x.logits, array_max(x.logits)))) AS family,
            1 / aggregate(x.logits, 0D, (sum, y) -> sum + exp(y - array_max(x.logits))) AS probability,
            exp(x.logits[0] - array_max(x.logits)) AS unknown)),
            x -> x.family <> '{UNKNOWN}' AND 1 - x.unknown * x.probability >= {LEAST_PROBABILITY}
                AND coalesce(x.wanted, x.family) = x.family)"""
    )
    # Notices come first. A later one on the same line says nothing new, nor does a line of one.
    new = F.expr(
        f"""filter({found}, (x, i) -> NOT exists(filter({found}, (y, j) -> j < i AND y.wanted IS NOT NULL AND y.family = x.family),
            y -> if(x.wanted IS NULL, x.first BETWEEN y.first AND y.last, x.first = y.first)))"""
    )
    templates = {f: [sorted(grams(words)) for family, words in NOTICES if family == f] for f in FAMILIES}
    bag = f"""array_max(transform(element_at({_constant(templates, 'map<string,array<array<string>>>')}, x.family),
        template -> size(array_intersect(template, concat(x.known, {_pairs('x.known')}))) / size(template)))"""
    named = F.expr(
        f"""array_sort(transform({found}, x -> struct(x.first AS paragraph, x.family AS family, x.probability AS probability,
            if(x.wanted IS NULL, {bag}, x.similarity) AS similarity, x.wanted IS NOT NULL AS confirmed)))"""
    )
    for step in (lines, parts, notices, together, scored, likeliest, new, named):
        docs = docs.withColumn(found, step)
    empty = F.array().cast("array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>")
    return docs.withColumn(found, F.coalesce(found, empty))


def licences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, found), one row per row of ``docs``; see ``scan``.

    Repeated rows and null ids stay, an empty table gives no rows, other columns do
    not matter. ``n_paragraphs`` counts lines: a null text has none, an empty one one. The
    model is trained on ``docs`` unless one is given.
    """
    model = model or train(docs, text)
    content = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n_paragraphs = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    n_paragraphs = F.when(F.col("text").isNull(), 0).otherwise(n_paragraphs).alias("n_paragraphs")
    return scan(content, model).select("doc_id", n_paragraphs, "found")


def confirmed_families(found: Column) -> Column:
    """Sorted names of the families confirmed in a document."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda f: f["confirmed"]), lambda f: f["family"])))
