"""Quality classifier learnt from trusted positives and a mixture of all web text.

A linear model on the shape of a text (which kinds of characters follow which, how
often words repeat) is fitted by minimising the non-negative unbiased risk: the loss
of positives as positives, plus what unlabelled texts lose as negatives minus the part
of it that is due to the positives among them. That difference is a risk and cannot be
below zero; where a batch makes it so, the step goes the other way. The part is the
class prior, estimated as the least ratio of unlabelled to positive texts among those
that a first model ranks above a threshold: where no negatives are left, it is the
share of positives.

Fitting uses a bounded sample (``TRUSTED_ROWS`` and ``UNLABELLED_ROWS``, taken by the
smallest hashes of doc_id); scores are computed for every row from the whole text.
"""

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratemill.llm.tables import columns_of, unused

TRUSTED_ROWS = 8192
UNLABELLED_ROWS = 16384
#: Rows of a sample below which nothing is learnt: half of them have to tell a prior.
LEAST_ROWS = 8
FOLDS = 5
THRESHOLD = 0.3
#: Counts are divided by the length plus this, so that short texts say little.
SMOOTHING = 40
#: Characters whose kinds are counted at once.
CHARACTERS_AT_ONCE = 1 << 20

#: Marks with a kind of their own, then kinds of Unicode categories.
MARKS = ".,!?|-'\"\n "
KINDS = {"Lu": 0, "Lt": 0, "Ll": 1, "Lo": 1, "Lm": 1, "Mn": 1, "Mc": 1, "Nd": 2, "Nl": 2, "No": 2, "Po": 3, "Ps": 3, "Pe": 3}
OTHER = 4
N_KINDS = OTHER + 1 + len(MARKS)
N_FEATURES = N_KINDS * N_KINDS + 2


def kinds_table() -> np.ndarray:
    """Kind of every character of the basic plane; those beyond count as other."""
    kinds = [KINDS.get(unicodedata.category(chr(point)), OTHER) for point in range(1 << 16)]
    for at, mark in enumerate(MARKS):
        kinds[ord(mark)] = OTHER + 1 + at
    return np.array(kinds, np.uint8)


def features(text: str, kinds: np.ndarray) -> np.ndarray:
    """Roots of smoothed shares: pairs of character kinds, repeated words."""
    pairs = np.zeros(N_KINDS * N_KINDS)
    for at in range(0, len(text), CHARACTERS_AT_ONCE):
        piece = text[at : at + CHARACTERS_AT_ONCE + 1]
        points = np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4")
        kind = kinds[np.minimum(points, 0xFFFF)].astype(np.int64)
        pairs += np.bincount(kind[:-1] * N_KINDS + kind[1:], minlength=len(pairs))
    words = text.split()
    repeated = [sum(map(eq, words, words[1:])), len(words) - len(set(words))]
    shares = np.append(pairs / (len(text) + SMOOTHING), np.array(repeated) / (len(words) + SMOOTHING))
    return np.sqrt(shares)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    centre: np.ndarray
    scale: np.ndarray
    prior: float = float("nan")

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre) / self.scale @ self.weights + self.bias

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -40, 40)))


def _fit(trusted, unlabelled, prior: float | None, steps: int = 1500, batch: int = 512) -> Model:
    """Adam on the non-negative risk, or without a prior on telling the two samples apart."""
    centre = unlabelled.mean(0)
    scale = unlabelled.std(0) + 0.01
    p, u = (trusted - centre) / scale, (unlabelled - centre) / scale
    random = np.random.default_rng(7)
    theta = np.zeros(p.shape[1] + 1)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        some_p = p[random.integers(0, len(p), batch)]
        some_u = u[random.integers(0, len(u), batch)]
        sp = 1 / (1 + np.exp(-(some_p @ theta[:-1] + theta[-1])))
        su = 1 / (1 + np.exp(-(some_u @ theta[:-1] + theta[-1])))
        # Gradients by the logit: sp - 1 of a positive's loss, s of a loss as negative.
        positive, p_negative, u_negative = (sp - 1) / batch, sp / batch, su / batch
        if prior is None:
            on_p, on_u = positive, u_negative
        else:
            rest = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            if rest >= 0:
                on_p, on_u = prior * (positive - p_negative), u_negative
            else:
                on_p, on_u = prior * p_negative, -u_negative
        gradient = np.append(some_p.T @ on_p + some_u.T @ on_u + 1e-4 * theta[:-1], on_p.sum() + on_u.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.03 * (1 - step / (steps + 1))
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:-1], float(theta[-1]), centre, scale)


def class_prior(trusted_scores: np.ndarray, unlabelled_scores: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of the two samples'
    shares above a threshold that half of the positives or more reach. Each share
    counts with one standard error to the safe side: a prior that is too high takes
    negatives for positives, one that is as much too low hardly matters."""
    thresholds = np.quantile(trusted_scores, np.linspace(0, 0.5, 51))
    p, u = (np.array([(scores >= t).mean() for t in thresholds]) for scores in (trusted_scores, unlabelled_scores))
    error_p, error_u = (np.sqrt(x * (1 - x) / n) for x, n in ((p, len(trusted_scores)), (u, len(unlabelled_scores))))
    return float(np.clip(((u - error_u) / (p + error_p)).min(), 0.01, 0.99))


def fit(trusted: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of two samples of features. With fewer than ``LEAST_ROWS`` rows in
    either, no prior can be told, and every score is a half."""
    if min(len(trusted), len(unlabelled)) < LEAST_ROWS:
        nothing = np.zeros(N_FEATURES)
        return Model(nothing, 0.0, nothing, nothing + 1)
    # Half of each sample ranks the other half: on rows it was fitted to, the ranking
    # would be too good for positives and the prior too low.
    fitted, judged = slice(None, None, 2), slice(1, None, 2)
    apart = _fit(trusted[fitted], unlabelled[fitted], None)
    prior = class_prior(apart.score(trusted[judged]), apart.score(unlabelled[judged]))
    model = _fit(trusted, unlabelled, prior)
    model.prior = prior
    return model


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS))


def _rows(texts: pd.Series, kinds: np.ndarray) -> Iterator[np.ndarray]:
    return (features(text or "", kinds) for text in texts)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    trusted_rows: int = TRUSTED_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """Fit on documents outside fold 0: those labelled 1, against a mixture of all.

    The mixture is a sample of all such documents, with whatever label or none, so that
    it stands for the corpus however many labels there are. Rows with a null doc_id, and
    labels of no document, are not used; a null label is none. A document that has
    several rows is used once in either sample.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    known = known.where("doc_id is not null and label is not null")
    ids = docs.select(F.col(doc_id).alias("doc_id")).where("doc_id is not null").distinct()
    outside = fold_of(F.col("doc_id")) != 0
    order = F.xxhash64("doc_id"), F.col("doc_id")
    positive = known.where(outside & (F.col("label") == 1)).select("doc_id").distinct()
    positive = positive.join(ids, "doc_id", "left_semi").orderBy(*order).limit(trusted_rows)
    mixture = ids.where(outside).orderBy(*order).limit(unlabelled_rows)
    return fit(*_measured(docs, positive, mixture, text, doc_id))


def _measured(docs: DataFrame, positive: DataFrame, other: DataFrame, text: str, doc_id: str) -> list[np.ndarray]:
    """Features of the documents of two samples of ids."""
    sample = positive.withColumn("trusted", F.lit(True)).union(other.withColumn("trusted", F.lit(False)))
    kinds = kinds_table()

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [row.astype("<f4").tobytes() for row in _rows(batch["text"], kinds)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "samples": batch["samples"], "features": found})

    # A document may be in both samples.
    sample = sample.groupBy("doc_id").agg(F.collect_set("trusted").alias("samples"))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    # At most trusted_rows + unlabelled_rows rows, one per id, of N_FEATURES small numbers.
    rows = (
        chosen.mapInPandas(measured, f"doc_id {kind}, samples array<boolean>, features binary")
        .groupBy("doc_id")
        .agg(F.first("samples").alias("samples"), F.min("features").alias("features"))
        .orderBy("doc_id")
        .collect()
    )
    return [
        np.frombuffer(b"".join(row["features"] for row in rows if which in row["samples"]), "<f4")
        .reshape(-1, N_FEATURES)
        .astype(np.float64)
        for which in (True, False)
    ]


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability, by the model, that the text is of good quality.

    Null texts count as empty; every row gets a score. A column ``name`` of ``docs``
    must not exist.
    """
    kinds = kinds_table()

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        found = [model.score(row) for row in _rows(texts, kinds)]
        return pd.Series(found, dtype="float64")

    return docs.withColumn(name, scores(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    ``held_out`` tells documents that no label was learnt from (fold 0; a null doc_id
    counts as the empty text). Null and empty texts are scored too, repeated rows stay,
    an empty table gives no rows; too few positives (``LEAST_ROWS``), or none, give
    scores of a half.
    """
    model = learn(docs, labels, text, doc_id)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score(chosen, model).select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` or more, in the columns of ``docs``.

    Null and empty texts are scored like any other, repeated rows one by one. Without
    labels every score is a half, so that all rows stay; an empty table gives no rows.
    """
    (name,) = unused(docs, "score")
    model = learn(docs, labels, **columns)
    scored = score(docs, model, columns.get("text", "text"), name)
    return scored.where(F.col(name) >= threshold).select(*columns_of(docs))
