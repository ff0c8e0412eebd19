"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; everything else counts as unlabelled,
a mixture of good and bad whose share of good ones, the class prior, is
estimated from the scores of a first fit. The classifier then minimises the
non-negative unbiased risk: with prior p and losses l,
``p E+[l(good)] + max(0, Eu[l(bad)] - p E+[l(bad)])``. It is a logistic model of
the text's form alone: shares of character classes, repeated words and word
pairs, marks glued to words, words without letters, length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = 20
#: Training rows looked at, at most about so many of each kind, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
#: Texts that a task turns into Python strings at once.
TEXTS = 256
THRESHOLD = 0.3
#: Added to a text's number of words before shares are taken, so that one odd word in a short text weighs little.
FEW_WORDS = 20
#: Features that only count against a text: capitals, digits, marks (glued on, alone, in all), repeats, saturated forms.
DEFECTS = [0, 1, 2, 5, 6, 7, 10, 11, 12, 14, 15, 16, 17]
_GLUED = re.compile(r"\w[^\w\s]{2,}(?!\S)")
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
_LIMIT = 0x3000


def _classes() -> np.ndarray:
    """Class of each code point below the limit: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 mark."""
    kinds = np.zeros(_LIMIT + 1, np.uint8)
    for c in range(_LIMIT):
        s = chr(c)
        kinds[c] = 2 if s.isupper() else 1 if s.isalpha() else 3 if s.isdigit() else 4 if s.isspace() else 5
    kinds[_LIMIT] = 1  # beyond: letters for the most part
    return kinds


def features(texts: list[str | None], classes: np.ndarray) -> np.ndarray:
    """One row per text; all values between 0 and about 1, all 0 for an empty or null text."""
    rows = np.zeros((len(texts), FEATURES))
    for i, text in enumerate(texts):
        if not text:
            continue
        points = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), _LIMIT)
        kinds = np.bincount(classes[points], minlength=6)
        chars = len(text)
        letters = max(1, kinds[1] + kinds[2])
        words = text.split()
        n = max(1, len(words))
        low = text.lower().split()
        m = n + FEW_WORDS
        pairs = max(0, len(low) - 1)
        shares = (
            kinds[2] / letters,
            kinds[3] / chars,
            kinds[5] / chars,
            kinds[4] / chars,
            kinds[0] / chars,
            len(_GLUED.findall(text)) / m,
            len(_BARE.findall(text)) / m,
            sum(map(eq, low, low[1:])) / m,
            (pairs - len(set(zip(low, low[1:])))) / m,
            (len(low) - len(set(low))) / m,
            text.count("!") / m,
            sum(text.count(c) for c in "|<>{}[]") / m,
            sum(text.count(c) for c in "*#$%&") / m,
            sum(text.count(c) for c in ".!?") / m,
        )
        # A share and its saturated form: the first few marks in a hundred words tell most.
        rows[i, :14] = np.minimum(shares, 1)
        rows[i, 14:18] = [s / (s + 0.2) for s in (shares[5], shares[6], shares[7], shares[10])]
        rows[i, 18] = min(1, np.log1p(n) / 10)
        rows[i, 19] = min(1, chars / n / 20)
    return rows


def _by_slices(texts: pa.Array, classes: np.ndarray) -> np.ndarray:
    """``features`` of a batch, of which only a slice at a time is Python strings."""
    found = [features(texts.slice(i, TEXTS).to_pylist(), classes) for i in range(0, len(texts), TEXTS)]
    return np.concatenate([np.zeros((0, FEATURES)), *found])


class QualityModel(NamedTuple):
    """Weights on standardised features, and the prior they were fitted with."""

    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -5, 5) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with logistic loss and a small ridge."""
    w, m, v = np.zeros(positive.shape[1] + 1), 0.0, 0.0
    p = np.hstack([positive, np.ones((len(positive), 1))])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        # Gradients of the mean losses: good on positives, bad on unlabelled and on positives.
        good = -(1 - _sigmoid(zp)) @ p / len(p)
        bad_u, bad_p = _sigmoid(zu) @ u / len(u), _sigmoid(zp) @ p / len(p)
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = prior * good + (bad_u - prior * bad_p) if rest >= 0 else -(bad_u - prior * bad_p)
        g = g + 1e-4 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w[DEFECTS] = np.minimum(w[DEFECTS], 0)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of good texts among the unlabelled, from scores of both.

    Above any cut the unlabelled hold at least prior times what the positives
    hold; the smallest ratio over the cuts is the estimate. Cuts keep at least a
    twentieth of the positives, so that the ratio isn't left to chance.
    """
    cuts = np.quantile(positive, np.linspace(0, 0.95, 96))
    ratios = [(unlabelled >= c).mean() / (positive >= c).mean() for c in cuts]
    return float(np.clip(min(ratios), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel:
    """Model from feature rows; without rows of either kind every score is 0.5."""
    width = FEATURES
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros(width), 0.0, np.zeros(width), np.ones(width), 0.5)
    mean, scale = positive.mean(0), np.maximum(positive.std(0), 0.05)
    p, u = (np.clip((x - mean) / scale, -5, 5) for x in (positive, unlabelled))
    w, b = _descend(p, u, 0.5, 200)
    prior = estimate_prior(p @ w + b, u @ w + b)
    w, b = _descend(p, u, prior)
    return QualityModel(w, b, mean, scale, prior)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 5, is 0. A null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def _sampled(key: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20) + 1)


def _feature_rows(docs: DataFrame, text: str) -> np.ndarray:
    def rows(batches: Iterator) -> Iterator:
        classes = _classes()
        for batch in batches:
            found = _by_slices(batch.column(0), classes)
            yield pa.RecordBatch.from_arrays([pa.array(found.tolist(), pa.list_(pa.float64()))], ["x"])

    table = docs.select(text).mapInArrow(rows, "x array<double>").toArrow()
    return np.array(table.column("x").to_pylist(), float).reshape(-1, FEATURES)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit on about ``sample_rows`` positives and as many unlabelled texts at most, chosen by a hash of the id.

    Held-out rows take no part. A document is a trusted positive if it has labels
    and all of them are 1; null labels and ids say nothing. Only feature rows
    come to the driver, twice ``sample_rows`` at most (give or take the hash).
    """
    good = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).alias("least"))
        .where("least = 1")
    )
    share = sample_rows / max(1, good.count())
    chosen = good.where(_sampled(F.col("key"), share)).select("key")
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(~held_out(F.col("key")))
    # The chosen ids are bounded by sample_rows.
    positive = _feature_rows(kept.join(F.broadcast(chosen), "key", "left_semi"), "text")
    share = sample_rows / max(1, docs.count())
    unlabelled = _feature_rows(kept.where(_sampled(F.struct(F.lit("any"), F.col("key")), share)), "text")
    return fit(positive, unlabelled)


def quality_score(model: QualityModel, text: Column) -> Column:
    """Column with the model's probability that a text is good, 0 to 1; null texts score as empty ones."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classes = _classes()
        for texts in batches:
            yield pa.array(model.score(_by_slices(texts, classes)))

    return score(F.coalesce(text, F.lit("")))


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Score every whole text: ``key, held_out, score, predicted`` (1 from a score of 0.3 on).

    Ids and labels choose the training rows and are never inputs of a score.
    Null ids and texts and repeated rows stay, one result each; other columns take
    no part. Without labels every score is 0.5. Scoring is one narrow pass.
    """
    model = train(docs, labels, key, text, label)
    scored = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), quality_score(model, F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
