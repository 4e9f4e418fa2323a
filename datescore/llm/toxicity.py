"""Toxicity (6): cumulative-link ordinal regression over sparse text features.

Severity has grades 0 (clean), 1 and 2. One weight vector w is shared by
all ordered thresholds: P(grade > k) = sigmoid(w . x - theta_k) with theta_0 <
theta_1, and the expected severity is the sum of these probabilities.

Features are the distinct words of the whole text and their beginnings of 4, 5
and 6 letters (lower case), so that inflected and compound forms share
evidence. Spark counts, over a bounded sample of labelled rows, in how many
toxic and clean documents each feature stands, and keeps the most telling; the
fit runs on these alone. The tables give one toxic bit, so the toxic training
rows are graded by what a model fitted on the other half of the sample says of
them (two-fold cross-fitting): 2 from the median toxic row on, else 1. A row's own
label and features take no part in the score that grades it.

The cutoff comes from the sample as well. The ordinal model of each half scores the
other half; the cutoff is the middle of the severities around the best one at which
the share of toxic rows found, less CLEAN_COST times the share of clean rows lost,
is within SLACK of its maximum.

At scale: scoring is one scan without a shuffle; what is broadcast (at most
MAX_FEATURES weights) does not depend on the input.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datescore.llm.common import arrow_schema, column, keep_rows, release, slices, texts_of, to_python, written

SAMPLE = 12_000  # labelled rows the model is fitted on, at most
MAX_FEATURES = 4_000
MIN_Z = 3.0  # of a feature's log odds ratio; only features that speak for toxicity are kept
L2 = 1e-5
STEPS = 400
CLEAN_COST = 5.0  # a share of clean rows lost weighs as much as this share of toxic rows missed
SLACK = 0.005
REJECT = 0.2  # the cutoff where the sample is too small to choose one

_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for k in (4, 5, 6):
        out.update([w[:k] + "*" for w in words if len(w) > k])
    return out


@dataclass
class OrdinalModel:
    """Weights of the features, the ordered thresholds and the cutoff; ``thresholds`` empty: nothing was learnt.

    ``held_out``: recall and precision at the cutoff over the cross-fitted rows of the sample, where there were enough.
    """

    weights: dict[str, float]
    thresholds: list[float]
    reject: float = REJECT
    held_out: tuple[float, float] | None = None

    def margin(self, text: str) -> float:
        w = self.weights
        return math.fsum([w[f] for f in features(text) if f in w])

    def above(self, margin: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k: (n, thresholds)."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None] - margin[:, None], -50, 50)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, l2: float = L2, steps: int = STEPS):
    """Maximum likelihood of the cumulative-link model by Adam: (weights, thresholds).

    ``rows`` holds each document's feature numbers. Thresholds stay ordered:
    each is the one before plus an exponential.
    """
    top = int(grades.max())
    at = np.concatenate(rows).astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n = len(rows)
    p = np.zeros(n_features + top)
    p[n_features] = 1.0
    m = np.zeros_like(p)
    v = np.zeros_like(p)
    for step in range(1, steps + 1):
        w, first, gaps = p[:n_features], p[n_features], np.exp(p[n_features + 1 :])
        theta = first + np.concatenate([[0.0], np.cumsum(gaps)])
        margin = np.bincount(doc, weights=w[at], minlength=n)
        # P(y <= k) with k = -1 .. top; the likelihood is the difference of neighbours.
        z = theta[None] - margin[:, None]
        cdf = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(-np.clip(z, -50, 50))), np.ones((n, 1))], axis=1)
        pdf = cdf * (1 - cdf)
        k = np.arange(n)
        like = np.maximum(cdf[k, grades + 1] - cdf[k, grades], 1e-12)
        up, low = pdf[k, grades + 1] / like, pdf[k, grades] / like
        d_margin = (up - low) / n
        d_theta = np.zeros(top)
        for j in range(top):
            d_theta[j] = (low[grades == j + 1].sum() - up[grades == j].sum()) / n
        grad = np.empty_like(p)
        grad[:n_features] = np.bincount(at, weights=d_margin[doc], minlength=n_features) + l2 * w
        grad[n_features] = d_theta.sum()
        for j in range(1, top):
            grad[n_features + j] = gaps[j - 1] * d_theta[j:].sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        rate = 0.1 * (1 - 0.5 * step / steps)
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(p[n_features + 1 :])
    return p[:n_features], (p[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])).tolist()


def cross_fitted(rows: list[np.ndarray], grades: np.ndarray, n_features: int) -> np.ndarray | None:
    """Expected severity of every row by the model of the other half; None where a half lacks a grade."""
    half = np.arange(len(rows)) % 2
    if any(set(grades[half == h]) != set(range(int(grades.max()) + 1)) for h in (0, 1)):
        return None
    out = np.zeros(len(rows))
    for h in (0, 1):
        weights, thresholds = fit_ordinal([rows[k] for k in np.flatnonzero(half != h)], grades[half != h], n_features)
        model = OrdinalModel({}, thresholds)
        out[half == h] = model.above(np.array([weights[rows[k]].sum() for k in np.flatnonzero(half == h)])).sum(axis=1)
    return out


def choose_cutoff(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The cutoff from scores that the rows' own labels did not make (see above)."""
    bad, clean = np.sort(severity[toxic == 1]), np.sort(severity[toxic == 0])
    steps = np.unique(np.concatenate([[0.0], severity, [severity.max() + 1e-6]]))
    at = (steps[1:] + steps[:-1]) / 2
    found = 1 - np.searchsorted(bad, at) / len(bad)
    lost = 1 - np.searchsorted(clean, at) / len(clean)
    gain = found - CLEAN_COST * lost
    best = int(gain.argmax())
    good = gain >= gain[best] - SLACK
    low, high = best, best
    while low > 0 and good[low - 1]:
        low -= 1
    while high + 1 < len(at) and good[high + 1]:
        high += 1
    return float((at[low] + at[high]) / 2)


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a feature, within a partition (bounded by the sample)."""
    counts = (Counter(), Counter())
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            counts[int(toxic)].update(features(text))
    names = list(counts[0].keys() | counts[1].keys())
    yield pd.DataFrame({"feature": names, "n0": [counts[0][f] for f in names], "n1": [counts[1][f] for f in names]})
    del counts, names
    release()


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic (0/1) of at most ``sample`` labelled documents, those with the least hash of doc_id.

    Rows without doc_id or label are left out; a doc_id labelled twice counts as toxic if any label says so.
    A text that stands under the doc_id more than once is taken once.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # the documented bound of the fit
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    return texts.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).select("doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on a bounded sample. Without rows of both classes the model is empty and rejects nothing."""
    rows = written(labelled_sample(docs, labels, sample), "toxicity-sample")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return OrdinalModel({}, [])
    counts = to_python(rows.select("text", "toxic")).mapInPandas(_feature_counts, "feature string, n0 long, n1 long")
    counts = counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    def odds(n: str, total: int):
        return F.log((F.col(n) + 0.5) / (F.lit(total) - F.col(n) + 0.5))

    ratio = odds("n1", sizes[1]) - odds("n0", sizes[0])
    spread = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = (
        counts.select("feature", ratio.alias("ratio"), (ratio / spread).alias("z"))
        .where(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(max_features)
        .collect()
    )
    number = {r.feature: k for k, r in enumerate(best)}

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = [sorted(number[f] for f in features(t) if f in number) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "at": at})

    # At most ``sample`` rows of feature numbers; sorted, so that the fit does not depend on partitions.
    table = rows.mapInPandas(numbers, "doc_id long, toxic int, at array<int>").toPandas().sort_values("doc_id")
    at = [np.asarray(a, dtype=np.int64) for a in table["at"]]
    toxic = table["toxic"].to_numpy()
    if not number:
        return OrdinalModel({}, [])
    grades, reject, held_out = toxic.astype(np.int64), REJECT, None
    told = cross_fitted(at, grades, len(number))
    if told is not None:
        grades = np.where(toxic == 0, 0, np.where(told >= np.median(told[toxic == 1]), 2, 1))
        severity = cross_fitted(at, grades, len(number))
        if severity is not None:
            reject = choose_cutoff(severity, toxic)
            said = severity >= reject
            held_out = (float(said[toxic == 1].mean()), float((toxic[said] == 1).mean()) if said.any() else 1.0)
    weights, thresholds = fit_ordinal(at, grades, len(number))
    return OrdinalModel({f: float(weights[k]) for f, k in number.items()}, thresholds, reject, held_out)


SCORES = "doc_id bigint, severity double, grade int, rejected boolean"


def _scores(model: OrdinalModel, texts: list[str], reject: float) -> tuple[list, list, list]:
    if not model.thresholds:
        return [0.0] * len(texts), [0] * len(texts), [False] * len(texts)
    above = model.above(np.array([model.margin(t) for t in texts]))
    severity = above.sum(axis=1)
    edges = np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], axis=1)
    grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)
    return severity.tolist(), grade.tolist(), (severity >= reject).tolist()


def score_documents(docs: DataFrame, model: OrdinalModel, reject: float | None = None) -> DataFrame:
    """Expected severity, likeliest grade and rejection (the model's cutoff, if none is given) of every row, from its whole text.

    Null and empty texts have no features and are scored by the thresholds
    alone (clean). Rows are independent: repeated or null doc_ids are scored
    like any other; other columns are not read.
    """

    reject = model.reject if reject is None else reject

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCORES)
        for batch in slices(batches, "text"):
            values = _scores(model, texts_of(batch), reject)
            arrays = [column(batch, "doc_id").cast(pa.int64())]
            arrays += [pa.array(v, f.type) for v, f in zip(values, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, SCORES)


def drop_toxic(docs: DataFrame, model: OrdinalModel, reject: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were.

    Null and empty texts are clean and stay, as does every row under an empty
    model; rows are judged alone, so repeated rows share their fate.
    """
    reject = model.reject if reject is None else reject
    return keep_rows(docs, lambda texts: [not r for r in _scores(model, texts, reject)[2]])
