"""Ordinal regression: gradient, order of thresholds, held-out accuracy and edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from conftest import SF01
from datescore.llm import toxicity as X
from llm_corpus import empty, frame


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(1)
    truth = np.concatenate([rng.normal(2, 0.5, 5), rng.normal(-2, 0.5, 5), np.zeros(10)])
    rows = [np.flatnonzero(rng.random(20) < 0.3) for _ in range(4000)]
    margin = np.array([truth[r].sum() for r in rows]) + rng.logistic(size=4000) * 0.3
    grades = (margin > 1).astype(int) + (margin > 3)
    weights, thresholds = X.fit_ordinal(rows, grades, 20)
    assert thresholds[0] < thresholds[1]
    assert np.corrcoef(weights, truth)[0, 1] > 0.98
    model = X.OrdinalModel({}, thresholds)
    above = model.above(np.array([-50.0, 0.0, 50.0]))
    assert (above[:, 0] >= above[:, 1]).all() and above[0].sum() < 0.01 and above[2].sum() > 1.99


def _planted(n):
    rng = np.random.default_rng(3)
    words = [f"w{k}x" .replace("0", "o") for k in range(200)]
    plain = "abcdefghij"
    words = ["".join(plain[int(c)] for c in f"{k:04d}") for k in range(300)]
    bad = ["grumbo", "snarlfixes", "snarlfixed", "snarlfixing"]
    docs, labels = [], []
    for i in range(n):
        t = list(rng.choice(words, 40))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + i % 4):
                t[int(rng.integers(0, 40))] = str(rng.choice(bad))
        docs.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = _planted(3000)
    known = spark.createDataFrame(labels[:1500], "doc_id long, toxic int")
    model = X.train(frame(spark, docs), known)
    got = {r.doc_id: r for r in X.score_documents(frame(spark, docs), model).collect()}
    held = labels[1500:]
    assert np.mean([got[i].rejected == bool(t) for i, t in held]) > 0.995
    # Severity grows with the number of insults, the grade with it.
    mild, severe = ([got[i].severity for i, t in held if t and i % 4 == k] for k in (0, 3))
    assert np.mean(mild) < np.mean(severe) <= 2 and {got[i].grade for i, t in held if not t} == {0}


def test_public_table_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = X.score_documents(docs, X.train(docs, labels)).join(labels, "doc_id")
    right = got.where("rejected = (toxic = 1)").count() / got.count()
    assert right > 0.93


def test_recall_and_precision_on_held_out_rows(spark):
    """Fitted on three quarters of the labelled rows, judged on the rest: toxic rows are found and clean ones left alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted((r.doc_id, r.toxic) for r in labels.select("doc_id", "toxic").collect())
    known, held = [r for r in rows if r[0] % 4], dict(r for r in rows if r[0] % 4 == 0)
    model = X.train(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
    got = {r.doc_id: r.rejected for r in X.score_documents(docs, model).collect() if r.doc_id in held}
    hit = sum(got[i] and bool(t) for i, t in held.items() if i in got)
    assert hit / sum(held[i] for i in got) > 0.85 and hit / sum(got.values()) > 0.9
    # What the cross-fitting said of the sample holds for rows it never saw.
    assert model.held_out[0] == pytest.approx(hit / sum(held[i] for i in got), abs=0.08)
    assert 0 < model.reject < 2


def test_cutoff_is_chosen_between_the_classes():
    rng = np.random.default_rng(2)
    severity = np.concatenate([rng.uniform(0, 0.1, 900), rng.uniform(0.7, 1.8, 100)])
    toxic = np.repeat([0, 1], [900, 100])
    assert 0.3 < X.choose_cutoff(severity, toxic) < 0.5
    # A toxic row among the clean ones does not pull it down, a clean one far up does not pull it there.
    severity[950], severity[0] = 0.01, 1.79
    assert 0.1 < X.choose_cutoff(severity, toxic) < 0.7
    assert X.cross_fitted([np.array([0])] * 3, np.array([0, 0, 1]), 1) is None


def test_grades_do_not_come_from_the_row_itself():
    """A row is graded by the model of the other half: changing its label does not change its own score."""
    rng = np.random.default_rng(4)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(400)]
    grades = np.array([int(r.size and r[0] < 3) for r in rows])
    before = X.cross_fitted(rows, grades, 12)
    grades[10] = 1 - grades[10]
    after = X.cross_fitted(rows, grades, 12)
    assert before[10] == after[10] and (before != after).any()


def test_very_long_clean_documents_stay(spark):
    docs, labels = _planted(1500)
    model = X.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    clean = [t for (_, t), (_, toxic) in zip(docs, labels) if not toxic]
    long = [(k, " ".join(clean[k::3])) for k in range(3)]
    assert X.score_documents(frame(spark, long), model).where("rejected").count() == 0


def test_edge_cases(spark):
    docs, labels = _planted(800)
    model = X.train(frame(spark, docs), spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id long, toxic int"))
    odd = frame(spark, [(1, None), (1, ""), (None, "grumbo snarlfixed"), (2, "aaab " * 40_000 + "grumbo"), (2, "aaab")])
    got = sorted((r.doc_id or 0, r.rejected) for r in X.score_documents(odd, model).collect())
    assert got == [(0, True), (1, False), (1, False), (2, False), (2, True)]
    kept = X.drop_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2]
    none = X.train(frame(spark, docs), spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.thresholds == [] and X.drop_toxic(odd, none).count() == 5
    one = X.train(frame(spark, docs), spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert X.score_documents(odd, one).where("rejected").count() == 0
    assert X.score_documents(empty(spark), model).count() == 0 and X.train(empty(spark), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).thresholds == []


def test_sample_is_bounded_and_does_not_depend_on_partitions(spark):
    docs, labels = _planted(600)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    a = X.labelled_sample(frame(spark, docs, 1), known, 100)
    b = X.labelled_sample(frame(spark, docs, 5), known.repartition(4), 100)
    assert a.count() == 100 and a.exceptAll(b).count() == 0
    one, two = X.train(frame(spark, docs, 1), known), X.train(frame(spark, docs, 4), known)
    assert one.weights == pytest.approx(two.weights) and one.thresholds == pytest.approx(two.thresholds)
