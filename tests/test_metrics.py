"""Metrics from counts (A2-A11) and the distributed tie-aware AUC."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from datescore.operators import metrics as MT


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def frame(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.3, 0.5, 0.7, 0.9]) | st.floats(0, 1), st.integers(0, 1)), min_size=1, max_size=60))
def test_auc_matches_brute_force(spark, rows):
    got = MT.auc(frame(spark, rows), buckets=4).first()
    exp = brute_auc(rows)
    if exp is None:
        assert got.auc is None
    else:
        assert got.auc == pytest.approx(exp, abs=1e-12)
    assert got.positives == sum(y for _, y in rows)


def test_auc_invariant_under_monotone_map(spark):
    rows = [(i / 50.0, int(i % 3 == 0 or i > 35)) for i in range(50)]
    a = MT.auc(frame(spark, rows)).first().auc
    b = MT.auc(frame(spark, rows).withColumn("score", F.exp(F.col("score") * 3) - 7)).first().auc
    assert a == pytest.approx(b, abs=1e-15)


def test_auc_by_group_and_buckets(spark):
    rows = [(float(i % 17), i % 2, i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "score double, label int, g int")
    got = {r.g: r.auc for r in MT.auc(df, by=["g"], buckets=8).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(brute_auc([(s, y) for s, y, gg in rows if gg == g]), abs=1e-12)


def test_labels_must_be_binary(spark):
    with pytest.raises(Exception, match="0 or 1"):
        MT.auc(frame(spark, [(0.1, 2), (0.2, 1), (0.3, 0)])).collect()


def pairs(spark, rows):
    return spark.createDataFrame(rows, "true_label int, prediction_label int")


def test_confusion_and_reports(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(0, 0)] * 4
    p = pairs(spark, rows)
    cm = {r.prediction_label: (r.true_0, r.true_1) for r in MT.confusion_matrix(p).collect()}
    assert cm == {1: (2, 3), 0: (4, 1)}
    m = {r.metric: r.value for r in MT.binary_metrics(p).collect()}
    assert m["accuracy"] == pytest.approx(0.7)
    assert m["precision"] == pytest.approx(3 / 5)
    assert m["recall"] == pytest.approx(3 / 4)
    assert m["f1"] == pytest.approx(2 * 3 / (2 * 3 + 2 + 1))
    assert m["auc_hard"] == pytest.approx((3 / 4 + 4 / 6) / 2)
    rep = {r["class"]: r for r in MT.class_report(p).collect()}
    assert rep["0"].precision == pytest.approx(4 / 5) and rep["0"].support == 6
    assert rep["macro avg"].recall == pytest.approx((3 / 4 + 4 / 6) / 2)
    assert rep["weighted avg"].f1 == pytest.approx((rep["0"].f1 * 6 + rep["1"].f1 * 4) / 10)
    assert rep["accuracy"].f1 == pytest.approx(0.7) and rep["accuracy"].precision is None


def test_absent_cells_are_null_and_zero_division(spark):
    p = pairs(spark, [(0, 0), (1, 0), (0, 0)])
    cm = MT.confusion_matrix(p).collect()
    assert len(cm) == 1 and cm[0].prediction_label == 0 and (cm[0].true_0, cm[0].true_1) == (2, 1)
    m = {r.metric: r.value for r in MT.binary_metrics(p).collect()}
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0
    one_class = {r.metric: r.value for r in MT.binary_metrics(pairs(spark, [(0, 0), (0, 1)])).collect()}
    assert one_class["auc_hard"] is None


def test_cells_sum_to_n(spark):
    rows = [(i % 2, (i // 3) % 2) for i in range(41)]
    c = MT.confusion_counts(pairs(spark, rows)).first()
    assert c.tp + c.fp + c.fn + c.tn == c.n == 41


def test_subset_sizes(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "role string")
    assert dict(MT.subset_sizes(df, "role").collect()) == {"a": 2, "b": 1}


def test_histogram_reports_equal_row_reports(spark):
    """Reports from a score histogram equal the reports from the rows."""
    from datescore.operators.prepare import label_prediction_pairs

    rows = [(round((i * 37 % 100) / 100, 2), int(i % 3 == 0)) for i in range(300)] + [(0.5, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    hist = MT.score_histogram(df)
    for inclusive in (False, True):
        by_rows = label_prediction_pairs(df, inclusive=inclusive)
        by_hist = MT.histogram_pairs(hist, inclusive=inclusive)
        assert MT.confusion_matrix(by_rows).orderBy("prediction_label").collect() == MT.confusion_matrix(
            by_hist, weight="w"
        ).orderBy("prediction_label").collect()
        assert sorted(MT.class_report(by_rows).collect()) == sorted(MT.class_report(by_hist, weight="w").collect())
        assert sorted(MT.binary_metrics(by_rows).collect()) == sorted(MT.binary_metrics(by_hist, weight="w").collect())
    assert MT.auc(df).first() == MT.auc_from_histogram(hist).first()


def test_many_distinct_scores_many_buckets(features01):
    """Thousands of distinct scores over 256 buckets equal one global ordered pass."""
    from pyspark.sql import Window

    scored = features01.select(
        "label", ((F.abs(F.xxhash64("user_name", "dt", "dep_date_of_search")) % 5000) / 5000.0).alias("score")
    )
    ours = MT.auc(scored, buckets=256).first()
    hist = MT.score_histogram(scored)
    w = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # test-sized data only
    ranked = hist.withColumn("nb", F.coalesce(F.sum("_neg").over(w), F.lit(0)))
    num, p, n = ranked.agg(
        F.sum(F.col("_pos") * (2 * F.col("nb") + F.col("_neg"))), F.sum("_pos"), F.sum("_neg")
    ).first()
    assert hist.count() > 3000
    assert ours.auc == num / (2 * p * n)


def test_auc_does_not_depend_on_the_number_of_buckets(spark):
    rows = [((i * 7919) % 997 / 997, int((i * 31) % 5 == 0)) for i in range(3000)]
    two = MT.auc(frame(spark, rows), buckets=2).first()
    many = MT.auc(frame(spark, rows), buckets=1000).first()
    assert two == many and two.auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_of_an_empty_set_is_null_with_zero_counts(spark):
    empty = frame(spark, [(0.5, 1)]).where("score > 1")
    assert tuple(MT.auc(empty).first()) == (None, 0, 0)
    assert MT.auc(empty.withColumn("g", F.lit(1)), by=["g"]).count() == 0


def test_heavy_buckets_are_cut_again(spark):
    """Scores crowd in a narrow range that the first cuts do not tell apart; every bucket ends small, the AUC is exact."""
    import random

    rng = random.Random(3)
    rows = [(0.5 + rng.random() * 1e-9, int(rng.random() < 0.4)) for _ in range(6000)] + [(float(k), k % 2) for k in range(-50, 50)]
    hist = MT.score_histogram(frame(spark, rows)).persist()
    cuts = MT.bucket_cuts(hist, 100)
    sizes = [r["count"] for r in MT._bucketed(hist, cuts).groupBy("_bk").count().collect()]
    assert max(sizes) <= 200 and len(cuts) < 400
    many = MT._auc_from_distinct(hist, [], cuts).first()
    one = MT._auc_from_distinct(hist, [], []).first()
    assert many == one and one.positives + one.negatives == len(rows)
    assert MT.bucket_cuts(hist, 10_000) == []


def test_one_score_in_many_groups_cannot_be_cut(spark):
    df = spark.range(3000).select(F.col("id").alias("g"), F.lit(0.25).alias("score"), (F.col("id") % 2).cast("int").alias("label"))
    hist = MT.score_histogram(df, by=["g"])
    assert len(MT.bucket_cuts(hist, 100)) <= 1
