"""Fixed ensemble scoring (M10, F2) and prefix margins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from datescore.functions.fill import fill_missing
from datescore.operators import ensemble as E
from datescore.operators import metrics as MT
from datescore.operators.prepare import label_prediction_pairs
from datescore.schema import FEATURES


def scored(features):
    filled = fill_missing(features, subset=FEATURES)
    return filled.select("label", E.probability(E.FIXED_ENSEMBLE).alias("score"))


def test_fixture_results(features01):
    """FIXTURES.md §4 at sf0.01."""
    s = scored(features01)
    r = s.agg(F.min("score"), F.max("score"), F.countDistinct("score")).first()
    assert round(r[0], 6) == 0.214165 and round(r[1], 5) == 0.71095 and r[2] == 21
    c = MT.confusion_counts(label_prediction_pairs(s, inclusive=False)).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (153, 1448, 760, 5200)
    assert round(MT.auc(s).first().auc, 6) == 0.464985


def test_strict_vs_inclusive_at_exactly_half(spark):
    df = spark.createDataFrame([(0.5, 1)], "score double, label int")
    strict = label_prediction_pairs(df, inclusive=False).first().prediction_label
    inclusive = label_prediction_pairs(df, inclusive=True).first().prediction_label
    assert (strict, inclusive) == (0, 1)


def test_prefix_and_node_arrays_agree(features01):
    filled = fill_missing(features01, subset=FEATURES)
    udf, marks = E.prefix_margins_udf(E.FIXED_ENSEMBLE, FEATURES, [1, 2, 3])
    out = filled.select(
        udf(*[F.col(c) for c in FEATURES]).alias("m"),
        E.margin(E.FIXED_ENSEMBLE, 1).alias("m1"),
        E.margin(E.FIXED_ENSEMBLE, 2).alias("m2"),
        E.margin(E.FIXED_ENSEMBLE).alias("m3"),
    ).collect()
    for r in out:
        assert np.allclose(r.m, [r.m1, r.m2, r.m3], atol=1e-12)


def test_missing_is_zero_after_fill(spark):
    row = {c: None for c in FEATURES}
    df = spark.createDataFrame([row], ", ".join(f"{c} double" for c in FEATURES))
    m = fill_missing(df).select(E.margin(E.FIXED_ENSEMBLE).alias("m")).first().m
    # rate 0 < 0.3, pre_days 0 < 3: -0.6; student 0 < 0.5: -0.1; history 0 < 0.25, date_cnt 0 < 2: 0.7
    assert m == pytest.approx(-0.6 - 0.1 + 0.7)


def test_node_table_roundtrip_and_vectorised_form(spark, features01):
    nodes = E.node_table(spark, E.FIXED_ENSEMBLE)
    assert nodes.count() == 17
    back = E.from_node_table(nodes)
    assert back == E.FIXED_ENSEMBLE
    filled = fill_missing(features01, subset=FEATURES)
    case_scores = filled.select(E.probability_column(back, FEATURES).alias("p"))
    udf_scores = filled.select(E.probability_column(back, FEATURES, compiled=False).alias("p"))
    a = [r.p for r in case_scores.collect()]
    b = [r.p for r in udf_scores.collect()]
    assert a == b


def test_case_and_arrays_agree_on_boundary_values(spark):
    """Splits of one tree that compare differently, at and around their thresholds."""
    tree = E.Split(
        "x", 1.0, E.Split("y", 1.0, E.Leaf(-1.0), E.Leaf(2.0), inclusive=False), E.Leaf(0.25), inclusive=True
    )
    other = E.Split("y", 1.0, E.Leaf(0.5), E.Split("x", 1.0, E.Leaf(-0.5), E.Leaf(0.125)), inclusive=True)
    values = [(a, b) for a in (0.0, 1.0, np.nextafter(1.0, 2.0), 2.0) for b in (0.0, 1.0, np.nextafter(1.0, 0.0), 2.0)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in values], "x double, y double")
    ensemble = [(1.0, tree), (0.5, other)]
    both = df.select(
        E.probability_column(ensemble, ["x", "y"], margin_scale=2.0).alias("case"),
        E.probability_column(ensemble, ["x", "y"], margin_scale=2.0, compiled=False).alias("arrays"),
    ).collect()
    assert [r["case"] for r in both] == [r.arrays for r in both]
    assert len({r.arrays for r in both}) > 3
    again = E.from_node_table(E.node_table(spark, ensemble))
    assert again == ensemble
