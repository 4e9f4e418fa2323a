"""Second-order boosting: trees against a plain implementation, missing values, stopping; quantile summaries."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from datescore.operators import boosting as B
from datescore.operators import quantiles as Q
from datescore.operators.tree_index import margin_column

FEATS = ["a", "b", "c", "d"]
EXACT = B.BoostParams(
    rounds=3, max_depth=3, eta=0.3, subsample=1.0, colsample_bytree=1.0, colsample_bylevel=1.0, max_bins=255, block=3, early_stopping_rounds=99
)


def rows(n, seed, missing=0.2):
    """``a`` and ``b`` matter; a missing ``c`` means class 1 more often; ``d`` is constant."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.randint(0, 9) / 4, float(rng.randint(0, 30))
        c = None if rng.random() < missing else rng.random() * 5
        p = 0.15 + 0.3 * (a > 1) + 0.2 * (b > 20) + 0.3 * (c is None)
        if rng.random() < 0.05:
            a = math.nan
        out.append((i, a, b, c, 1.0, int(rng.random() < p)))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, label int").repartition(parts)


def plain_trees(data, params):
    """The same trees by loops over rows and all thresholds."""
    x = [[math.nan if v is None else v for v in r[1:5]] for r in data]
    y = [r[5] for r in data]
    margin = [0.0] * len(data)
    out = []

    def sums(idx, grad):
        return sum(grad[i][0] for i in idx) / B.UNIT, sum(grad[i][1] for i in idx) / B.UNIT

    def score(g, h):
        t = math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)
        return t * t / (h + params.reg_lambda)

    def grow(idx, depth, grad):
        g, h = sums(idx, grad)
        best = None
        for f in range(4):
            values = sorted({x[i][f] for i in range(len(x)) if not math.isnan(x[i][f])})
            for t in [*values[1:], math.inf]:
                for missing_left in (False, True):
                    if t == math.inf and missing_left:
                        continue
                    left = [i for i in idx if (missing_left if math.isnan(x[i][f]) else x[i][f] < t)]
                    right = [i for i in idx if i not in set(left)]
                    if not left or not right:
                        continue
                    (gl, hl), (gr, hr) = sums(left, grad), sums(right, grad)
                    if min(hl, hr) < params.min_child_weight:
                        continue
                    gain = score(gl, hl) + score(gr, hr) - score(g, h)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, f, t, missing_left, left, right)
        if depth == params.max_depth or best is None:
            t = math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)
            return {"value": -params.eta * t / (h + params.reg_lambda), "g": g, "h": h}
        gain, f, t, missing_left, left, right = best
        node = {"f": f, "t": t, "ml": missing_left, "l": grow(left, depth + 1, grad), "r": grow(right, depth + 1, grad)}
        if "value" in node["l"] and "value" in node["r"] and gain < params.gamma:
            s = math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)
            return {"value": -params.eta * s / (h + params.reg_lambda), "g": g, "h": h}
        return node

    def value(node, row):
        while "value" not in node:
            v = row[node["f"]]
            node = node["l"] if (node["ml"] if math.isnan(v) else v < node["t"]) else node["r"]
        return node["value"]

    for _ in range(params.rounds):
        g, h = B.gradients(np.array(margin), np.array(y, dtype=float))
        tree = grow(list(range(len(x))), 0, list(zip(g.tolist(), h.tolist())))
        out.append(tree)
        margin = [m + value(tree, r) for m, r in zip(margin, x)]
    return out, margin


def as_dict(booster, k):
    t = booster.trees[k]

    def node(i):
        if t.feature[i] < 0:
            return {"value": t.value[i], "g": t.g[i], "h": t.h[i]}
        f, cuts = t.feature[i], booster.cuts[t.feature[i]]
        threshold = cuts[t.bin[i]] if t.bin[i] < len(cuts) else math.inf
        return {"f": f, "t": threshold, "ml": t.missing_left[i], "l": node(t.left[i]), "r": node(t.right[i])}

    return node(0)


def same(a, b):
    if "value" in a or "value" in b:
        return "value" in a and "value" in b and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    return (a["f"], a["t"], a["ml"]) == (b["f"], b["t"], b["ml"]) and same(a["l"], b["l"]) and same(a["r"], b["r"])


@pytest.mark.parametrize("extra", [{}, {"reg_alpha": 0.0, "reg_lambda": 0.0, "gamma": 0.0}, {"min_child_weight": 5.0, "gamma": 2.0}, {"max_depth": 5}])
def test_trees_equal_a_plain_booster(spark, extra):
    data, params = rows(200, 1), EXACT.replace(**extra)
    booster = B.train(frame(spark, data), params, features=FEATS, key=["id"])
    trees, margin = plain_trees(data, params)
    for k, tree in enumerate(trees):
        assert same(as_dict(booster, k), tree), k
    index = booster.index(params.rounds)
    got = {r.id: r.m for r in frame(spark, data).select("id", margin_column(spark, index).alias("m")).collect()}
    assert [got[r[0]] for r in data] == pytest.approx(margin, abs=1e-9)


def test_trees_do_not_depend_on_partitions_or_blocks(spark):
    data = rows(400, 2)
    params = EXACT.replace(rounds=4, subsample=0.7, colsample_bytree=0.8, colsample_bylevel=0.8, block=4)
    one = B.train(frame(spark, data, 1), params, features=FEATS, key=["id"])
    seven = B.train(frame(spark, data, 7), params.replace(block=1), features=FEATS, key=["id"])
    assert one.nodes().equals(seven.nodes()) and [len(c) for c in one.cuts] == [len(c) for c in seven.cuts]


def test_planted_missingness_is_learnt(spark):
    """Class 1 only where ``c`` is missing: one split, missing values on their own side."""
    rng = random.Random(4)
    data = [(i, rng.random(), float(rng.randint(0, 5)), None if i % 4 == 0 else rng.random(), 1.0, int(i % 4 == 0)) for i in range(300)]
    booster = B.train(frame(spark, data), EXACT.replace(rounds=5, block=5, max_depth=2), features=FEATS, key=["id"])
    assert all(t.feature[0] == FEATS.index("c") for t in booster.trees)
    scores = frame(spark, data).select("label", margin_column(spark, booster.index(5)).alias("m")).collect()
    assert min(r.m for r in scores if r.label) > 0 > max(r.m for r in scores if not r.label)
    assert booster.history[-1][2] == 1.0
    # Zero instead of missing hides it among the values.
    assert booster.nodes()["missing_left"].dropna().isin([True, False]).all()


def test_patience_stops_the_training(spark):
    """Labels of the validation rows are noise: no mark after the first few is better for long."""
    rng = random.Random(5)
    data = [(*r[:5], r[5] if r[0] % 2 else rng.randint(0, 1)) for r in rows(400, 5)]
    params = EXACT.replace(rounds=400, block=2, early_stopping_rounds=6, eta=0.5)
    booster = B.train(frame(spark, data), params, is_val=F.col("id") % 2 == 0, features=FEATS, key=["id"])
    marks = [k for k, name, _ in booster.history if name == "val"]
    assert marks == list(range(2, len(booster.trees) + 1, 2)) and len(booster.trees) < 400
    val = {k: a for k, name, a in booster.history if name == "val"}
    assert val[booster.best_trees] == max(val.values()) and len(booster.trees) - booster.best_trees == 6
    assert min(k for k, a in val.items() if a == max(val.values())) == booster.best_trees
    # The history is that of the scored prefixes.
    from datescore.operators.metrics import auc

    df = frame(spark, data).withColumn("set", F.when(F.col("id") % 2 == 0, "val").otherwise("train"))
    for k in (2, booster.best_trees):
        scored = df.select("set", "label", margin_column(spark, booster.index(k)).alias("score"))
        assert {r["set"]: r["auc"] for r in auc(scored, by=["set"]).collect()} == pytest.approx({n: a for m, n, a in booster.history if m == k})


def test_refused_and_empty_inputs(spark):
    with pytest.raises(Exception, match="neither 0 nor 1"):
        B.train(frame(spark, [(1, 1.0, 1.0, 1.0, 1.0, 3)]), EXACT, features=FEATS, key=["id"])
    with pytest.raises(ValueError, match="no rows"):
        B.train(frame(spark, rows(5, 1)), EXACT, is_val=F.lit(True), features=FEATS, key=["id"])
    one_class = B.train(frame(spark, [(*r[:5], 1) for r in rows(30, 1)]), EXACT.replace(rounds=2, block=1), features=FEATS, key=["id"])
    assert {a for _, _, a in one_class.history} == {None} and one_class.best_trees == len(one_class.trees)


# --- quantile summaries -------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(8))
def test_merged_ranks_stay_within_their_bounds(seed):
    rng = np.random.default_rng(seed)
    size = 50
    counter, xs, ws = Q._Counter(size), [], []
    for _ in range(rng.integers(1, 40)):
        x = np.round(rng.normal(size=rng.integers(1, 400)), int(rng.integers(0, 4)))
        w = rng.integers(1, 9, len(x)).astype(float)
        counter.add(Q.exact(x, w))
        xs.append(x)
        ws.append(w)
    s, x, w = counter.result(), np.concatenate(xs), np.concatenate(ws)
    assert len(s.value) <= size + 2 and s.total == w.sum() and s.value[0] == x.min() and s.value[-1] == x.max()
    for v, lo, hi, own in zip(s.value, s.below, s.through, s.weight):
        less, upto = w[x < v].sum(), w[x <= v].sum()
        assert lo <= less + 1e-9 and upto <= hi + 1e-9 and own <= upto - less + 1e-9
    levels = math.ceil(math.log2(len(xs) + 1)) + 2
    assert s.error() <= 2 * levels / size
    for share in (0.1, 0.5, 0.9):
        v = s.values_at(np.array([share * w.sum()]))[0]
        rank = np.array([w[x < v].sum(), w[x <= v].sum()]) / w.sum()
        assert rank[0] - 2 * levels / size <= share <= rank[1] + 2 * levels / size


def test_distributed_summary(spark):
    rng = random.Random(8)
    data = [(i, rng.gauss(0, 1), float(rng.randint(0, 6)), None if i % 3 else rng.random(), math.nan, 0) for i in range(5000)]
    found = Q.summaries(frame(spark, data, 9), FEATS, 100, F.lit(2.0))
    a, b, c, d = found
    values = np.array(sorted(r[1] for r in data))
    assert a.total == 10_000 and len(a.value) <= 102 and a.error() < 0.1
    for v, lo, hi in zip(a.value, a.below, a.through):
        assert lo <= 2 * np.searchsorted(values, v) and 2 * np.searchsorted(values, v, side="right") <= hi
    assert b.value.tolist() == [0, 1, 2, 3, 4, 5, 6] and b.error() == 0
    assert b.weight.tolist() == [2.0 * sum(r[2] == k for r in data) for k in range(7)]
    assert c.total == 2 * sum(r[3] is not None for r in data) and len(d.value) == 0 and d.total == 0
    assert Q.cut_points(b, 255).tolist() == [1, 2, 3, 4, 5, 6] and len(Q.cut_points(a, 16)) == 15 and len(Q.cut_points(d, 16)) == 0
