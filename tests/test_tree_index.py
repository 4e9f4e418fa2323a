"""Threshold index: margins of random ensembles, prefixes, missing values, several models; stored models."""

from __future__ import annotations

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from datescore.functions.fill import fill_missing
from datescore.operators import ensemble as E
from datescore.operators import model as M
from datescore.operators import sampling as S
from datescore.operators import tree_index as X
from datescore.plans import jobs
from datescore.schema import FEATURES, KEY, LABEL, PARTITION, USER
from datescore.sources import model_store

NAMES = [c.split()[0] for c in E.NODE_TABLE_SCHEMA.split(", ")]
FEATS = [f"f{i}" for i in range(6)]


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.1:
        return E.Leaf(rng.uniform(-1, 1))
    return E.Split(rng.choice(FEATS), rng.randint(0, 12) / 3, random_tree(rng, depth - 1), random_tree(rng, depth - 1), rng.random() < 0.5)


def full_tree(rng, depth):
    if depth == 0:
        return E.Leaf(rng.uniform(-1, 1))
    return E.Split(rng.choice(FEATS), rng.uniform(0, 4), full_tree(rng, depth - 1), full_tree(rng, depth - 1))


def value(node, row, missing_left=None):
    while isinstance(node, E.Split):
        v = row[FEATS.index(node.feature)]
        if np.isnan(v):
            left = bool(missing_left and missing_left[id(node)])
        else:
            left = v <= node.threshold if node.inclusive else v < node.threshold
        node = node.left if left else node.right
    return node.value


def table(ensemble):
    return pd.DataFrame(E.node_rows(ensemble), columns=NAMES)


def data(n, seed):
    x = np.random.default_rng(seed).integers(-2, 15, (n, len(FEATS))) / 3
    x[::5, 1] = np.nan
    return x


@pytest.mark.parametrize("seed", range(6))
def test_margins_equal_walking_the_trees(seed):
    rng = random.Random(seed)
    ensemble = [(rng.uniform(0.1, 2), random_tree(rng, rng.randint(0, 8))) for _ in range(rng.randint(1, 90))]
    x = data(700, seed)
    plain = [sum(w * value(t, row) for w, t in ensemble) for row in x]
    assert X.TreeIndex(table(ensemble), FEATS).margins(x)[:, 0] == pytest.approx(plain, abs=1e-9)


def test_long_masks_and_trees_walked_node_by_node():
    rng = random.Random(7)
    ensemble = [(1.0, full_tree(rng, d)) for d in (6, 7, 8, 9, 10)]
    index = X.TreeIndex(table(ensemble), FEATS)
    assert {g.words for g in index.groups} == {4} and len(index.deep[1]) == 2
    x = np.random.default_rng(1).uniform(0, 4, (600, len(FEATS)))
    assert index.margins(x)[:, 0] == pytest.approx([sum(value(t, r) for _, t in ensemble) for r in x], abs=1e-9)


def test_missing_values_go_where_the_node_says():
    rng = random.Random(8)
    ensemble = [(1.0, random_tree(rng, 5)) for _ in range(40)] + [(1.0, full_tree(rng, 9))]
    nodes = table(ensemble)
    sides = {}
    order = iter(rng.random() < 0.5 for _ in range(len(nodes)))
    flags = []
    for _, t in ensemble:  # in the order of ``node_rows``: a node, its left side, its right side

        def visit(n):
            flags.append(next(order) if isinstance(n, E.Split) else None)
            if isinstance(n, E.Split):
                sides[id(n)] = flags[-1]
                visit(n.left)
                visit(n.right)

        visit(t)
    x = data(400, 3)
    x[::3, :4] = np.nan
    got = X.TreeIndex(nodes.assign(missing_left=flags), FEATS).margins(x)[:, 0]
    assert got == pytest.approx([sum(value(t, r, sides) for _, t in ensemble) for r in x], abs=1e-9)


def test_several_models_in_one_pass():
    rng = random.Random(9)
    models = [[(1.0, random_tree(rng, 4)) for _ in range(rng.randint(1, 40))] for _ in range(7)]
    parts, trees = [], 0
    for k, ensemble in enumerate(models):
        part = table(ensemble).assign(model=k)
        parts.append(part.assign(tree=part["tree"] + trees))
        trees += len(ensemble)
    x = data(300, 4)
    got = X.TreeIndex(pd.concat(parts), FEATS).margins(x)
    assert got.shape == (300, 7)
    for k, ensemble in enumerate(models):
        assert got[:, k] == pytest.approx(X.TreeIndex(table(ensemble), FEATS).margins(x)[:, 0], abs=1e-9)


def test_edges():
    x = data(5, 1)
    assert X.TreeIndex(table([(2.0, E.Leaf(0.25))]), FEATS).margins(x)[:, 0].tolist() == [0.5] * 5
    assert X.TreeIndex(pd.DataFrame(columns=NAMES), FEATS).margins(x).tolist() == [[0.0]] * 5
    assert X.TreeIndex(table([(1.0, E.Leaf(1.0))]), FEATS).margins(x[:0]).shape == (0, 1)
    with pytest.raises(ValueError, match="not given"):
        X.TreeIndex(table([(1.0, E.Split("other", 1.0, E.Leaf(0), E.Leaf(1)))]), FEATS)
    shuffled = table([(1.0, E.Split("f0", 1.0, E.Leaf(0.0), E.Split("f1", 2.0, E.Leaf(5.0), E.Leaf(7.0))))])
    renumbered = shuffled.assign(**{c: shuffled[c] * 3 + 2 for c in ("node", "left", "right")}).sample(frac=1, random_state=1)
    assert X.TreeIndex(renumbered, FEATS).margins(x)[:, 0] == pytest.approx(X.TreeIndex(shuffled, FEATS).margins(x)[:, 0])


@pytest.fixture(scope="module")
def trained(features01):
    sample = S.class_sample(features01, 200)
    params = M.TreeParams(max_iter=6, max_depth=5, min_instances_per_node=1, subsampling_rate=1.0, feature_subset="all")
    return sample, M.train(sample, params)


def test_stored_pipeline_scores_like_mllib(spark, trained, tmpdir_path):
    sample, model = trained
    path = model_store.save_model(model, os.path.join(tmpdir_path, "m"), best_trees=4)
    for limit, trees in ((None, 4), (2, 2), (1500, 6)):
        assert model_store.trees_to_use(path, limit) == (limit or 4)
        index = model_store.load_index(path, limit)
        assert index.trees == trees
        a = X.score(index, sample, KEY).withColumnRenamed("score", "a")
        b = M.score(model, sample, keep=KEY, ntree_limit=trees).withColumnRenamed("score", "b")
        both = a.join(b, KEY)
        assert both.count() == 400 and both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    with pytest.raises(ValueError, match="no node table"):
        model_store.load_index(os.path.join(tmpdir_path, "none"))


def test_daily_rows_are_those_of_the_pipeline(spark, trained):
    sample, model = trained
    index = M.tree_index(model, 3)
    rows = {tuple(r) for r in jobs.score_with_model(sample, index).collect()}
    assert rows == {tuple(r) for r in jobs.score_with_model(sample, model, 3).collect()}
    plan = jobs.score_with_model(sample, index)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.count("ArrowEvalPython") == 1
    assert {r[0] for r in sample.select(USER).collect()} == {r[0] for r in rows} and {PARTITION, LABEL} <= set(sample.columns)
    summed = E.probability_column(M.to_ensemble(model), FEATURES, 3, M.MLLIB_MARGIN_SCALE, compiled=False)
    old = {r[0]: r[1] for r in fill_missing(sample, subset=FEATURES).select(F.concat_ws("|", *KEY), summed).collect()}
    new = {r[0]: r[1] for r in X.score(index, sample, [F.concat_ws("|", *KEY).alias("k")]).collect()}
    assert old.keys() == new.keys() and all(abs(old[k] - new[k]) < 1e-9 for k in old)
