"""Model operators on Spark ML (M1-M7, S9, S10) and tuning."""

from __future__ import annotations

import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from datescore.functions.fill import fill_missing
from datescore.operators import ensemble as E
from datescore.operators import model as M
from datescore.operators import sampling as S
from datescore.operators import tuning as TU
from datescore.schema import FEATURES, KEY, LABEL
from datescore.sources import model_store

SMALL = M.TreeParams(max_iter=4, max_depth=3, min_instances_per_node=1, subsampling_rate=1.0, feature_subset="all")


@pytest.fixture(scope="module")
def trained(features01):
    sample = S.class_sample(features01, 200)
    return sample, M.train(sample, SMALL)


def test_prefix_margin_equals_weighted_sum(trained):
    sample, model = trained
    g = M.gbt_stage(model)
    assert len(g.trees) == 4
    p2 = M.prefix_model(model, 2)
    filled = fill_missing(sample.select(*FEATURES), subset=FEATURES)
    ens = M.to_ensemble(model)
    out = p2.transform(filled).select(
        vector_to_array("rawPrediction")[1].alias("raw"),
        E.margin(ens, 2).alias("m2"),
        E.probability(ens, 2, margin_scale=M.MLLIB_MARGIN_SCALE).alias("p2"),
        vector_to_array("probability")[1].alias("prob"),
    ).collect()
    for r in out:
        assert r.raw == pytest.approx(r.m2, abs=1e-9)
        assert r.prob == pytest.approx(r.p2, abs=1e-9)


def test_save_load_roundtrip(trained, tmpdir_path):
    sample, model = trained
    path = model_store.save_model(model, os.path.join(tmpdir_path, "m"))
    back = model_store.load_model(path)
    a = M.score(model, sample, keep=KEY).withColumnRenamed("score", "a")
    b = M.score(back, sample, keep=KEY).withColumnRenamed("score", "b")
    j = a.join(b, KEY)
    assert j.count() == 400 and j.where(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_ntree_limit_and_history(trained):
    sample, model = trained
    full = M.score(model, sample, keep=KEY, ntree_limit=1500)
    assert full.count() == 400
    sets = sample.withColumn("set", F.lit("val"))
    hist = M.auc_history(model, sets, every=1)
    assert sorted(r.trees for r in hist.collect()) == [1, 2, 3, 4]
    best = M.early_stop(hist, patience=50)
    assert 1 <= best <= 4


def test_early_stop_patience(spark):
    hist = spark.createDataFrame(
        [("val", k, a) for k, a in [(1, 0.6), (2, 0.7), (3, 0.69), (4, 0.69), (5, 0.8)]], "set string, trees int, auc double"
    )
    assert M.early_stop(hist, patience=2) == 2
    assert M.early_stop(hist, patience=3) == 5


@pytest.mark.parametrize("every,patience", [(1, 1), (50, 50), (100, 50), (7, 3)])
def test_early_stop_rising_history_takes_the_last_mark(spark, every, patience):
    """Marks further apart than the patience: a mark that improves is never skipped."""
    rows = [("val", k, k / 10_000) for k in range(every, 20 * every + 1, every)]
    assert M.early_stop(spark.createDataFrame(rows, "set string, trees int, auc double"), patience) == 20 * every
    falling = [("val", k, 1 - k / 10_000) for k in range(every, 20 * every + 1, every)]
    assert M.early_stop(spark.createDataFrame(falling, "set string, trees int, auc double"), patience) == every


def test_prefix_model_keeps_first_trees_and_the_whole_model(trained):
    _, model = trained
    g = M.gbt_stage(model)
    first = M.gbt_stage(M.prefix_model(model, 3))
    assert first.getNumTrees == 3 and first.treeWeights == g.treeWeights[:3]
    assert M.prefix_model(model, 4) is model and M.prefix_model(model, 1500) is model


def test_missing_feature_is_an_error(trained):
    sample, model = trained
    with pytest.raises(ValueError, match="ota_date_cnt"):
        M.score(model, sample.drop("ota_date_cnt"), keep=KEY)


def test_choice_of_trees_is_stored_with_the_model(trained, tmpdir_path):
    _, model = trained
    path = model_store.save_model(model, os.path.join(tmpdir_path, "m"), best_trees=3)
    assert model_store.load_best_trees(path) == 3
    assert M.gbt_stage(model_store.load_model(path)).getNumTrees == 4
    bare = model_store.save_model(model, os.path.join(tmpdir_path, "bare"))
    assert model_store.load_best_trees(bare) is None


def test_evaluate_reports(trained, features01):
    sample, model = trained
    held = S.holdout(features01, 200)
    rep = M.evaluate(M.score(model, held, keep=[*KEY, LABEL]))
    sizes = {r["class"]: r.support for r in rep["class_report"].collect()}
    assert sizes["0"] + sizes["1"] == held.count()
    assert {r.metric for r in rep["metrics"].collect()} == {"accuracy", "auc_hard", "recall", "f1", "precision"}
    assert 0 <= rep["auc"].first().auc <= 1


def test_search_and_best_trial(features01):
    folded = S.fold_assign(S.class_sample(features01, 60))
    trials = TU.search(folded, init_points=2, n_iter=1, parallelism=2)
    rows = trials.collect()
    assert [r.stage for r in rows] == ["random", "random", "guided"]
    assert all(0 <= r.score <= 1 for r in rows)
    params = TU.trial_params(trials).collect()
    assert all(isinstance(r.max_depth, int) and 2 <= r.max_depth <= 15 and r.n_estimators >= 1 for r in params)
    best = TU.best_trial(trials).first()
    assert best.score == max(r.score for r in rows)


def test_best_trial_ties_lowest_id(spark):
    t = spark.createDataFrame([(0, 1.0, 0.5), (1, 2.0, 0.9), (2, 3.0, 0.9)], "trial_id int, p double, score double")
    assert TU.best_trial(t).first().trial_id == 1


def test_f3_truncation():
    p = TU.Point(7.9, 0.4, 0.05, 0.01, 0.8).params(TU.TUNER_BASE)
    assert (p.max_depth, p.max_iter) == (7, 1)


def test_one_pass_over_the_folds_scores_like_each_model(spark, features01):
    """Every (point, fold) AUC from the shared indexes equals that of the model scored alone."""
    from datescore.operators.metrics import auc
    from datescore.operators.sampling import fold_assign
    from datescore.session import materialize

    folded = materialize(fold_assign(S.class_sample(features01, 200)), "folds")
    base = TU.TUNER_BASE.replace(seed=7)
    points = [TU.Point(2.9, 3.2, 0.2, 0.0, 1.0), TU.Point(4.0, 2.0, 0.1, 0.0, 0.8)]
    got = TU.cross_validate(folded, points, base, parallelism=4)
    for point, mean in zip(points, got):
        aucs = []
        for k in range(3):
            data = M.training_frame(folded, keep=["fold"])
            model = M.estimator(point.params(base)).fit(data.where(F.col("fold") != k))
            scored = M.score(model, folded.where(F.col("fold") == k), keep=[LABEL])
            aucs.append(auc(scored).first()["auc"])
        assert mean == pytest.approx(sum(aucs) / 3, abs=1e-9)
    assert not [p for p in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if "fold-models" in p]


def test_prefix_over_connect_says_what_to_use(monkeypatch):
    monkeypatch.setattr(M, "is_remote", lambda: True)
    with pytest.raises(RuntimeError, match="load_index"):
        M.prefix_model(None, 3)
