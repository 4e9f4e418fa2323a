"""Jobs W1-W4 and plan properties."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001, SF01
from datescore.operators import ensemble as E
from datescore.operators import model as M
from datescore.plans import jobs
from datescore.schema import EXTRACT_SCHEMA
from datescore.sources import result_table, text
from datescore.sources.feature_table import read_feature_table, scan_partition, write_feature_table
from datescore.sources.fixture import features_from_dir


def test_daily_scoring_no_shuffle_and_idempotent(spark, tmpdir_path):
    f = features_from_dir(spark, SF001, training=False)
    src = read_feature_table(spark, write_feature_table(f, os.path.join(tmpdir_path, "f")))
    day = jobs.score_with_ensemble(scan_partition(src, "20240115"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters" in plan
    t = "test_daily_w1"
    result_table.drop_table(spark, t)
    result_table.create_result_table(spark, t, os.path.join(tmpdir_path, "t"))
    try:
        audit1 = jobs.daily_scoring(src, t, "2024-01-16", ensemble=E.FIXED_ENSEMBLE).collect()
        audit2 = jobs.daily_scoring(src, t, "2024-01-16").collect()
        jobs.daily_scoring(src, t, "2024-01-17", rebalance_output=True)
        n = f.where(F.col("dt") == "20240115").count()
        assert [tuple(r) for r in audit1] == [("20240115", n)] == [tuple(r) for r in audit2]
        counts = dict(result_table.partition_counts(spark.table(t)).collect())
        assert counts["20240115"] == n and "20240116" in counts
        res = spark.table(t).where("dt = '20240115'")
        assert res.where("q_ratio <= 0 OR q_ratio >= 1 OR q_ratio IS NULL").count() == 0
        assert res.select("user_name", "dep_date").distinct().count() == n
    finally:
        result_table.drop_table(spark, t)


def test_extract_job(spark, tmpdir_path):
    f = features_from_dir(spark, SF001, training=False)
    src = read_feature_table(spark, write_feature_table(f, os.path.join(tmpdir_path, "f")))
    out = jobs.extract_job(src, os.path.join(tmpdir_path, "tsv"), "2024-01-16")
    back = text.read_tsv(spark, out, EXTRACT_SCHEMA)
    assert back.count() == f.where(F.col("dt") == "20240115").count()


def test_train_evaluate_job(spark, tmpdir_path):
    f = features_from_dir(spark, SF01)
    params = M.TreeParams(max_iter=3, max_depth=3, min_instances_per_node=1)
    res = jobs.train_evaluate(f, 100, params, model_path=os.path.join(tmpdir_path, "m"), history_every=1, patience=1)
    assert dict(res.sizes.collect()) == {"positive": 100, "negative": 100, "holdout": f.count() - 200}
    assert res.best_trees in (1, 2, 3)
    assert os.path.isdir(os.path.join(tmpdir_path, "m", "stages"))
    assert res.reports["confusion"].count() >= 1


def _in_many_files(spark):
    """The training features in 12 files, as a large input has them."""
    from datescore.session import materialize

    table = materialize(features_from_dir(spark, SF01).repartition(12), "many-files")
    assert len(table.inputFiles()) == 12
    return table


def test_tuner_reads_its_rows_in_files_by_their_number(spark, monkeypatch):
    """The folds and the fits' rows stand in one file, however many tasks read the input; the largest fits start first."""
    from datescore.operators import tuning as TU

    seen, fits = [], []
    validate, estimator = TU._validate, M.estimator
    monkeypatch.setattr(TU, "_validate", lambda data, *a: seen.append(len(data.inputFiles())) or validate(data, *a))
    monkeypatch.setattr(M, "estimator", lambda p, f=None: fits.append(p.max_iter * p.max_depth) or estimator(p, f))
    box = {**TU.SEARCH_BOX, "max_depth": (2, 4), "n_estimators": (1, 4)}
    monkeypatch.setattr(TU, "SEARCH_BOX", box)
    trials, _, folded = jobs.tune(_in_many_files(spark), 60, init_points=3, n_iter=2, parallelism=1)
    assert seen == [1, 1] and len(folded.inputFiles()) == 1
    assert fits[:9] == sorted(fits[:9], reverse=True) and fits[9:] == sorted(fits[9:], reverse=True)
    assert folded.count() == 120 and trials.where("score between 0 and 1").count() == 5


def test_packed_rows_are_all_there(spark, monkeypatch):
    from datescore import session

    rows = spark.range(0, 1000, numPartitions=20)
    packed = session.materialize_packed(rows, "packed")
    assert len(packed.inputFiles()) == 1 and packed.exceptAll(rows).count() == 0 and packed.count() == 1000
    monkeypatch.setattr(session, "FILE_ROWS", 150)
    packed = session.materialize_packed(rows, "packed")
    assert len(packed.inputFiles()) == 7 and packed.exceptAll(rows).count() == 0 and packed.count() == 1000
    assert session.materialize_packed(rows.where("id < 0"), "packed").count() == 0


def test_training_reads_its_rows_in_files_by_their_number(spark, monkeypatch):
    """A sample of a many-file input is trained on in one partition: a level of a tree is no wave of near-empty tasks."""
    parts, train = [], M.train
    monkeypatch.setattr(M, "train", lambda df, p: parts.append(df.rdd.getNumPartitions()) or train(df, p))
    table = _in_many_files(spark)
    res = jobs.train_evaluate(table, 100, M.TreeParams(max_iter=2, max_depth=2, min_instances_per_node=1))
    assert parts == [1] and len(res.sample.inputFiles()) == 1
    assert dict(res.sizes.collect()) == {"positive": 100, "negative": 100, "holdout": table.count() - 200}


def test_ensemble_scoring_needs_every_feature(spark):
    import pytest

    f = features_from_dir(spark, SF001, training=False)
    with pytest.raises(ValueError, match="is_trader"):
        jobs.score_with_ensemble(f.drop("is_trader"))


def test_scratch_is_deleted_at_the_end_of_a_job(spark):
    from datescore.session import clear_scratch, materialize, scratch_mark

    mark = scratch_mark()
    df = materialize(spark.range(5), "scratch-test")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and df.count() == 5
    assert clear_scratch(spark, mark) == 1 and not os.path.exists(path)


def test_prefix_auc_matches_single(spark):
    f = features_from_dir(spark, SF001)
    per_k = {r.trees: r.auc for r in jobs.prefix_auc(f).collect()}
    assert set(per_k) == {1, 2, 3}


def test_duplicate_key_is_reported(spark, tmpdir_path):
    import pytest

    from datescore.operators.prepare import check_unique_key

    f = features_from_dir(spark, SF001, training=False).where(F.col("dt") == "20240115")
    check_unique_key(f)
    dup = f.unionByName(f.limit(1))
    with pytest.raises(ValueError, match="duplicate key"):
        check_unique_key(dup)
    src = read_feature_table(spark, write_feature_table(dup, os.path.join(tmpdir_path, "f")))
    with pytest.raises(ValueError, match="user_name"):
        jobs.daily_scoring(src, "never_created", "2024-01-16", validate_keys=True)


def test_daily_scoring_writes_csv_and_loads_it_back(spark, tmpdir_path):
    from datescore.schema import RESULT_SCHEMA

    f = features_from_dir(spark, SF001, training=False)
    src = read_feature_table(spark, write_feature_table(f, os.path.join(tmpdir_path, "f")))
    t, t2 = "test_daily_csv", "test_daily_csv_copy"
    for name in (t, t2):
        result_table.drop_table(spark, name)
        result_table.create_result_table(spark, name, os.path.join(tmpdir_path, name))
    try:
        csv = os.path.join(tmpdir_path, "csv")
        jobs.daily_scoring(src, t, "2024-01-16", csv_path=csv)
        back = text.read_result_csv(spark, csv, RESULT_SCHEMA)
        loaded = spark.table(t).drop("dt")
        assert back.exceptAll(loaded).count() == 0 and loaded.exceptAll(back).count() == 0
        result_table.load_csv_into_partition(spark, csv, t2, "20240115")
        assert spark.table(t2).exceptAll(spark.table(t)).count() == 0
    finally:
        for name in (t, t2):
            result_table.drop_table(spark, name)
