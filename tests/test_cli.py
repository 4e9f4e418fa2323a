"""The command line drives the jobs end to end (in-process, same session)."""

from __future__ import annotations

import os

from datescore.__main__ import main


def test_features_extract_daily(spark, tmpdir_path, capsys):
    feats = os.path.join(tmpdir_path, "features")
    assert main(["features", "--events", "/root/testdata/sf0.001/events.parquet", "--out", feats]) == 0
    tsv = os.path.join(tmpdir_path, "tsv")
    assert main(["extract", "--features", feats, "--out", tsv, "--run-date", "2024-01-16"]) == 0
    assert os.path.isdir(tsv)
    table = "cli_results"
    try:
        assert main([
            "daily", "--features", feats, "--table", table, "--location", os.path.join(tmpdir_path, "t"),
            "--run-date", "2024-01-16", "--validate-keys",
        ]) == 0
        out = capsys.readouterr().out
        assert "20240115\t" in out
        assert spark.table(table).count() == int(out.strip().splitlines()[-1].split("\t")[1])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_train_and_tune(spark, tmpdir_path, capsys):
    feats = os.path.join(tmpdir_path, "training")
    main(["features", "--events", "/root/testdata/sf0.01/events.parquet", "--out", feats, "--training"])
    model = os.path.join(tmpdir_path, "model")
    assert main([
        "train", "--training", feats, "--n-sample", "100", "--model-out", model,
        "--max-iter", "3", "--max-depth", "3", "--history-every", "1", "--patience", "1",
    ]) == 0
    assert os.path.isdir(os.path.join(model, "stages"))
    assert '"best_trees"' in capsys.readouterr().out
    assert main(["tune", "--training", feats, "--n-sample", "60", "--init-points", "2", "--n-iter", "1",
                 "--parallelism", "2", "--out", os.path.join(tmpdir_path, "trials")]) == 0
    assert spark.read.parquet(os.path.join(tmpdir_path, "trials")).count() == 3


def test_train_from_tsv(spark, tmpdir_path, capsys):
    """W3 from a header TSV, as the reference reads its training file (S2 -> S3 -> W3)."""
    from datescore.schema import TRAINING_COLUMNS
    from datescore.sources import text
    from datescore.sources.fixture import features_from_dir

    tsv = text.write_tsv(features_from_dir(spark, "/root/testdata/sf0.01").select(*TRAINING_COLUMNS), os.path.join(tmpdir_path, "train.tsv"))
    model = os.path.join(tmpdir_path, "model")
    assert main(["train", "--training-tsv", tsv, "--n-sample", "80", "--model-out", model,
                 "--max-iter", "2", "--max-depth", "2", "--history-every", "1"]) == 0
    out = capsys.readouterr().out
    assert '"holdout"' in out and os.path.isdir(os.path.join(model, "stages"))


def test_daily_with_saved_model(spark, tmpdir_path, capsys):
    """W3 saves a model (S9); W1 loads it (S10) and scores yesterday's partition."""
    train_feats = os.path.join(tmpdir_path, "training")
    main(["features", "--events", "/root/testdata/sf0.01/events.parquet", "--out", train_feats, "--training"])
    model = os.path.join(tmpdir_path, "model")
    main(["train", "--training", train_feats, "--n-sample", "100", "--model-out", model,
          "--max-iter", "3", "--max-depth", "3", "--history-every", "0"])
    feats = os.path.join(tmpdir_path, "features")
    main(["features", "--events", "/root/testdata/sf0.01/events.parquet", "--out", feats])
    table = "cli_model_results"
    try:
        assert main(["daily", "--features", feats, "--table", table, "--location", os.path.join(tmpdir_path, "t"),
                     "--run-date", "2024-01-16", "--model", model, "--rebalance-output"]) == 0
        assert "20240115\t239" in capsys.readouterr().out
        scores = spark.table(table).where("q_ratio <= 0 OR q_ratio >= 1 OR q_ratio IS NULL").count()
        assert scores == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_table_operations(spark, tmpdir_path, capsys):
    """Create, load by hand (a file with other names and dates), peek, audit, drop a day, drop the table."""
    csv = os.path.join(tmpdir_path, "result.csv")
    with open(csv, "w") as fh:
        fh.write("who,dep_date,q_ratio\nu1,2019/7/5,0.5\nu2,2019/7/16,0.25\n")
    table = "cli_ops"
    try:
        main(["create-table", "--table", table, "--location", os.path.join(tmpdir_path, "t")])
        for dt in ("20190701", "20190702"):
            main(["load", "--table", table, "--csv", csv, "--dt", dt, "--user-column", "who"])
        capsys.readouterr()
        main(["audit", "--table", table, "--days", "1"])
        assert capsys.readouterr().out.split() == ["20190702", "2"]
        main(["peek", "--table", table, "--rows", "1", "--order-by", "dt", "user_name"])
        assert capsys.readouterr().out.split() == ["u1", "2019-07-05", "0.5", "20190701"]
        main(["drop-partition", "--table", table, "--dt", "20190702"])
        assert [r.dt for r in spark.table(table).select("dt").distinct().collect()] == ["20190701"]
        main(["drop-table", "--table", table])
        assert not spark.catalog.tableExists(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_training_parameters_and_evaluate(spark, tmpdir_path, capsys):
    import json

    from datescore.operators import model as M
    from datescore.sources import model_store

    feats = os.path.join(tmpdir_path, "training")
    main(["features", "--events", "/root/testdata/sf0.01/events.parquet", "--out", feats, "--training"])
    model = os.path.join(tmpdir_path, "model")
    main(["train", "--training", feats, "--n-sample", "100", "--model-out", model, "--max-iter", "2", "--max-depth", "2",
          "--gamma", "0.01", "--subsample", "0.5", "--colsample", "0.5", "--min-child-rows", "3", "--max-bins", "16",
          "--history-every", "1", "--patience", "1"])
    g = M.gbt_stage(model_store.load_model(model))
    assert (g.getMaxIter(), g.getMinInfoGain(), g.getSubsamplingRate(), g.getMinInstancesPerNode(), g.getMaxBins()) == (2, 0.01, 0.5, 3, 16)
    assert g.getFeatureSubsetStrategy() == "0.5" and model_store.load_best_trees(model) in (1, 2)
    capsys.readouterr()
    main(["evaluate", "--training", feats, "--model", model])
    reports = json.loads(capsys.readouterr().out)
    assert set(reports) == {"class_report", "metrics", "confusion", "auc"} and 0 <= reports["auc"][0]["auc"] <= 1


def test_boost_evaluate_and_score_a_day(spark, tmpdir_path, capsys):
    """A second-order model from the command line: trained, judged with the trees it chose, and scoring a day."""
    import json

    from datescore.sources import model_store

    feats, model = (os.path.join(tmpdir_path, n) for n in ("training", "booster"))
    main(["features", "--events", "/root/testdata/sf0.01/events.parquet", "--out", feats, "--training"])
    capsys.readouterr()
    main(["boost", "--training", feats, "--n-sample", "100", "--model-out", model, "--max-iter", "12", "--max-depth", "2", "--eta", "0.5",
          "--reg-alpha", "0.5", "--max-bins", "16", "--history-every", "2", "--patience", "4"])
    report = json.loads(capsys.readouterr().out)
    assert report["best_trees"] == model_store.load_best_trees(model) <= report["trees"] <= 12
    assert [h[0] for h in report["history"][::2]] == list(range(2, report["trees"] + 1, 2))
    main(["evaluate", "--training", feats, "--model", model])
    assert 0 <= json.loads(capsys.readouterr().out)["auc"][0]["auc"] <= 1
    table = "t_cli_boost"
    try:
        main(["daily", "--features", feats, "--run-date", "2024-01-16", "--table", table, "--location", os.path.join(tmpdir_path, "r"),
              "--model", model, "--best-trees"])
        rows = spark.table(table)
        assert rows.count() == spark.read.parquet(feats).where("dt = '20240115'").count() > 0
        assert rows.where("q_ratio <= 0 or q_ratio >= 1 or q_ratio is null").count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
