"""Command line for the jobs (``python -m datescore <job> ...``, or via spark-submit).

Jobs: ``daily`` (W1), ``extract`` (W2), ``train`` (W3), ``evaluate`` (a saved
model), ``tune`` (W4), ``features`` (derive the feature table from an events
table), and the operations on the result table: ``create-table``, ``load``,
``drop-partition``, ``peek``, ``audit``, ``drop-table``. Every job runs in one
Spark application; the session comes from the environment (spark-submit) and
only falls back to local mode when none is configured. The work folders a job
made are deleted when it ends.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from datescore.functions.dates import previous_day_value
from datescore.operators import boosting as B
from datescore.operators import model as M
from datescore.plans import jobs
from datescore.schema import TRAINING_SCHEMA
from datescore.session import clear_scratch, scratch_mark
from datescore.sources import model_store, result_table, text
from datescore.sources.feature_table import read_feature_table, write_feature_table
from datescore.sources.fixture import build_features


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("datescore")
    active = SparkSession.getActiveSession()
    if active is None:
        from datescore.session import JOB_CONF

        for k, v in JOB_CONF.items():
            builder = builder.config(k, v)
    return builder.getOrCreate()


def _features(spark: SparkSession, args) -> DataFrame:
    if args.features_table:
        return spark.table(args.features_table)
    return read_feature_table(spark, args.features)


def _training(spark: SparkSession, args) -> DataFrame:
    if args.training_tsv:
        return text.read_tsv(spark, args.training_tsv, TRAINING_SCHEMA)
    return read_feature_table(spark, args.training, training=True)


def _params(args) -> M.TreeParams:
    return M.TreeParams(
        max_iter=args.max_iter,
        max_depth=args.max_depth,
        step_size=args.eta,
        min_info_gain=args.gamma,
        subsampling_rate=args.subsample,
        feature_subset=str(args.colsample),
        min_instances_per_node=args.min_child_rows,
        max_bins=args.max_bins,
        seed=args.seed,
    )


def _print_rows(df: DataFrame) -> None:
    """The rows of a small result, tab-separated."""
    for r in df.collect():
        print("\t".join("NULL" if v is None else str(v) for v in r))


def cmd_daily(spark: SparkSession, args) -> None:
    result_table.create_result_table(spark, args.table, args.location)
    if args.best_trees and not (args.model and model_store.load_best_trees(args.model)):
        raise SystemExit("--best-trees needs --model with a stored choice of early stopping")
    limit = None if args.best_trees else args.ntree_limit
    model = model_store.load_index(args.model, limit) if args.model else None
    audit = jobs.daily_scoring(
        _features(spark, args),
        args.table,
        args.run_date,
        model=model,
        validate_keys=args.validate_keys,
        csv_path=args.csv,
        rebalance_output=args.rebalance_output,
    )
    _print_rows(audit)


def cmd_extract(spark: SparkSession, args) -> None:
    out = jobs.extract_job(_features(spark, args), args.out, args.run_date)
    print(out)


def _boost_params(args) -> B.BoostParams:
    return B.BoostParams(
        rounds=args.max_iter,
        max_depth=args.max_depth,
        eta=args.eta,
        reg_lambda=args.reg_lambda,
        reg_alpha=args.reg_alpha,
        gamma=args.gamma,
        min_child_weight=args.min_child_weight,
        subsample=args.subsample,
        colsample_bytree=args.colsample_bytree,
        colsample_bylevel=args.colsample_bylevel,
        early_stopping_rounds=args.patience,
        seed=args.seed,
        max_bins=args.max_bins,
        block=args.history_every,
    )


def cmd_boost(spark: SparkSession, args) -> None:
    res = jobs.train_boosted(
        _training(spark, args), args.n_sample, _boost_params(args), args.model_out, args.threshold, args.ntree_limit
    )
    report = {name: [r.asDict() for r in df.collect()] for name, df in res.reports.items()}
    report["sizes"] = [r.asDict() for r in res.sizes.collect()]
    report |= {"trees": len(res.booster.trees), "best_trees": res.booster.best_trees, "history": res.booster.history}
    print(json.dumps(report, default=str, indent=1))


def cmd_train(spark: SparkSession, args) -> None:
    res = jobs.train_evaluate(
        _training(spark, args),
        args.n_sample,
        _params(args),
        model_path=args.model_out,
        threshold=args.threshold,
        history_every=args.history_every,
        patience=args.patience,
        ntree_limit=args.ntree_limit,
    )
    report = {name: [r.asDict() for r in df.collect()] for name, df in res.reports.items()}
    report["sizes"] = [r.asDict() for r in res.sizes.collect()]
    report["best_trees"] = res.best_trees
    print(json.dumps(report, default=str, indent=1))


def cmd_tune(spark: SparkSession, args) -> None:
    trials, best, _folds = jobs.tune(
        _training(spark, args), args.n_sample, args.init_points, args.n_iter, args.parallelism, args.seed
    )
    if args.out:
        trials.write.mode("overwrite").parquet(args.out)
    print(json.dumps([r.asDict() for r in best.collect()], default=str))


def cmd_features(spark: SparkSession, args) -> None:
    events = spark.read.parquet(args.events)
    print(write_feature_table(build_features(events, training=args.training), args.out))


def cmd_evaluate(spark: SparkSession, args) -> None:
    reports = jobs.evaluate_saved(_training(spark, args), args.model, args.threshold, args.ntree_limit)
    print(json.dumps({name: [r.asDict() for r in df.collect()] for name, df in reports.items()}, default=str, indent=1))


def cmd_create_table(spark: SparkSession, args) -> None:
    print(result_table.create_result_table(spark, args.table, args.location))


def cmd_load(spark: SparkSession, args) -> None:
    result_table.load_csv_into_partition(spark, args.csv, args.table, args.dt, args.user_column)
    _print_rows(result_table.latest_partitions(spark, args.table))


def cmd_drop_partition(spark: SparkSession, args) -> None:
    result_table.drop_partition(spark, args.table, args.dt)


def cmd_peek(spark: SparkSession, args) -> None:
    _print_rows(result_table.peek(spark.table(args.table), args.rows, args.order_by))


def cmd_audit(spark: SparkSession, args) -> None:
    _print_rows(result_table.latest_partitions(spark, args.table, args.days))


def cmd_drop_table(spark: SparkSession, args) -> None:
    result_table.drop_table(spark, args.table)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="datescore")
    sub = p.add_subparsers(dest="job", required=True)

    def source(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--features", help="day-partitioned Parquet feature table (path)")
        g.add_argument("--features-table", help="feature table in the catalog")
        sp.add_argument("--run-date", default=None, help="yyyy-MM-dd; the scored day is the day before (default: today)")

    def labelled(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--training", help="training feature table (Parquet path)")
        g.add_argument("--training-tsv", help="training data as header TSV")

    def training(sp):
        labelled(sp)
        sp.add_argument("--n-sample", type=int, required=True, help="rows per class in the training sample")
        sp.add_argument("--seed", type=int, default=123)

    d = sub.add_parser("daily", help="W1: score yesterday's partition into the result table")
    source(d)
    d.add_argument("--table", required=True)
    d.add_argument("--location", default=None, help="storage location when the table is created")
    d.add_argument("--model", default=None, help="saved model (default: the fixed test ensemble)")
    d.add_argument("--ntree-limit", type=int, default=None, help="trees that score (default: the stored choice, else 1500)")
    d.add_argument("--best-trees", action="store_true", help="score with the trees early stopping chose for the model")
    d.add_argument("--csv", default=None, help="also write the day's result as header CSV")
    d.add_argument("--validate-keys", action="store_true")
    d.add_argument("--rebalance-output", action="store_true")
    d.set_defaults(run=cmd_daily)

    e = sub.add_parser("extract", help="W2: yesterday's partition as header TSV")
    source(e)
    e.add_argument("--out", required=True)
    e.set_defaults(run=cmd_extract)

    t = sub.add_parser("train", help="W3: sample, split, train, evaluate on the holdout, save")
    training(t)
    t.add_argument("--model-out", required=True)
    t.add_argument("--max-iter", type=int, default=2000)
    t.add_argument("--max-depth", type=int, default=7)
    t.add_argument("--eta", type=float, default=0.01)
    t.add_argument("--gamma", type=float, default=0.03, help="least gain of a split")
    t.add_argument("--subsample", type=float, default=0.75, help="rows of a tree")
    t.add_argument("--colsample", type=float, default=0.81, help="features of a node")
    t.add_argument("--min-child-rows", type=int, default=4)
    t.add_argument("--max-bins", type=int, default=32)
    t.add_argument("--threshold", type=float, default=0.5)
    t.add_argument("--history-every", type=int, default=100)
    t.add_argument("--patience", type=int, default=50)
    t.add_argument("--ntree-limit", type=int, default=1500)
    t.set_defaults(run=cmd_train)

    b = sub.add_parser("boost", help="W3 with leaf penalties, missing values and a stop during training")
    training(b)
    b.add_argument("--model-out", required=True)
    b.add_argument("--max-iter", type=int, default=2000)
    b.add_argument("--max-depth", type=int, default=7)
    b.add_argument("--eta", type=float, default=0.01)
    b.add_argument("--reg-lambda", type=float, default=1.0, help="L2 penalty of leaves")
    b.add_argument("--reg-alpha", type=float, default=1.0, help="L1 penalty of leaves")
    b.add_argument("--gamma", type=float, default=0.03, help="least gain of a split")
    b.add_argument("--min-child-weight", type=float, default=0.8, help="least Hessian weight of a child")
    b.add_argument("--subsample", type=float, default=0.75, help="rows of a tree")
    b.add_argument("--colsample-bytree", type=float, default=0.9)
    b.add_argument("--colsample-bylevel", type=float, default=0.9)
    b.add_argument("--max-bins", type=int, default=64)
    b.add_argument("--threshold", type=float, default=0.5)
    b.add_argument("--history-every", type=int, default=50, help="trees between two marks (and checkpoints)")
    b.add_argument("--patience", type=int, default=50)
    b.add_argument("--ntree-limit", type=int, default=None, help="trees that score the holdout (default: the best number)")
    b.set_defaults(run=cmd_boost)

    u = sub.add_parser("tune", help="W4: cross-validated search over the tree parameters")
    training(u)
    u.add_argument("--init-points", type=int, default=10)
    u.add_argument("--n-iter", type=int, default=25)
    u.add_argument("--parallelism", type=int, default=4)
    u.add_argument("--out", default=None, help="write the trial table (Parquet)")
    u.set_defaults(run=cmd_tune)

    f = sub.add_parser("features", help="derive the day-partitioned feature table from an events table")
    f.add_argument("--events", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--training", action="store_true", help="keep pre_days_median and label")
    f.set_defaults(run=cmd_features)

    v = sub.add_parser("evaluate", help="judge a saved model on labelled rows")
    labelled(v)
    v.add_argument("--model", required=True)
    v.add_argument("--threshold", type=float, default=0.5)
    v.add_argument("--ntree-limit", type=int, default=None, help="trees that score (default: the stored choice, else 1500)")
    v.set_defaults(run=cmd_evaluate)

    def table(name, run, text):
        sp = sub.add_parser(name, help=text)
        sp.add_argument("--table", required=True)
        sp.set_defaults(run=run)
        return sp

    table("create-table", cmd_create_table, "create the result table if absent").add_argument("--location", default=None)
    o = table("load", cmd_load, "replace one day of the result table with a result CSV")
    o.add_argument("--csv", required=True)
    o.add_argument("--dt", required=True, help="yyyyMMdd")
    o.add_argument("--user-column", default=None, help="what the file calls the user column")
    table("drop-partition", cmd_drop_partition, "drop one day").add_argument("--dt", required=True)
    k = table("peek", cmd_peek, "a few rows of the result table")
    k.add_argument("--rows", type=int, default=5)
    k.add_argument("--order-by", nargs="+", default=None, help="columns (default: any rows)")
    table("audit", cmd_audit, "latest days with row counts").add_argument("--days", type=int, default=5)
    table("drop-table", cmd_drop_table, "drop the result table")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if getattr(args, "run_date", None) is not None:
        previous_day_value(args.run_date)  # validate the date early
    spark = _session()
    mark = scratch_mark()
    try:
        args.run(spark, args)
    finally:
        clear_scratch(spark, mark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
