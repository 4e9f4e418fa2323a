"""

Each query takes (spark, sf_dir), reads the driver's tables (the feature
table is derived from ``events`` by Spark), and returns a DataFrame whose
columns match the oracle SQL in ``plans.oracle``. Queries that write (the
result table, text files, models) write under the session's shared
checkpoint folder and return a read-back of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from datescore.functions.dates import previous_day_value
from datescore.functions.fill import fill_missing
from datescore.operators import boosting as B
from datescore.operators import ensemble as E
from datescore.operators import metrics as MT
from datescore.operators import model as M
from datescore.operators import quantiles
from datescore.operators import sampling as S
from datescore.operators import tree_index
from datescore.operators import tuning as TU
from datescore.operators.prepare import (
    class_rows,
    feature_matrix,
    label_prediction_pairs,
    result_rows,
    threshold,
)
from datescore.plans import jobs
from datescore.plans.oracle import (
    BOOST,
    BOOST_CUTS,
    DAY,
    INIT_POINTS,
    N_ITER,
    N_SAMPLE,
    NAMELESS_USER,
    QUERY_LIMIT,
    QUERY_MARK,
    QUERY_TREES,
)
from datescore.schema import EXTRACT_SCHEMA, FEATURES, KEY, LABEL, PARTITION, RESULT_SCHEMA, TRAINING_COLUMNS, TRAINING_SCHEMA, USER
from datescore.session import materialize, materialize_packed, work_path
from datescore.sources import model_store, result_table, text
from datescore.sources.feature_table import read_feature_table, scan_partition, write_feature_table
from datescore.sources.fixture import features_from_dir

RUN_DATE = "2024-01-16"  # F1: the scored day is the day before
assert previous_day_value(RUN_DATE) == DAY

Query = Callable[[SparkSession, str], DataFrame]


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_dir(spark, sf_dir, training=True)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features filled, with the fixed ensemble's score (DOUBLE) and its prefixes."""
    f = _features(spark, sf_dir)
    filled = fill_missing(f, subset=FEATURES)
    return filled.select(
        *KEY,
        LABEL,
        E.probability(E.FIXED_ENSEMBLE, 1).alias("score1"),
        E.probability(E.FIXED_ENSEMBLE, 2).alias("score2"),
        E.probability(E.FIXED_ENSEMBLE).alias("score"),
    )


# --- sources, projections, fill -------------------------------------------------


def feature_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialise the partitioned feature table, scan one day."""
    path = write_feature_table(_features(spark, sf_dir).select(*EXTRACT_SCHEMA.names), work_path(spark, "features"))
    return scan_partition(read_feature_table(spark, path), previous_day_value(RUN_DATE))


def fill_missing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7."""
    f = _features(spark, sf_dir).select(*KEY, *FEATURES)
    return fill_missing(f)


def scoring_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P5: the 20 inputs with the key travelling in the same row."""
    return feature_matrix(_features(spark, sf_dir), keep=KEY)


def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P5: the same 20 inputs and the label."""
    return feature_matrix(_features(spark, sf_dir), keep=[LABEL])


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 + A11: rows per class."""
    f = _features(spark, sf_dir)
    return f.groupBy(LABEL).agg(F.count(F.lit(1)).alias("rows"))


# --- sampling, holdout, splits ---------------------------------------------------
# These read their input more than once, so it is written first: one scan of
# ``events`` a query. One user has no name there: no row may be lost for that.


def _training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _features(spark, sf_dir)
    nameless = F.when(F.col(USER) != NAMELESS_USER, F.col(USER))
    return materialize(f.withColumn(USER, nameless), "training-table")


def _sample(training: DataFrame) -> DataFrame:
    """The class sample, 2 x N_SAMPLE rows, written once."""
    return materialize_packed(S.class_sample(training, N_SAMPLE), "sample")


def class_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly n rows per class, seeded per class."""
    return S.class_sample(_training_table(spark, sf_dir), N_SAMPLE)


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 via the sample flag (no join)."""
    return S.holdout(_training_table(spark, sf_dir), N_SAMPLE)


def holdout_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 as an anti-join on the row key."""
    f = _training_table(spark, sf_dir)
    return S.holdout_anti_join(f, _sample(f))


def training_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives UNION ALL negatives."""
    sample = _sample(_training_table(spark, sf_dir))
    return S.union_rows(class_rows(sample, 1), class_rows(sample, 0))


def subset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the positive sample, negative sample and holdout, in one aggregation."""
    flagged = S.flag_class_sample(_training_table(spark, sf_dir), N_SAMPLE)
    role = (
        F.when(F.col("sampled") & (F.col(LABEL) == 1), F.lit("positive"))
        .when(F.col("sampled"), F.lit("negative"))
        .otherwise(F.lit("holdout"))
    )
    return MT.subset_sizes(flagged, role)


def half_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 50/50 split of the sample."""
    sample = _sample(_training_table(spark, sf_dir))
    return S.half_split(sample).select(*KEY, LABEL, "is_test")


def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: stratified 3-fold assignment of the sample."""
    sample = _sample(_training_table(spark, sf_dir))
    return S.fold_assign(sample).select(*KEY, LABEL, "fold")


# --- scoring -----------------------------------------------------------------------


def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair scored by the fixed ensemble."""
    return jobs.score_with_ensemble(_features(spark, sf_dir))


def score_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 on the fixed ensemble: the first 2 trees only."""
    return jobs.score_with_ensemble(_features(spark, sf_dir), k=2)


def _thresholded(spark: SparkSession, sf_dir: str, inclusive: bool) -> DataFrame:
    s = _scored(spark, sf_dir)
    return s.select(
        *KEY,
        F.col("score").cast("float").alias("q_ratio"),
        threshold(F.col("score"), 0.5, inclusive).alias("prediction_label"),
    )


def threshold_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10."""
    return _thresholded(spark, sf_dir, inclusive=False)


def threshold_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    return _thresholded(spark, sf_dir, inclusive=True)


# --- metrics ------------------------------------------------------------------------


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 P12 P13 (inclusive threshold, as the reference's crosstab)."""
    return MT.confusion_matrix(label_prediction_pairs(_scored(spark, sf_dir), inclusive=True))


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 (strict threshold)."""
    return MT.class_report(label_prediction_pairs(_scored(spark, sf_dir), inclusive=False))


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4-A8 (strict threshold)."""
    return MT.binary_metrics(label_prediction_pairs(_scored(spark, sf_dir), inclusive=False))


def auc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tie-aware AUC of the scores."""
    return MT.auc(_scored(spark, sf_dir))


def auc_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 on the fixed ensemble: AUC after each tree."""
    return jobs.prefix_auc(_features(spark, sf_dir))


def fold_mean_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC per fold of the sample and its mean over folds."""
    sample = materialize(S.fold_assign(_sample(_training_table(spark, sf_dir))), "folds")
    filled = fill_missing(sample, subset=FEATURES)
    scored = filled.select("fold", LABEL, E.probability(E.FIXED_ENSEMBLE).alias("score"))
    per_fold = MT.auc(scored, by=["fold"])
    # Three rows: the mean over an unpartitioned window is bounded by the fold
    # count. A mean of doubles depends on the order of summation, which
    # differs between engines, so it is reported to 12 decimals.
    return per_fold.withColumn("mean_auc", F.round(F.avg("auc").over(Window.partitionBy()), 12))


def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: trials = prefix lengths of the fixed ensemble, scored by AUC."""
    trials = jobs.prefix_auc(_features(spark, sf_dir)).select(
        F.col("trees").alias("trial_id"), "trees", F.col("auc").alias("score")
    )
    return TU.best_trial(trials, params=["trees"])


# --- result table, audit, files -----------------------------------------------------


def _copy_out(df: DataFrame, name: str) -> DataFrame:
    """Write a read-back to the shared folder so it outlives the catalog table."""
    return materialize(df, name)


def _table_name(spark: SparkSession, tag: str) -> tuple[str, str]:
    location = work_path(spark, f"result-{tag}")
    return f"datescore_{tag}_{location.rsplit('-', 1)[-1]}", location


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived feature table, written once (partitioned by day) and read back."""
    f = features_from_dir(spark, sf_dir, training=False)
    return read_feature_table(spark, write_feature_table(f, work_path(spark, "features")))


def _day_result(table: DataFrame, dt: str, k: int | None = None) -> DataFrame:
    """One day scanned from the feature table (partition pruning) and scored."""
    return jobs.score_with_ensemble(scan_partition(table, dt), k=k).drop(PARTITION)


def _read_back(spark: SparkSession, table: str, name: str) -> DataFrame:
    return _copy_out(spark.table(table).select("user_name", "dep_date", "q_ratio", PARTITION), name)


def _all_days_table(spark: SparkSession, features: DataFrame, tag: str) -> str:
    """A result table with every day scored and loaded (S5 on a path, S6)."""
    table, location = _table_name(spark, tag)
    result_table.overwrite_partitions_at(jobs.score_with_ensemble(features), location)
    return result_table.create_result_table(spark, table, location)


def result_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, one day replaced twice (the second time with other scores), read back, dropped."""
    features = _feature_table(spark, sf_dir)
    table = _all_days_table(spark, features, "overwrite")
    try:
        for k in (None, 2):
            result_table.overwrite_partition(_day_result(features, DAY, k), table, DAY)
        return _read_back(spark, table, "overwrite-readback")
    finally:
        result_table.drop_table(spark, table)


def drop_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, one dropped, read back."""
    table = _all_days_table(spark, _feature_table(spark, sf_dir), "dropday")
    try:
        result_table.drop_partition(spark, table, DAY)
        return _read_back(spark, table, "dropday-readback")
    finally:
        result_table.drop_table(spark, table)


def result_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S5 from a file: all days loaded, one replaced from a result CSV with yyyy/M/d dates, read back."""
    features = _feature_table(spark, sf_dir)
    csv = text.write_result_csv(_day_result(features, DAY, 2), work_path(spark, "result-day-csv"), text.DATE_FORMATS[1])
    table = _all_days_table(spark, features, "csvload")
    try:
        result_table.load_csv_into_partition(spark, csv, table, DAY)
        return _read_back(spark, table, "csvload-readback")
    finally:
        result_table.drop_table(spark, table)


def partition_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + L1: latest five days of the result table with row counts."""
    table = _all_days_table(spark, _features(spark, sf_dir), "audit")
    try:
        return _copy_out(result_table.latest_partitions(spark, table), "audit-readback")
    finally:
        result_table.drop_table(spark, table)


def result_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: five rows of the result table; ordered by key on request, so that the answer is stable."""
    path = work_path(spark, "results")
    result_table.overwrite_partitions_at(jobs.score_with_ensemble(_features(spark, sf_dir)), path)
    results = spark.read.option("basePath", path).schema("user_name STRING, dep_date DATE, q_ratio FLOAT, dt STRING").parquet(path)
    rows = result_table.peek(results, order=[PARTITION, USER, "dep_date"])
    return rows.select("user_name", "dep_date", "q_ratio", PARTITION)


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: the training table, all days, as header TSV (NULL for missing) and read back."""
    rows = _features(spark, sf_dir).select(*TRAINING_COLUMNS)
    path = text.write_tsv(rows, work_path(spark, "training-tsv"))
    return text.read_tsv(spark, path, TRAINING_SCHEMA)


def extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 -> S1 -> P1 -> S2 on the materialised feature table; read back."""
    table = write_feature_table(_features(spark, sf_dir).select(*EXTRACT_SCHEMA.names), work_path(spark, "features"))
    out = jobs.extract_job(read_feature_table(spark, table), work_path(spark, "extract"), RUN_DATE)
    return text.read_tsv(spark, out, EXTRACT_SCHEMA)


def result_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result as header CSV and read back with the result schema."""
    res = jobs.score_with_ensemble(_features(spark, sf_dir)).drop(PARTITION)
    path = text.write_result_csv(res, work_path(spark, "result-csv"))
    return text.read_result_csv(spark, path, RESULT_SCHEMA)


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 as a stream: days arrive in two batches; each run scores only the new days."""
    from datescore.streaming import daily

    f = features_from_dir(spark, sf_dir, training=False)
    src, out, ckpt = (work_path(spark, name) for name in ("stream-features", "stream-results", "stream-checkpoint"))
    write_feature_table(f.where(F.col(PARTITION) <= DAY), src, mode="append")
    daily.run_available(spark, src, out, ckpt)
    write_feature_table(f.where(F.col(PARTITION) > DAY), src, mode="append")
    return daily.run_available(spark, src, out, ckpt)


# --- model jobs ---------------------------------------------------------------------------
# The reference's parameters with QUERY_TREES trees instead of 2000, of which
# the first QUERY_LIMIT score (the reference: 1500 of 2000).

QUERY_PARAMS = M.TreeParams(max_iter=QUERY_TREES)


def _differ(a: DataFrame, b: DataFrame, on: list[str]) -> int:
    """Rows of two scored frames whose scores differ, or that only one of them has."""
    left, right = a.withColumnRenamed("score", "_a"), b.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("score").alias("_b"))
    both = left.join(right, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on], "full")
    return both.where(F.coalesce(F.abs(F.col("_a") - F.col("_b")) > 1e-9, F.lit(True))).count()


def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the sample, evaluate on the holdout; sizes and 0-mismatch counters."""
    path = work_path(spark, "model")
    training = _training_table(spark, sf_dir)
    res = jobs.train_evaluate(
        training, N_SAMPLE, QUERY_PARAMS, model_path=path, history_every=QUERY_MARK, ntree_limit=QUERY_LIMIT
    )
    sample = res.sample
    scored = materialize(M.score(res.model, sample, keep=[*KEY, LABEL], ntree_limit=QUERY_LIMIT), "sample-scores")
    reloaded = M.score(model_store.load_model(path), sample, keep=KEY, ntree_limit=QUERY_LIMIT)
    trees = M.to_ensemble(res.model)
    filled = fill_missing(sample, subset=FEATURES)
    summed = E.probability_column(trees, FEATURES, QUERY_LIMIT, M.MLLIB_MARGIN_SCALE, compiled=False).alias("score")
    by_rows = MT.binary_metrics(label_prediction_pairs(scored, inclusive=False))
    by_histogram = M.evaluate(scored)["metrics"]
    marks = range(QUERY_MARK, QUERY_TREES + 1, QUERY_MARK)
    values = {r.role: r.rows for r in res.sizes.collect()}
    values |= {f"support_{r['class']}": r.support for r in res.reports["class_report"].collect() if r["class"] in "01"}
    cells = res.reports["confusion"].select(F.sum(F.coalesce("true_0", F.lit(0)) + F.coalesce("true_1", F.lit(0))))
    values |= {
        "confusion_cells": cells.first()[0],
        "trees": len(trees),
        "history_rows": res.history.count(),
        "best_trees_is_a_mark": int(model_store.load_best_trees(path) in marks),
        "reload_mismatches": _differ(scored.drop(LABEL), reloaded, KEY),
        "prefix_mismatches": _differ(scored.drop(LABEL), filled.select(*KEY, summed), KEY),
        "report_mismatches": by_rows.exceptAll(by_histogram).count() + by_histogram.exceptAll(by_rows).count(),
    }
    return spark.createDataFrame([(m, int(v)) for m, v in values.items()], "metric string, value bigint")


def tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-stage search at the reference's size; what must hold of each trial."""
    res = jobs.tune(_training_table(spark, sf_dir), N_SAMPLE, init_points=INIT_POINTS, n_iter=N_ITER, parallelism=8)
    trials, best = materialize(res[0], "trials"), res[1].first()
    params = TU.trial_params(trials).withColumnRenamed("score", "_score").alias("p")
    inside = F.lit(True)
    for name, (lo, hi) in TU.SEARCH_BOX.items():
        inside = inside & F.col(f"t.{name}").between(lo, hi)
    whole = (F.col("p.max_depth") == F.floor("t.max_depth")) & (F.col("p.n_estimators") == F.greatest(F.lit(1), F.floor("t.n_estimators")))
    first = trials.where(F.col("score") == trials.agg(F.max("score")).first()[0]).agg(F.min("trial_id")).first()[0]
    sizes = {r.fold: r["count"] for r in res[2].groupBy("fold").count().collect()}
    return trials.alias("t").join(params, F.col("t.trial_id") == F.col("p.trial_id")).select(
        "t.trial_id",
        "t.stage",
        inside.alias("in_box"),
        whole.alias("truncated"),
        F.col("t.score").between(0, 1).alias("scored"),
        F.lit(best.trial_id == first).alias("best_is_first_max"),
        *[F.lit(sizes[k]).cast("bigint").alias(f"fold_{k}") for k in range(3)],
    )


def daily_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a trained model: train, save, load, score yesterday's partition, replace it, audit."""
    training = materialize(_features(spark, sf_dir), "training-table")
    path = model_store.save_model(M.train(_sample(training), QUERY_PARAMS), work_path(spark, "daily-model"))
    return _daily(spark, training, model_store.load_model(path))


def daily_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a stored second-order model: its node table is loaded as a threshold index; missing values are not filled."""
    training = materialize(_features(spark, sf_dir), "training-table")
    booster = B.train(_sample(training), B.BoostParams(rounds=6, max_depth=4, eta=0.3, block=3))
    return _daily(spark, training, model_store.load_index(model_store.save_booster(booster, work_path(spark, "daily-booster"))))


def _daily(spark: SparkSession, training: DataFrame, model) -> DataFrame:
    features = write_feature_table(training.select(*EXTRACT_SCHEMA.names), work_path(spark, "features"))
    table = _all_days_table(spark, training, "daily")
    try:
        before = _copy_out(spark.table(table).where(F.col(PARTITION) != DAY), "daily-before")
        audit = jobs.daily_scoring(
            read_feature_table(spark, features), table, RUN_DATE, model=model, ntree_limit=QUERY_LIMIT
        )
        audited = audit.agg(F.sum("count")).first()[0]
        spark.catalog.refreshTable(table)
        after = spark.table(table).where(F.col(PARTITION) != DAY)
        same = before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
        day = spark.table(table).where(F.col(PARTITION) == DAY)
        ok = (F.col("q_ratio") > 0) & (F.col("q_ratio") < 1)
        return _copy_out(
            day.select(
                "user_name",
                "dep_date",
                PARTITION,
                F.coalesce(ok, F.lit(False)).alias("in_range"),
                F.lit(same).alias("others_unchanged"),
                F.lit(audited).cast("bigint").alias("audit_rows"),
            ),
            "daily-readback",
        )
    finally:
        result_table.drop_table(spark, table)


# --- scoring by thresholds, second-order boosting -------------------------------------------


def index_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair scored by the threshold index of the fixed ensemble's node table."""
    index = tree_index.from_node_table(E.node_table(spark, E.FIXED_ENSEMBLE), FEATURES, fill=True)
    return result_rows(tree_index.score(index, _features(spark, sf_dir), [USER, "dep_date_of_search", PARTITION]), extra=[PARTITION])


def _root_histogram(spark: SparkSession, sf_dir: str):
    """Sums of the root of a first tree over all rows: (features, codes, 3), with the fixed cuts for every feature."""
    cuts = [BOOST_CUTS] * len(FEATURES)
    params = B.BoostParams(subsample=1.0, max_bins=len(BOOST_CUTS) + 1, **BOOST)
    rows = materialize(B.bin_rows(_features(spark, sf_dir), FEATURES, cuts, F.lit(False), KEY), "root-rows")
    root = B.Tree()
    root.add(0.0, 0.0)
    return B.histogram(rows, [], root, [0], 0, len(FEATURES), params)[0], params


def boost_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: gradient and Hessian sums of the root for each feature and bin (-1: missing), all rows, fixed cuts."""
    hist, params = _root_histogram(spark, sf_dir)
    rows = [
        (name, -1 if code == params.max_bins else code, int(n), g / B.UNIT, h / B.UNIT)
        for name, cells in zip(FEATURES, hist.tolist())
        for code, (g, h, n) in enumerate(cells)
        if n
    ]
    return spark.createDataFrame(rows, "feature string, bin int, rows bigint, g double, h double")


def boost_root_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: each feature's best split of the root: leaf penalties, least Hessian weight, side of missing values."""
    hist, params = _root_histogram(spark, sf_dir)
    rows = []
    for f, name in enumerate(FEATURES):
        active = np.arange(len(FEATURES)) == f
        split = B.best_splits(hist[None], [len(BOOST_CUTS)] * len(FEATURES), active, params)[0]
        if split:
            threshold = float(BOOST_CUTS[split["bin"]]) if split["bin"] < len(BOOST_CUTS) else None
            rows.append((name, threshold, split["missing_left"], split["gain"], int(split["left"][2])))
    return spark.createDataFrame(rows, "feature string, threshold double, missing_left boolean, gain double, left_rows bigint")


def quantile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the mergeable summary of each feature; its size and its deciles' rank bounds against counted ranks."""
    size = 200
    table = materialize(_features(spark, sf_dir).select(*[F.col(c).cast("double") for c in FEATURES]), "quantile-rows")
    found = quantiles.summaries(table, FEATURES, size)
    asked = {name: s.values_at(np.arange(1, 10) / 10 * s.total) for name, s in zip(FEATURES, found)}
    counts = [
        F.count(F.when(F.col(name) < v if below else F.col(name) <= v, 1)).alias(f"{name}_{i}_{below}")
        for name, values in asked.items()
        for i, v in enumerate(values.tolist())
        for below in (0, 1)
    ]
    true = table.agg(*counts).first()
    rows = []
    for name, s in zip(FEATURES, found):
        at = np.searchsorted(s.value, asked[name])
        held = all(
            s.below[k] <= true[f"{name}_{i}_1"] and true[f"{name}_{i}_0"] <= s.through[k]
            and abs((true[f"{name}_{i}_1"] + true[f"{name}_{i}_0"]) / 2 - (s.below[k] + s.through[k]) / 2) <= max(1.0, s.error() * s.total)
            for i, k in enumerate(at)
        )
        rows.append((name, int(s.total), len(s.value) <= size + 2, held))
    return spark.createDataFrame(rows, "feature string, rows bigint, bounded boolean, ranks_hold boolean")


def boost_train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 M2 M3 M4 M5 M7 S9 S10 with the second-order booster: stopped by patience; sizes and 0-mismatch counters."""
    path = work_path(spark, "booster")
    params = B.BoostParams(rounds=200, max_depth=3, eta=0.5, block=4, early_stopping_rounds=8)
    res = jobs.train_boosted(_training_table(spark, sf_dir), N_SAMPLE, params, model_path=path)
    booster, sample = res.booster, res.sample
    validation = {k: a for k, name, a in booster.history if name == "val"}
    marks = range(params.block, len(booster.trees) + 1, params.block)
    scored = materialize(tree_index.score(booster.index(), sample, [*KEY, LABEL]), "booster-scores")
    reloaded = tree_index.score(model_store.load_index(path), sample, KEY)
    # The history comes from stored margins; here the best prefix is scored anew.
    split = S.half_split(sample)
    sets = tree_index.score(booster.index(), split, ["is_test", LABEL])
    again = {("val" if r["is_test"] else "train"): r["auc"] for r in MT.auc(sets, by=["is_test"]).collect()}
    kept = {name: a for k, name, a in booster.history if k == booster.best_trees}
    values = {r.role: r.rows for r in res.sizes.collect()}
    values |= {f"support_{r['class']}": r.support for r in res.reports["class_report"].collect() if r["class"] in "01"}
    cells = res.reports["confusion"].select(F.sum(F.coalesce("true_0", F.lit(0)) + F.coalesce("true_1", F.lit(0))))
    values |= {
        "confusion_cells": cells.first()[0],
        "stopped_before_the_last_round": len(booster.trees) < params.rounds,
        "trees_after_the_best": len(booster.trees) - booster.best_trees,
        "marks_missing": len(set(marks) ^ set(validation)),
        "best_is_the_first_maximum": booster.best_trees == min(k for k, a in validation.items() if a == max(validation.values())),
        "best_trees_differ_from_the_stored": model_store.load_best_trees(path) - booster.best_trees,
        "reload_mismatches": _differ(scored.drop(LABEL), reloaded, KEY),
        "history_mismatches": sum(abs(again[name] - kept[name]) > 1e-9 for name in ("train", "val")),
    }
    return spark.createDataFrame([(m, int(v)) for m, v in values.items()], "metric string, value bigint")


QUERIES: dict[str, Query] = {
    "feature_extract": feature_extract,
    "fill_missing": fill_missing_q,
    "scoring_features": scoring_features,
    "training_features": training_features,
    "class_counts": class_counts,
    "class_sample": class_sample,
    "holdout": holdout,
    "holdout_anti_join": holdout_anti_join,
    "training_union": training_union,
    "subset_sizes": subset_sizes,
    "half_split": half_split,
    "fold_assign": fold_assign,
    "score_pairs": score_pairs,
    "score_prefix": score_prefix,
    "threshold_strict": threshold_strict,
    "threshold_inclusive": threshold_inclusive,
    "confusion_matrix": confusion_matrix,
    "class_report": class_report,
    "binary_metrics": binary_metrics,
    "auc_scores": auc_scores,
    "auc_by_prefix": auc_by_prefix,
    "fold_mean_auc": fold_mean_auc,
    "best_trial": best_trial,
    "result_overwrite": result_overwrite,
    "drop_partition": drop_partition,
    "partition_audit": partition_audit,
    "result_peek": result_peek,
    "tsv_roundtrip": tsv_roundtrip,
    "extract_job": extract_job,
    "result_csv_roundtrip": result_csv_roundtrip,
    "result_csv_load": result_csv_load,
    "stream_scoring": stream_scoring,
    "train_evaluate": train_evaluate,
    "tune": tune,
    "daily_scoring": daily_scoring,
    "index_scores": index_scores,
    "boost_histogram": boost_histogram,
    "boost_root_split": boost_root_split,
    "quantile_summary": quantile_summary,
    "boost_train_evaluate": boost_train_evaluate,
    "daily_boosted": daily_boosted,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily scoring query with the fixed ensemble: yesterday's partition, scored."""
    f = features_from_dir(spark, sf_dir, training=False)
    return jobs.score_with_ensemble(scan_partition(f, previous_day_value(RUN_DATE))).drop(PARTITION)


__all__ = ["QUERIES", "flagship"]
