"""Jobs composed from the operators.

Each job is one Spark application step with one lineage: no local hand-off
files between stages. Only the final sink is an action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datescore.functions.dates import previous_day_value
from datescore.functions.fill import fill_missing
from datescore.operators import boosting as B
from datescore.operators import ensemble as E
from datescore.operators import model as M
from datescore.operators import sampling as S
from datescore.operators import tree_index
from datescore.operators import tuning as TU
from datescore.operators.metrics import auc, subset_sizes
from datescore.operators.prepare import check_unique_key, result_rows
from datescore.operators.tree_index import TreeIndex
from datescore.schema import DEP_DATE, FEATURES, KEY, LABEL, PARTITION, USER, require_columns
from datescore.sources import model_store, result_table, text
from datescore.session import checkpoint_root, materialize_packed
from datescore.sources.feature_table import scan_partition


# --- W1: daily scoring ---------------------------------------------------------


def score_with_ensemble(features: DataFrame, ensemble: E.Ensemble = E.FIXED_ENSEMBLE, k: int | None = None) -> DataFrame:
    """P7 -> M10 (first ``k`` trees) -> P8/P9, with ``dt`` carried along."""
    require_columns(features, FEATURES)
    filled = fill_missing(features, subset=FEATURES)
    scored = filled.select(USER, DEP_DATE, PARTITION, E.probability_column(ensemble, FEATURES, k).alias("score"))
    return result_rows(scored, extra=[PARTITION])


def score_with_model(features: DataFrame, model: PipelineModel | TreeIndex, ntree_limit: int | None = None) -> DataFrame:
    """P7 -> M1 -> M5/M6 -> P8/P9, with ``dt`` carried along.

    A threshold index (``model_store.load_index``) holds the trees it was loaded
    with; it starts at once whatever their number, so it is the form for many trees.
    """
    if isinstance(model, TreeIndex):
        return result_rows(tree_index.score(model, features, [USER, DEP_DATE, PARTITION]), extra=[PARTITION])
    scored = M.score(model, features, keep=[USER, DEP_DATE, PARTITION], ntree_limit=ntree_limit)
    return result_rows(scored, extra=[PARTITION])


def daily_scoring(
    source: DataFrame,
    table: str,
    run_date: str | None = None,
    model: PipelineModel | TreeIndex | None = None,
    ntree_limit: int | None = 1500,
    ensemble: E.Ensemble | None = None,
    validate_keys: bool = False,
    csv_path: str | None = None,
    rebalance_output: bool = False,
) -> DataFrame:
    """F1 -> S1 -> P1 -> P7 -> M1 -> M5/M6 -> P8 -> S5; returns the audit (A1 + L1).

    No shuffle between the scan and the write: every step is row-local, so a
    day of any size streams through the executors in one stage.
    ``validate_keys`` first checks that (user, dt, departure date) is unique
    in the day (one extra aggregation; copies of a hot key are pre-aggregated
    before its shuffle) and fails naming a duplicate. ``csv_path`` also writes
    the day's result as a header CSV (S4), read back from the loaded
    partition rather than scored twice. Without a shuffle every scan task
    writes one result file; ``rebalance_output`` shuffles the three narrow
    result columns once so AQE writes fewer, larger files.
    """
    dt = previous_day_value(run_date)
    day = scan_partition(source, dt)
    if validate_keys:
        check_unique_key(day)
    if model is not None:
        res = score_with_model(day, model, ntree_limit)
    else:
        res = score_with_ensemble(day, ensemble or E.FIXED_ENSEMBLE)
    res = res.drop(PARTITION)
    if rebalance_output:
        res = res.hint("rebalance")
    result_table.overwrite_partition(res, table, dt)
    spark = source.sparkSession
    if csv_path:
        loaded = spark.table(table).where(F.col(PARTITION) == dt).select("user_name", "dep_date", "q_ratio")
        text.write_result_csv(loaded, csv_path)
    return result_table.latest_partitions(spark, table)


# --- W2: extract only ------------------------------------------------------------


def extract_job(source: DataFrame, out_path: str, run_date: str | None = None) -> str:
    """F1 -> S1 -> P1 -> S2."""
    dt = previous_day_value(run_date)
    return text.write_tsv(scan_partition(source, dt), out_path)


# --- W3: train, evaluate, save -----------------------------------------------------


@dataclass
class TrainResult:
    model: PipelineModel
    model_path: str | None
    sizes: DataFrame
    reports: dict[str, DataFrame]
    history: DataFrame | None
    best_trees: int | None
    sample: DataFrame


def train_evaluate(
    training: DataFrame,
    n_sample: int,
    params: M.TreeParams,
    model_path: str | None = None,
    threshold: float = 0.5,
    history_every: int | None = None,
    patience: int = 50,
    ntree_limit: int | None = 1500,
) -> TrainResult:
    """P7 -> D1 -> J1/J2 -> D2 -> M2 -> M7 -> A2 -> S9.

    The class samples' cuts split sample and holdout with no join on the rows.
    ``training`` is read three times (counts pruned to the key columns, the
    sample, the holdout), so give it as a stored table. The split
    rows are written once under the shared folder, so the boosting loop (a few
    jobs per tree) and the evaluation read a fixed, fault-tolerant input, in
    files by their number of rows, not by the tasks that read the input. The
    choice of early stopping is stored with the model.
    """
    checkpoint_root(training.sparkSession)
    sample, held = S.class_sample_and_holdout(training, n_sample)
    # 2 x n rows, written once: the split's two passes read it, not the input.
    sample = materialize_packed(sample, "sample")
    split = materialize_packed(S.half_split(sample), "split")
    train_part = split.where(~F.col("is_test"))
    val_part = split.where(F.col("is_test"))
    model = M.train(train_part, params)
    history, best = None, None
    if history_every:
        sets = train_part.withColumn("set", F.lit("train")).unionByName(val_part.withColumn("set", F.lit("val")))
        history = M.auc_history(model, sets, every=history_every)
        best = M.early_stop(history, patience)
    scored = M.score(model, held, keep=[*KEY, LABEL], ntree_limit=ntree_limit)
    reports, sizes = _judged(scored, sample, threshold)
    if model_path:
        model_store.save_model(model, model_path, best)
    return TrainResult(model, model_path, sizes, reports, history, best, sample)


def _judged(scored: DataFrame, sample: DataFrame, threshold: float) -> tuple[dict[str, DataFrame], DataFrame]:
    """M7 on the scored holdout, and A11 from what is already written: the sample and the holdout's histogram."""
    reports = M.evaluate(scored, threshold)
    hist = reports.pop("histogram")  # every holdout row, any label, is counted there
    role = F.when(F.col(LABEL) == 1, F.lit("positive")).otherwise(F.lit("negative"))
    held = hist.agg(F.sum(F.col("_pos") + F.col("_neg") + F.col("_bad")).cast("long").alias("rows"))
    return reports, subset_sizes(sample, role).unionByName(held.select(F.lit("holdout").alias("role"), "rows"))


@dataclass
class BoostResult:
    booster: B.Booster
    model_path: str | None
    sizes: DataFrame
    reports: dict[str, DataFrame]
    sample: DataFrame


def train_boosted(
    training: DataFrame,
    n_sample: int,
    params: B.BoostParams = B.BoostParams(),
    model_path: str | None = None,
    threshold: float = 0.5,
    ntree_limit: int | None = None,
) -> BoostResult:
    """W3 with the second-order booster: D1 -> J1 -> D2 -> M2/M3/M4 -> M7 -> A2 -> S9.

    As ``train_evaluate``, but with the reference's leaf penalties, missing values
    as they are (no P7), and the AUC history and the stop inside the training. The
    holdout is scored by the trees that early stopping chose, unless ``ntree_limit`` says otherwise.
    """
    checkpoint_root(training.sparkSession)
    sample, held = S.class_sample_and_holdout(training, n_sample)
    sample = materialize_packed(sample, "sample")
    split = materialize_packed(S.half_split(sample), "split")
    booster = B.train(split, params, is_val=F.col("is_test"))
    scored = tree_index.score(booster.index(ntree_limit), held, [*KEY, LABEL])
    reports, sizes = _judged(scored, sample, threshold)
    if model_path:
        model_store.save_booster(booster, model_path)
    return BoostResult(booster, model_path, sizes, reports, sample)


def evaluate_saved(labelled: DataFrame, model_path: str, threshold: float = 0.5, ntree_limit: int | None = None) -> dict[str, DataFrame]:
    """S10 -> M6 -> M7: a stored model of either kind judged on labelled rows, with ``model_store.trees_to_use`` trees."""
    scored = tree_index.score(model_store.load_index(model_path, ntree_limit), labelled, [*KEY, LABEL])
    reports = M.evaluate(scored, threshold)
    reports.pop("histogram")
    return reports


# --- W4: tune -----------------------------------------------------------------------


def tune(
    training: DataFrame,
    n_sample: int,
    init_points: int = TU.INIT_POINTS,
    n_iter: int = TU.N_ITER,
    parallelism: int = 4,
    seed: int = 90,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """D1 -> D3 -> M8 (+A10) -> M9 -> L3. Returns (trials, best trial, folded sample)."""
    checkpoint_root(training.sparkSession)
    sample = materialize_packed(S.class_sample(training, n_sample), "sample")
    folded = materialize_packed(S.fold_assign(sample), "folds")
    trials = TU.search(folded, init_points=init_points, n_iter=n_iter, seed=seed, parallelism=parallelism)
    return trials, TU.best_trial(trials), folded


def prefix_auc(features: DataFrame, ensemble: E.Ensemble = E.FIXED_ENSEMBLE) -> DataFrame:
    """M3 on a fixed ensemble: AUC of the first k trees for every k, in one pass."""
    filled = fill_missing(features, subset=FEATURES)
    n = len(ensemble)
    scores = F.array(*[F.struct(F.lit(k).alias("trees"), E.probability(ensemble, k).alias("score")) for k in range(1, n + 1)])
    long = filled.select(LABEL, F.inline(scores))
    return auc(long, by=["trees"])
