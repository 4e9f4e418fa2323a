"""Hyper-parameter search.

M8 scores one parameter set by k-fold AUC; M9 searches a box: stage 1 draws
seeded random points in it, stage 2 asks a Gaussian-process model of the scores
so far for batches of points with the best expected improvement. The points of a
batch and all their folds are independent, so they are fit as concurrent Spark
jobs (``parallelism``), and all held-out folds are scored by all their models in
one pass. Every fit is itself distributed; only the trial table (one row per
point) and the trees (bounded by the models) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.functions.link import float_param, int_param, logistic
from datescore.operators import model as M
from datescore.operators import surrogate
from datescore.operators.metrics import auc, mean_over
from datescore.operators.tree_index import TreeIndex
from datescore.schema import FEATURES, LABEL
from datescore.session import delete_path, materialize_packed, work_path

# The reference's search box. MLlib has no L1/L2 leaf
# penalties; minInfoGain and subsamplingRate stand in as the regularisers
# that exist. n_estimators starts at 1 (0 trees is not a model).
SEARCH_BOX: dict[str, tuple[float, float]] = {
    "max_depth": (2, 15),
    "n_estimators": (1, 20),
    "eta": (0.01, 0.2),
    "min_info_gain": (0.0, 0.1),
    "subsampling_rate": (0.5, 1.0),
}
INIT_POINTS = 10
N_ITER = 25
FOLDS = 3
BATCH = 5  # guided points that are tried side by side
WHOLE = ("max_depth", "n_estimators")
# The tuner's constant parameters (subsample 0.9,
# colsample_bytree 0.9, random_state 90).
TUNER_BASE = M.TreeParams(subsampling_rate=0.9, feature_subset="0.9", seed=90, min_instances_per_node=1, min_info_gain=0.0)

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("trial_id", T.IntegerType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("max_depth", T.DoubleType(), False),
        T.StructField("n_estimators", T.DoubleType(), False),
        T.StructField("eta", T.DoubleType(), False),
        T.StructField("min_info_gain", T.DoubleType(), False),
        T.StructField("subsampling_rate", T.DoubleType(), False),
        T.StructField("score", T.DoubleType(), True),
    ]
)


@dataclass(frozen=True)
class Point:
    max_depth: float
    n_estimators: float
    eta: float
    min_info_gain: float
    subsampling_rate: float

    def params(self, base: M.TreeParams) -> M.TreeParams:
        """integer parameters truncate toward zero, like ``int()``."""
        return base.replace(
            max_depth=int(self.max_depth),
            max_iter=max(1, int(self.n_estimators)),
            step_size=float(self.eta),
            min_info_gain=float(self.min_info_gain),
            subsampling_rate=float(self.subsampling_rate),
        )


def draw(box: dict[str, tuple[float, float]], count: int, seed: int) -> list[Point]:
    rng = np.random.default_rng(seed)
    names = list(Point.__dataclass_fields__)
    cols = {n: rng.uniform(box[n][0], box[n][1], size=count) for n in names}
    return [Point(**{n: float(cols[n][i]) for n in names}) for i in range(count)]


def cross_validate(
    folded: DataFrame,
    points: list[Point],
    base: M.TreeParams = TUNER_BASE,
    folds: int = FOLDS,
    parallelism: int = 4,
    features: list[str] | None = None,
) -> list[float]:
    """M8 + A10: mean AUC over ``folds`` for each point; ``folded`` has a ``fold`` column.

    Every (point, fold) fit is an independent distributed job submitted from a
    driver thread pool, so up to ``parallelism`` fits share the cluster; the
    largest start first, so none is left running alone at the end. Each reads the
    rows from their written table and MLlib keeps its own copy, so that the fits
    spread over the executors and do not gather at one cached copy. The
    trees of all of them are read back as one node table, and one pass over the
    rows scores each with the models that were fit without its fold
    (``score_held_out``). The tie-aware AUC (A9) of every (point, fold) comes
    from one grouped AUC computation, the mean over folds from a Spark
    aggregation. No model is refit on all rows (only the scores are needed).
    """
    feats = list(features or FEATURES)
    return _validate(fold_rows(folded, feats), points, base, folds, parallelism, feats)


def fold_rows(folded: DataFrame, features: list[str]) -> DataFrame:
    """The folded rows as the fits and the scoring read them, written once."""
    rows = M.training_frame(folded, features, keep=["fold"]).withColumn("fold", F.col("fold").cast("int"))
    return materialize_packed(rows, "fold-rows")


def _validate(
    data: DataFrame, points: list[Point], base: M.TreeParams, folds: int, parallelism: int, feats: list[str]
) -> list[float]:
    """``cross_validate`` on written ``fold_rows``."""
    spark = data.sparkSession
    root = work_path(spark, "fold-models")

    def fit(task: tuple[int, int]) -> None:
        i, k = task
        model = M.estimator(points[i].params(base), feats).fit(data.where(F.col("fold") != k))
        M.gbt_stage(model).write().save(f"{root}/{i}-{k}")

    try:
        params = [p.params(base) for p in points]
        largest = sorted(range(len(points)), key=lambda i: -params[i].max_iter * params[i].max_depth)
        tasks = [(i, k) for i in largest for k in range(folds)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(fit, tasks))
        indexes = held_out_indexes(spark, root, feats, folds, len(points))
        per_fold = auc(score_held_out(data, indexes, feats), by=["trial", "fold"])
        means = {r["trial"]: r["score"] for r in mean_over(per_fold, "auc", ["trial"], "score").collect()}
    finally:
        delete_path(spark, root)
    return [float("nan") if means.get(i) is None else float(means[i]) for i in range(len(points))]


def held_out_indexes(spark, root: str, features: list[str], folds: int, trials: int) -> list[TreeIndex]:
    """One threshold index for each fold: the models of all points that were fit without it, stored at ``root/point-fold``."""
    nodes = M.saved_node_table(spark, f"{root}/*", features, tag=r"/(\d+-\d+)/").toArrow().to_pandas()
    both = nodes["tag"].str.split("-", expand=True).astype(int)
    nodes = nodes.assign(model=both[0], fold=both[1])
    out = []
    for k in range(folds):
        own = nodes[nodes["fold"] == k]
        # Trees of different models have numbers of their own.
        own = own.assign(tree=own["tree"] + own["model"] * (int(nodes["tree"].max()) + 1))
        index = TreeIndex(own, features, M.MLLIB_MARGIN_SCALE, fill=True)
        index.models = trials
        out.append(index)
    return out


def score_held_out(data: DataFrame, indexes: list[TreeIndex], features: list[str]) -> DataFrame:
    """(trial, fold, label, score): every row scored by all models of its fold's index, in one pass over ``data``."""
    shared = data.sparkSession.sparkContext.broadcast(indexes)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def margins(fold: pd.Series, *columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns])
        out = np.full((len(x), shared.value[0].models), np.nan)
        for k, index in enumerate(shared.value):
            rows = np.flatnonzero(fold.to_numpy() == k)
            out[rows] = index.margins(x[rows])
        return pd.Series(list(out))

    m = margins(F.col("fold"), *[F.col(c).cast("double") for c in features])
    long = data.select("fold", LABEL, F.posexplode(m).alias("trial", "_m"))
    return long.select("trial", "fold", LABEL, logistic(F.lit(indexes[0].margin_scale) * F.col("_m")).alias("score"))


def search(
    folded: DataFrame,
    box: dict[str, tuple[float, float]] | None = None,
    init_points: int = INIT_POINTS,
    n_iter: int = N_ITER,
    seed: int = 90,
    parallelism: int = 4,
    base: M.TreeParams = TUNER_BASE,
    batch: int = BATCH,
) -> DataFrame:
    """M9: random points, then guided batches; returns the trial table (one row per evaluated point)."""
    box = box or SEARCH_BOX
    names = list(Point.__dataclass_fields__)
    bounds = np.array([box[n] for n in names], dtype=float)
    whole = np.array([n in WHOLE for n in names])
    points = draw(box, init_points, seed)
    data = fold_rows(folded, FEATURES)
    scores = _validate(data, points, base, FOLDS, parallelism, FEATURES) if points else []
    # No guided stage when no point could be scored (e.g. a one-class fold).
    while len(points) < init_points + n_iter and not np.isnan(np.array(scores, dtype=float)).all():
        tried = np.array([[getattr(p, n) for n in names] for p in points])
        count = min(batch, init_points + n_iter - len(points))
        asked = surrogate.propose(tried, np.array(scores, dtype=float), bounds, count, seed + len(points), whole)
        new = [Point(*map(float, row)) for row in asked]
        scores += _validate(data, new, base, FOLDS, parallelism, FEATURES)
        points += new
    rows = []
    for i, (p, s) in enumerate(zip(points, scores)):
        stage = "random" if i < init_points else "guided"
        rows.append(
            (i, stage, p.max_depth, p.n_estimators, p.eta, p.min_info_gain, p.subsampling_rate, None if math.isnan(s) else s)
        )
    return folded.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def trial_params(trials: DataFrame) -> DataFrame:
    """the parameters a trial actually trains with (integers truncated)."""
    return trials.select(
        "trial_id",
        int_param(F.col("max_depth")).alias("max_depth"),
        F.greatest(F.lit(1), int_param(F.col("n_estimators"))).alias("n_estimators"),
        float_param(F.col("eta")).alias("eta"),
        float_param(F.col("min_info_gain")).alias("min_info_gain"),
        float_param(F.col("subsampling_rate")).alias("subsampling_rate"),
        "score",
    )


def best_trial(trials: DataFrame, params: list[str] | None = None, score: str = "score", trial: str = "trial_id") -> DataFrame:
    """L3: the trial with the highest score; ties go to the lowest trial id."""
    params = params or [c for c in trials.columns if c not in (score, trial)]
    order = F.struct(F.col(score), (-F.col(trial)).alias("_neg_id"))
    best = F.max_by(F.struct(F.col(trial), *[F.col(c) for c in params], F.col(score)), order)
    return trials.where(F.col(score).isNotNull()).agg(best.alias("_b")).select("_b.*")
