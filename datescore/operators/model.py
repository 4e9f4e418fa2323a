"""Boosted-tree model operators on Spark ML (M1-M7).

The reference trains gradient-boosted trees (binary logistic loss) on a small
balanced sample and scores every candidate row with the first 1500 trees.
Here: ``VectorAssembler`` + ``GBTClassifier`` in one ``Pipeline``; scoring is
``PipelineModel.transform`` (distributed, keys stay in the row).

Parameter map (MLlib has no L1/L2 leaf penalties or patience stopping):
gamma -> minInfoGain, subsample -> subsamplingRate, colsample_bytree x
colsample_bylevel -> featureSubsetStrategy (per node), min_child_weight ->
minInstancesPerNode, eta -> stepSize, num_boost_round -> maxIter. MLlib's
probability is 1 / (1 + exp(-2 margin)).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

from datescore.functions.fill import fill_missing
from datescore.operators import ensemble as E
from datescore.operators.metrics import (
    auc,
    auc_from_histogram,
    binary_metrics,
    class_report,
    confusion_matrix,
    histogram_pairs,
    score_histogram,
)
from datescore.operators.tree_index import TreeIndex, from_node_table
from datescore.schema import FEATURES, KEY, LABEL, require_columns
from datescore.session import checkpoint_root, materialize, work_path

MLLIB_MARGIN_SCALE = 2.0


@dataclass(frozen=True)
class TreeParams:
    """The reference's training parameters, mapped to MLlib."""

    max_iter: int = 2000  # num_boost_round
    max_depth: int = 7
    step_size: float = 0.01  # eta
    min_info_gain: float = 0.03  # gamma
    subsampling_rate: float = 0.75  # subsample
    feature_subset: str = "0.81"  # colsample_bytree 0.9 x colsample_bylevel 0.9
    min_instances_per_node: int = 4  # ~ min_child_weight 0.8 at hessian 0.25 per row
    seed: int = 123
    max_bins: int = 32
    checkpoint_interval: int = 10
    # Node-id caching pays off for deep trees on large inputs; off by default
    # (MLlib's default), as the training sample is usually small.
    cache_node_ids: bool = False

    def replace(self, **kw) -> TreeParams:
        return TreeParams(**{**asdict(self), **kw})


def assembler(features: list[str] | None = None) -> VectorAssembler:
    """M1: feature vector; NaN or null is an error, so fill (P7) first."""
    return VectorAssembler(inputCols=list(features or FEATURES), outputCol="features", handleInvalid="error")


def gbt(params: TreeParams) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol=LABEL,
        lossType="logistic",
        maxIter=params.max_iter,
        maxDepth=params.max_depth,
        stepSize=params.step_size,
        minInfoGain=params.min_info_gain,
        subsamplingRate=params.subsampling_rate,
        featureSubsetStrategy=params.feature_subset,
        minInstancesPerNode=params.min_instances_per_node,
        maxBins=params.max_bins,
        seed=params.seed,
        checkpointInterval=params.checkpoint_interval,
        cacheNodeIds=params.cache_node_ids,
    )


def estimator(params: TreeParams, features: list[str] | None = None) -> Pipeline:
    return Pipeline(stages=[assembler(features), gbt(params)])


def training_frame(df: DataFrame, features: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Features filled, label as DOUBLE, plus ``keep`` columns; nothing else is read."""
    feats = list(features or FEATURES)
    filled = fill_missing(df.select(*feats, LABEL, *(keep or [])), subset=feats)
    return filled.withColumn(LABEL, F.col(LABEL).cast("double"))


def train(df: DataFrame, params: TreeParams, features: list[str] | None = None) -> PipelineModel:
    """M2: fit on ``df`` (the training part of the sample).

    Boosting re-reads its input once per tree, so the input is persisted; the
    session's shared checkpoint folder lets MLlib cut the lineage every
    ``checkpoint_interval`` trees, so a lost executor does not replay the run.
    """
    checkpoint_root(df.sparkSession)
    data = training_frame(df, features).persist()
    try:
        return estimator(params, features).fit(data)
    finally:
        data.unpersist()


def gbt_stage(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def prefix_model(model: PipelineModel, k: int) -> PipelineModel:
    """M5: the same pipeline with only the first ``k`` trees (k >= 1).

    Built with the public JVM constructor of ``GBTClassificationModel``
    (classic session; not available over Spark Connect).
    """
    if is_remote():
        raise RuntimeError("a prefix of an MLlib model needs a classic session; over Spark Connect score with model_store.load_index")
    g = gbt_stage(model)
    k = max(1, k)
    if k >= g.getNumTrees:
        return model
    gw = SparkContext.getOrCreate()._gateway
    jvm = gw.jvm
    # Both arrays are copied on the JVM side: a few calls, whatever the number of trees.
    trees = gw.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    weights = gw.new_array(jvm.double, k)
    jvm.java.lang.System.arraycopy(g._java_obj.trees(), 0, trees, 0, k)
    jvm.java.lang.System.arraycopy(g._java_obj.treeWeights(), 0, weights, 0, k)
    jprefix = jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{g.uid}_first{k}", trees, weights)
    prefix = GBTClassificationModel(jprefix)
    prefix.setFeaturesCol(g.getFeaturesCol())
    return PipelineModel(stages=[*model.stages[:-1], prefix])


def score(
    model: PipelineModel, df: DataFrame, keep: list[str] | None = None, ntree_limit: int | None = None
) -> DataFrame:
    """M6: P(class 1) for every row, with the ``keep`` columns in the same row.

    ``ntree_limit`` scores with the first trees only (M5).
    """
    keep = list(keep if keep is not None else KEY)
    require_columns(df, FEATURES)
    m = prefix_model(model, ntree_limit) if ntree_limit else model
    filled = fill_missing(df, subset=FEATURES)
    out = m.transform(filled)
    return out.select(*keep, vector_to_array(F.col("probability")).getItem(1).alias("score"))


def evaluate(scored: DataFrame, t: float = 0.5) -> dict[str, DataFrame]:
    """M7: reports on a scored holdout (columns ``score`` and ``label``).

    One pass over the holdout: it is reduced to its score histogram
    (positives and negatives per distinct score), written once under the
    shared folder; every report is derived from that small table. Metrics
    use the strict threshold (>), the confusion matrix the inclusive one
    (>=), as the reference does.
    """
    hist = materialize(score_histogram(scored), "holdout-histogram")
    strict = histogram_pairs(hist, t, inclusive=False)
    inclusive = histogram_pairs(hist, t, inclusive=True)
    return {
        "class_report": class_report(strict, weight="w"),
        "metrics": binary_metrics(strict, weight="w"),
        "confusion": confusion_matrix(inclusive, weight="w"),
        "auc": auc_from_histogram(hist),
        "histogram": hist,
    }


# --- trained trees as node structures (M3 history, CASE scoring) --------------


def node_table(model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """The trained trees as a node table (``ensemble.NODE_TABLE_SCHEMA``).

    The GBT stage is written once under the shared folder and its nodes are
    reshaped by Spark, so a model of any size needs no per-node calls to the JVM.
    """
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    path = work_path(spark, "model-nodes")
    gbt_stage(model).write().overwrite().save(path)
    return saved_node_table(spark, path, features)


def saved_node_table(spark: SparkSession, path: str, features: list[str] | None = None, tag: str | None = None) -> DataFrame:
    """The node table of a GBT stage saved at ``path``.

    MLlib stores an ensemble as Parquet rows (treeID, nodeData) and one row of
    metadata for each tree. Its splits send ``x <= threshold`` to the left child.
    ``path`` may stand for several stages; then ``tag`` is a pattern whose group,
    found in the file's name, becomes the column ``tag`` that tells them apart.
    """
    names = F.array(*[F.lit(c) for c in features or FEATURES])
    of = (F.regexp_extract(F.input_file_name(), tag, 1) if tag else F.lit("")).alias("tag")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight").select("treeID", "weight", of)
    # One row for each tree, whatever the data.
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData", of).join(F.broadcast(weights), ["tag", "treeID"])
    n = F.col("nodeData")
    leaf = n["leftChild"] < 0
    return nodes.select(
        F.col("treeID").cast("int").alias("tree"),
        "weight",
        n["id"].cast("int").alias("node"),
        F.when(~leaf, F.element_at(names, n["split"]["featureIndex"] + 1)).alias("feature"),
        F.when(~leaf, F.element_at(n["split"]["leftCategoriesOrThreshold"], 1)).alias("threshold"),
        F.when(~leaf, n["leftChild"].cast("int")).alias("left"),
        F.when(~leaf, n["rightChild"].cast("int")).alias("right"),
        F.when(leaf, n["prediction"]).alias("value"),
        F.when(~leaf, F.lit(True)).alias("inclusive"),
        *(["tag"] if tag else []),
    )


def tree_index(model: PipelineModel, k: int | None = None, features: list[str] | None = None) -> TreeIndex:
    """M5: the first ``k`` trees (all without it) as a threshold index; the same margins, many times faster to start."""
    feats = list(features or FEATURES)
    return from_node_table(node_table(model, feats), feats, k, MLLIB_MARGIN_SCALE, fill=True)


def to_ensemble(model: PipelineModel, features: list[str] | None = None) -> E.Ensemble:
    """The trained trees as (weight, tree) with feature names (bounded by the model's size)."""
    return E.from_node_table(node_table(model, features))


def auc_history(
    model: PipelineModel, sets: DataFrame, every: int = 100, features: list[str] | None = None
) -> DataFrame:
    """M3: AUC of the first k trees for k = every, 2*every, ..., all; per ``set``.

    ``sets`` holds labelled rows with a ``set`` column (e.g. 'train', 'val').
    All prefixes come from one vectorised pass over the trees.
    """
    feats = list(features or FEATURES)
    ens = to_ensemble(model, feats)
    n = len(ens)
    marks = sorted({*range(every, n + 1, every), n})
    udf, marks = E.prefix_margins_udf(ens, feats, marks)
    filled = fill_missing(sets.select("set", LABEL, *feats), subset=feats)
    m = filled.select("set", LABEL, udf(*[F.col(c) for c in feats]).alias("_m"))
    long = m.select(
        "set",
        LABEL,
        F.posexplode(F.col("_m")).alias("_i", "_margin"),
    ).select(
        "set",
        LABEL,
        F.element_at(F.array(*[F.lit(k) for k in marks]), F.col("_i") + 1).alias("trees"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-MLLIB_MARGIN_SCALE) * F.col("_margin")))).alias("score"),
    )
    return auc(long, by=["set", "trees"])


def early_stop(history: DataFrame, patience: int = 50, set_name: str = "val") -> int:
    """M4: the best number of trees under patience stopping on the M3 history.

    Scans prefixes in order. A mark that improves strictly becomes the best,
    however far it is from the last; a mark that does not, ``patience`` or more
    trees after the best, stops the scan. The history has one row per
    evaluated prefix (bounded by the number of trees), so it is read here.
    """
    rows = history.where(F.col("set") == set_name).select("trees", "auc").orderBy("trees").collect()
    best_k, best = None, float("-inf")
    for r in rows:
        if r["auc"] is None:
            continue
        if r["auc"] > best:
            best_k, best = r["trees"], r["auc"]
        elif r["trees"] - best_k >= patience:
            break
    return int(best_k or (rows[-1]["trees"] if rows else 0))
