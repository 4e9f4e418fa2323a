"""Trained models as Parquet.

A model is stored with its trees as a node table (``nodes``) and one row of facts
(``facts``): the number of trees that early stopping chose, the scale of the
margin, whether missing features are filled, and the features in order. Jobs that
only score read these (``load_index``). An MLlib pipeline is stored as its own
directory (metadata and nodes) as well, so that it can be loaded as a pipeline.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from datescore.operators import model as M
from datescore.operators.boosting import Booster
from datescore.operators.tree_index import TreeIndex, from_node_table
from datescore.schema import FEATURES

NTREE_LIMIT = 1500  # fixed value: the trees that score where none were chosen
NODES = (
    "tree int, weight double, node int, feature string, threshold double, left int, right int, value double,"
    " inclusive boolean, missing_left boolean"
)


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def save_nodes(
    nodes: DataFrame, path: str, features: list[str], best_trees: int | None = None, margin_scale: float = 1.0, fill: bool = False
) -> str:
    """The node table and the facts, side by side at ``path``."""
    # Written in the order of trees: the first k are read from the first files.
    nodes.repartitionByRange(1 + len(features) // 8, "tree", "node").sortWithinPartitions("tree", "node").write.mode("overwrite").parquet(f"{path}/nodes")
    facts = [(best_trees, float(margin_scale), fill, list(features))]
    schema = "best_trees int, margin_scale double, fill boolean, features array<string>"
    nodes.sparkSession.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return path


def save_model(model: PipelineModel, path: str, best_trees: int | None = None) -> str:
    """An MLlib pipeline, with its node table beside it."""
    model.write().overwrite().save(path)
    spark = _session()
    stage = f"{path}/stages/{len(model.stages) - 1}_{M.gbt_stage(model).uid}"
    return save_nodes(M.saved_node_table(spark, stage), path, FEATURES, best_trees, M.MLLIB_MARGIN_SCALE, fill=True)


def save_booster(booster: Booster, path: str) -> str:
    """A second-order booster (``operators.boosting``); its size is that of the model."""
    nodes = _session().createDataFrame(booster.node_rows(), NODES)
    return save_nodes(nodes, path, booster.features, booster.best_trees)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _facts(path: str):
    try:
        return _session().read.parquet(f"{path}/facts").first()
    except AnalysisException:
        return None


def load_best_trees(path: str) -> int | None:
    """The stored choice of early stopping, None if the model has none."""
    facts = _facts(path)
    return facts["best_trees"] if facts else None


def trees_to_use(path: str, ntree_limit: int | None = None) -> int:
    """M5, one rule for all jobs: the caller's number, else the stored choice, else NTREE_LIMIT."""
    return ntree_limit or load_best_trees(path) or NTREE_LIMIT


def load_index(path: str, ntree_limit: int | None = None) -> TreeIndex:
    """The first trees (``trees_to_use``) of a stored model of either kind, ready to score."""
    facts = _facts(path)
    if facts is None:
        raise ValueError(f"{path} holds no node table; save the model with save_model or save_booster")
    nodes = _session().read.parquet(f"{path}/nodes")
    limit = ntree_limit or facts["best_trees"] or NTREE_LIMIT
    return from_node_table(nodes, facts["features"], limit, facts["margin_scale"], facts["fill"])
