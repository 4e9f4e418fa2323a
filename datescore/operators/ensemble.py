"""Tree ensembles as column expressions (M10, F2, prefix scoring for M5/M3).

An ensemble is a list of (weight, tree). A small ensemble compiles to nested
``CASE WHEN`` expressions: the score is computed JVM-side inside whole-stage
codegen, and the same trees can be written as SQL for an exact oracle. Large
ensembles (hundreds of deep trees) exceed the JVM method-size limit; their
caller asks for the vectorised form (numpy over node arrays), which gives the
same scores, or goes through ``operators.model`` (MLlib's own transform).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.functions.link import logistic


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Go ``left`` when feature < threshold (``inclusive``: <=), else ``right``."""

    feature: str
    threshold: float
    left: Node
    right: Node
    inclusive: bool = False


Node = Leaf | Split
Ensemble = list[tuple[float, Node]]


def tree_column(node: Node) -> Column:
    if isinstance(node, Leaf):
        return F.lit(float(node.value))
    x = F.col(node.feature)
    cond = x <= F.lit(node.threshold) if node.inclusive else x < F.lit(node.threshold)
    return F.when(cond, tree_column(node.left)).otherwise(tree_column(node.right))


def margin(ensemble: Ensemble, k: int | None = None) -> Column:
    """Weighted sum of the first ``k`` trees (all when ``k`` is None)."""
    trees = ensemble[: k if k is not None else len(ensemble)]
    if not trees:
        return F.lit(0.0)
    total: Column | None = None
    for w, t in trees:
        term = tree_column(t) if w == 1.0 else F.lit(float(w)) * tree_column(t)
        total = term if total is None else total + term
    return total


def probability(ensemble: Ensemble, k: int | None = None, margin_scale: float = 1.0) -> Column:
    """Score of class 1: logistic of the (scaled) margin. MLlib GBT uses scale 2."""
    m = margin(ensemble, k)
    return logistic(m if margin_scale == 1.0 else F.lit(margin_scale) * m)


# The three-tree test ensemble of FIXTURES.md §4 (leaves are
# invented; it has no predictive value). Missing inputs are filled with 0 first.
FIXED_ENSEMBLE: Ensemble = [
    (
        1.0,
        Split(
            "search_date_rate",
            0.3,
            Split("pre_days", 3, Leaf(-0.6), Leaf(-0.9)),
            Split("pre_days", 7, Leaf(-0.2), Leaf(-0.5)),
        ),
    ),
    (1.0, Split("is_student", 0.5, Leaf(-0.1), Leaf(0.4))),
    (
        1.0,
        Split(
            "history_weekend_rate",
            0.25,
            Split("date_cnt", 2, Leaf(0.7), Leaf(-0.3)),
            Split("date_cnt", 3, Leaf(0.5), Leaf(-0.2)),
        ),
    ),
]


# --- large ensembles: node arrays + vectorised evaluation ---------------------


@dataclass
class NodeArrays:
    """One tree as flat arrays; node 0 is the root. Leaves have feature -1.

    ``inclusive`` is per node: the splits of one tree may compare differently.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    inclusive: np.ndarray


def to_arrays(node: Node, features: list[str]) -> NodeArrays:
    index = {f: i for i, f in enumerate(features)}
    feat, thr, left, right, val, inclusive = [], [], [], [], [], []

    def visit(n: Node) -> int:
        i = len(feat)
        feat.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        val.append(0.0)
        inclusive.append(False)
        if isinstance(n, Leaf):
            val[i] = float(n.value)
            return i
        inclusive[i] = n.inclusive
        feat[i] = index[n.feature]
        thr[i] = float(n.threshold)
        left[i] = visit(n.left)
        right[i] = visit(n.right)
        return i

    visit(node)
    return NodeArrays(
        np.array(feat, dtype=np.int32),
        np.array(thr, dtype=np.float64),
        np.array(left, dtype=np.int32),
        np.array(right, dtype=np.int32),
        np.array(val, dtype=np.float64),
        np.array(inclusive, dtype=bool),
    )


def prefix_margins_udf(ensemble: Ensemble, features: list[str], checkpoints: list[int]):
    """Pandas UDF: margins of the first k trees for every k in ``checkpoints``.

    The node arrays travel as a broadcast variable (once per executor, not
    per task); their size is fixed by the model (trees x nodes), not by the
    data. One pass over the trees serves all prefixes, so scoring 20 prefixes
    of a 2000-tree model costs one scoring. The UDF holds only numpy arrays
    and a nested function, so executors need numpy and pandas, not this
    package.
    """
    from pyspark import SparkContext

    trees = []
    for w, t in ensemble:
        a = to_arrays(t, features)
        trees.append((float(w), a.feature, a.threshold, a.left, a.right, a.value, a.inclusive))
    shared = SparkContext.getOrCreate().broadcast(trees)
    marks = sorted(set(checkpoints))

    def eval_tree(feature, thr, left, right, value, inclusive, x):
        idx = np.zeros(x.shape[0], dtype=np.int32)
        rows = np.arange(x.shape[0])
        while True:
            f = feature[idx]
            inner = f >= 0
            if not inner.any():
                return value[idx]
            xv = x[rows, np.where(inner, f, 0)]
            go_left = (xv < thr[idx]) | (inclusive[idx] & (xv == thr[idx]))
            idx = np.where(inner, np.where(go_left, left[idx], right[idx]), idx)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def margins(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols])
        total = np.zeros(x.shape[0])
        out = np.zeros((x.shape[0], len(marks)))
        j = 0
        for i, (w, *arrays) in enumerate(shared.value, start=1):
            total += w * eval_tree(*arrays, x)
            while j < len(marks) and marks[j] == i:
                out[:, j] = total
                j += 1
        while j < len(marks):
            out[:, j] = total
            j += 1
        return pd.Series(list(out))

    return margins, marks


# --- M10 for large ensembles, and ensembles stored as node tables -------------

NODE_TABLE_SCHEMA = (
    "tree int, weight double, node int, feature string, threshold double, "
    "left int, right int, value double, inclusive boolean"
)


def probability_column(
    ensemble: Ensemble, features: list[str], k: int | None = None, margin_scale: float = 1.0, compiled: bool = True
) -> Column:
    """P(class 1) of the first ``k`` trees.

    The caller chooses the form: ``compiled`` CASE code, or a vectorised UDF
    over broadcast node arrays for ensembles whose code would exceed the JVM's
    method limit. Both compare and add in the same order, so scores are equal.
    """
    trees = ensemble[: k if k is not None else len(ensemble)]
    if compiled:
        return probability(trees, margin_scale=margin_scale)
    udf, _ = prefix_margins_udf(trees, features, [len(trees)])
    m = udf(*[F.col(c) for c in features]).getItem(0)
    return logistic(m if margin_scale == 1.0 else F.lit(margin_scale) * m)


def node_rows(ensemble: Ensemble) -> list[tuple]:
    """The ensemble as node-table rows (node 0 is each tree's root)."""
    rows = []
    for t_id, (w, tree) in enumerate(ensemble):
        nodes: list[tuple] = []

        def visit(n: Node) -> int:
            i = len(nodes)
            nodes.append(None)
            if isinstance(n, Leaf):
                nodes[i] = (t_id, float(w), i, None, None, None, None, float(n.value), None)
                return i
            left = visit(n.left)
            right = visit(n.right)
            nodes[i] = (t_id, float(w), i, n.feature, float(n.threshold), left, right, None, bool(n.inclusive))
            return i

        visit(tree)
        rows.extend(nodes)
    return rows


def node_table(spark, ensemble: Ensemble):
    """The ensemble as a DataFrame (one row per node), e.g. to store it as a table."""
    return spark.createDataFrame(node_rows(ensemble), NODE_TABLE_SCHEMA)


def from_node_table(nodes) -> Ensemble:
    """Read an ensemble back from a node table.

    A model's nodes are bounded by trees x 2^(depth+1), not by any data, so
    they are read to the driver to build the scoring expression or arrays.
    """
    by_tree: dict[int, dict[int, tuple]] = {}
    weights: dict[int, float] = {}
    for r in nodes.select(*[c.split()[0] for c in NODE_TABLE_SCHEMA.split(", ")]).collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r
        weights[r["tree"]] = r["weight"]

    def build(tree: dict[int, tuple], i: int) -> Node:
        r = tree[i]
        if r["feature"] is None:
            return Leaf(r["value"])
        return Split(r["feature"], r["threshold"], build(tree, r["left"]), build(tree, r["right"]), bool(r["inclusive"]))

    def root(tree: dict[int, tuple]) -> int:
        children = {c for r in tree.values() for c in (r["left"], r["right"]) if c is not None}
        return min(i for i in tree if i not in children)

    return [(weights[t], build(by_tree[t], root(by_tree[t]))) for t in sorted(by_tree)]
