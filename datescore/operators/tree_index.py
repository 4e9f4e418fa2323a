"""Scoring of large tree ensembles by sorted thresholds and leaf bit masks (M5, M6, M8).

A tree's leaves are numbered from left to right, one bit each. A node whose test
fails (the row goes right) rules out the leaves of its left side, so the row's
leaf is the first one that no failed test has ruled out. All tests of a feature,
over all trees, are sorted by threshold: a row fails a prefix of them. The index
holds, for a group of trees and a feature, the masks of every prefix and one for
missing values, so a row costs one binary search for each feature and then, for
each group, one gathered mask a feature, whatever the depth of the trees.

The index is built once from a node table (its size is that of the model, not of
any data), broadcast, and applied to Arrow batches. Trees with more than
MAX_LEAVES leaves, whose masks would be long, are walked node by node instead.

Several models may share an index (the fits of a search): each row then gets the
margin of every model in one pass.

Defined results: null and NaN features are missing; a missing value goes where
the node says (``missing_left``), and right where the node table does not have
that column, as in ``ensemble``. Without trees the margin is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.functions.fill import fill_missing
from datescore.functions.link import logistic
from datescore.schema import require_columns

GROUP = 32  # trees whose masks stand side by side
MAX_LEAVES = 256
ROWS = 512  # rows scored at a time: their masks stay in the cache


@dataclass
class _Nodes:
    """Node table as arrays over all trees; children are positions, -1 for leaves."""

    tree: np.ndarray
    model: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: np.ndarray  # first leaf below, counted from the tree's left
    leaves: np.ndarray  # leaves below
    roots: np.ndarray


@dataclass
class _Group:
    """Trees scored together: for each feature the prefix masks, the last row for missing values."""

    row_of: list[np.ndarray] = field(default_factory=list)  # position among all cuts -> row of the table
    tables: list[np.ndarray | None] = field(default_factory=list)
    values: np.ndarray = None  # (trees, leaves), weighted
    first: np.ndarray = None  # where the trees of each model begin
    models: np.ndarray = None
    words: int = 1


class TreeIndex:
    def __init__(self, nodes: pd.DataFrame, features: list[str], margin_scale: float = 1.0, fill: bool = False):
        """``nodes``: columns of ``ensemble.NODE_TABLE_SCHEMA``, optionally ``missing_left`` and ``model``.

        ``margin_scale`` is what the logistic link multiplies the margin by, ``fill``
        whether missing features are filled (P7) before scoring, as in training.
        """
        self.features = list(features)
        self.margin_scale, self.fill = margin_scale, fill
        arrays = _arrays(nodes, self.features)
        self.models = int(arrays.model.max(initial=0)) + 1
        self.trees = len(arrays.roots)
        inner = arrays.feature >= 0
        #: sorted distinct thresholds of each feature over all trees
        self.cuts = [np.unique(arrays.threshold[inner & (arrays.feature == f)]) for f in range(len(self.features))]
        flat = arrays.leaves[arrays.roots] <= MAX_LEAVES
        order = arrays.roots[flat]
        self.groups = [self._group(arrays, order[i : i + GROUP]) for i in range(0, len(order), GROUP)]
        deep = arrays.roots[~flat]
        self.deep = (arrays, deep) if len(deep) else None

    def _group(self, a: _Nodes, roots: np.ndarray) -> _Group:
        position = np.full(int(a.tree.max()) + 1, -1)
        position[a.tree[roots]] = np.arange(len(roots))
        own = np.flatnonzero(position[a.tree] >= 0)
        words = -(-int(a.leaves[roots].max()) // 64)
        g = _Group(words=words)
        leaf = own[a.feature[own] < 0]
        g.values = np.zeros((len(roots), 64 * words))
        g.values[position[a.tree[leaf]], a.start[leaf]] = a.value[leaf]
        for f, cuts in enumerate(self.cuts):
            test = own[a.feature[own] == f]
            if not len(test):
                g.row_of.append(np.zeros(0, dtype=np.int32))
                g.tables.append(None)
                continue
            mine = np.unique(a.threshold[test])
            table = np.full((len(mine) + 2, len(roots), words), ~np.uint64(0))
            # Leaves of the left child are ruled out where the test fails.
            lo = a.start[test]
            hi = lo + a.leaves[a.left[test]]
            tree, rank = position[a.tree[test]], np.searchsorted(mine, a.threshold[test])
            right_if_missing = ~a.missing_left[test]
            for w in range(words):
                keep = ~(_ones(hi - 64 * w) & ~_ones(lo - 64 * w))
                np.bitwise_and.at(table, (rank + 1, tree, w), keep)
                some = right_if_missing
                np.bitwise_and.at(table, (np.full(some.sum(), len(mine) + 1), tree[some], w), keep[some])
            np.bitwise_and.accumulate(table[:-1], axis=0, out=table[:-1])
            g.tables.append(table.reshape(len(mine) + 2, -1))
            # How many of the group's thresholds are among the first k cuts of the feature; then missing.
            g.row_of.append(np.append(np.searchsorted(mine, np.append(-np.inf, cuts), side="right"), len(mine) + 1).astype(np.int32))
        models = a.model[roots]
        g.first = np.flatnonzero(np.append(True, models[1:] != models[:-1]))
        g.models = models[g.first]
        return g

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(rows, models): the weighted sums of the leaves of each model's trees."""
        out = np.zeros((len(x), self.models))
        for start in range(0, len(x), ROWS):
            self._add(x[start : start + ROWS], out[start : start + ROWS])
        return out

    def _add(self, x: np.ndarray, out: np.ndarray) -> None:
        n = len(x)
        codes = []
        for f, cuts in enumerate(self.cuts):
            code = np.searchsorted(cuts, x[:, f], side="right")
            code[np.isnan(x[:, f])] = len(cuts) + 1
            codes.append(code)
        for g in self.groups:
            trees = len(g.values)
            masks = np.full((n, trees * g.words), ~np.uint64(0))
            part = np.empty_like(masks)
            for code, row_of, table in zip(codes, g.row_of, g.tables):
                if table is not None:
                    np.take(table, row_of[code], axis=0, out=part, mode="clip")
                    masks &= part
            value = g.values[np.arange(trees), _first_bit(masks.reshape(n, trees, g.words))]
            out[:, g.models] += np.add.reduceat(value, g.first, axis=1)
        if self.deep:
            a, roots = self.deep
            for root in roots:
                out[:, a.model[root]] += _walk(a, root, x)

    def size(self) -> int:
        """Bytes of the mask tables."""
        return sum(t.nbytes for g in self.groups for t in g.tables if t is not None)


def _ones(n: np.ndarray) -> np.ndarray:
    """Words with the lowest ``n`` bits set (none below 0, all from 64)."""
    n = np.clip(n, 0, 64)
    return np.where(n == 64, ~np.uint64(0), (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1))


def _first_bit(masks: np.ndarray) -> np.ndarray:
    """Position of the lowest bit set in each (rows, trees) of (rows, trees, words)."""
    word = masks[..., 0]
    base = 0
    for w in range(1, masks.shape[2]):
        none = word == 0
        word = np.where(none, masks[..., w], word)
        base = np.where(none, 64 * w, base)
    lowest = word & (~word + np.uint64(1))
    return np.frexp(lowest.astype(np.float64))[1] - 1 + base


def _walk(a: _Nodes, root: int, x: np.ndarray) -> np.ndarray:
    at = np.full(len(x), root)
    rows = np.arange(len(x))
    while True:
        f = a.feature[at]
        inner = f >= 0
        if not inner.any():
            return a.value[at]
        v = x[rows, np.maximum(f, 0)]
        left = np.where(np.isnan(v), a.missing_left[at], v < a.threshold[at])
        at = np.where(inner, np.where(left, a.left[at], a.right[at]), at)


def _arrays(nodes: pd.DataFrame, features: list[str]) -> _Nodes:
    nodes = nodes.sort_values(["tree", "node"], kind="stable", ignore_index=True)
    tree, node = nodes["tree"].to_numpy(np.int64), nodes["node"].to_numpy(np.int64)
    n = len(nodes)
    first = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if n else np.zeros(0, dtype=np.int64)
    base = np.repeat(first, np.diff(np.append(first, n)))
    dense = np.array_equal(node, np.arange(n) - base) if n else True
    code = {name: i for i, name in enumerate(features)}
    unknown = set(nodes["feature"].dropna()) - set(code)
    if unknown:
        raise ValueError(f"the trees split on features that are not given: {sorted(unknown)}")
    feature = nodes["feature"].map(code).fillna(-1).to_numpy(np.int64)
    inner = feature >= 0

    def child(name: str) -> np.ndarray:
        c = nodes[name].astype("float64").fillna(-1).to_numpy().astype(np.int64)
        if dense:
            return np.where(inner, base + c, -1)
        span = int(max(node.max(initial=0), c.max(initial=0))) + 1
        return np.where(inner, np.searchsorted(tree * span + node, tree * span + c), -1)

    left, right = child("left"), child("right")
    threshold = nodes["threshold"].astype(float).to_numpy(np.float64, copy=True)
    # x <= t goes left: the same as x < the next number.
    inclusive = nodes["inclusive"].map(lambda v: v is True or v == 1).to_numpy(bool)
    threshold[inclusive] = np.nextafter(threshold[inclusive], np.inf)
    missing = nodes["missing_left"].map(lambda v: v is True or v == 1).to_numpy(bool) if "missing_left" in nodes else np.zeros(n, dtype=bool)
    model = nodes["model"].to_numpy(np.int64) if "model" in nodes else np.zeros(n, dtype=np.int64)
    weight = nodes["weight"].to_numpy(np.float64)
    value = np.where(inner, 0.0, weight * nodes["value"].astype(float).to_numpy(np.float64))
    child_of_some = np.zeros(n, dtype=bool)
    child_of_some[left[inner]] = child_of_some[right[inner]] = True
    roots = np.flatnonzero(~child_of_some)
    levels, at = [], roots
    while len(at):
        levels.append(at)
        split = at[inner[at]]
        at = np.concatenate([left[split], right[split]])
    leaves, start = np.ones(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for at in reversed(levels):
        split = at[inner[at]]
        leaves[split] = leaves[left[split]] + leaves[right[split]]
    for at in levels:
        split = at[inner[at]]
        start[left[split]] = start[split]
        start[right[split]] = start[split] + leaves[left[split]]
    roots = roots[np.argsort(model[roots], kind="stable")]
    return _Nodes(tree, model, feature, threshold, missing, left, right, value, start, leaves, roots)


def from_node_table(
    nodes: DataFrame, features: list[str], k: int | None = None, margin_scale: float = 1.0, fill: bool = False
) -> TreeIndex:
    """M5: the index of the first ``k`` trees (all without ``k``) of a node table.

    The nodes are bounded by trees x 2^(depth + 1), whatever the data.
    """
    if k is not None:
        nodes = nodes.where(F.col("tree") < max(1, k))
    return TreeIndex(nodes.toArrow().to_pandas(), features, margin_scale, fill)


def margins_udf(spark, index: TreeIndex):
    """The broadcast index as a function of the feature columns: an array with the margin of each model."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def margins(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns])
        return pd.Series(list(shared.value.margins(x)))

    return margins


def score_column(spark, index: TreeIndex) -> Column:
    """F2 on the margin: P(class 1)."""
    m = margin_column(spark, index)
    return logistic(m if index.margin_scale == 1.0 else F.lit(index.margin_scale) * m)


def score(index: TreeIndex, df: DataFrame, keep: list[str]) -> DataFrame:
    """M6: P(class 1) of every row as ``score``, with the ``keep`` columns in the same row."""
    require_columns(df, index.features)
    source = fill_missing(df, subset=index.features) if index.fill else df
    return source.select(*keep, score_column(df.sparkSession, index).alias("score"))


def margin_column(spark, index: TreeIndex) -> Column:
    """M6: the margin of a single model."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(T.DoubleType())
    def margin(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns])
        return pd.Series(shared.value.margins(x)[:, 0])

    return margin(*[F.col(c).cast("double") for c in index.features])
