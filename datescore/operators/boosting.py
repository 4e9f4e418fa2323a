"""Second-order boosted trees on Spark (M2, M3, M4): leaf penalties, missing values, early stop.

Rows are binned once (codes of one byte for each feature, one code for missing)
and written with their label, set and margin. A level of a tree is one Spark job:
tasks send, for every open node, feature and bin, the sums of gradients and
Hessians; Spark adds them up by cell. The sums, bounded by nodes x features x
bins whatever the rows, decide the splits: L1 and L2 leaf penalties, least
Hessian weight of a child, and the side to which missing values go.

Gradients are rounded to multiples of 2^-26 and added as integers, so the sums,
and with them the trees, do not depend on partitions, order or retries.

Trees are grown in blocks. Inside a block a row's margin is its stored one plus
the block's few trees; at the end the table is written with the new margins (the
lineage ends there) and the AUC of both sets is one aggregation over stored
margins: no earlier tree is scored again. Patience stops the training there, so
rounds beyond the stop are never paid.

Defined results: null and NaN features are missing; rows with a null label or a
label other than 0 and 1 are an error. Equal rows share their luck in row
sampling (it hashes the row's key). Without rows in the training set it is an
error; a feature that is always missing or constant is never split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datescore.functions.hashing import fields_text
from datescore.operators import quantiles
from datescore.operators.metrics import auc
from datescore.operators.tree_index import TreeIndex
from datescore.schema import FEATURES, KEY, LABEL
from datescore.session import delete_path, work_path

UNIT = float(1 << 26)  # gradients are whole multiples of 1 / UNIT
MISSING = 255  # the code of a missing value
MAX_BINS = 255


# Those of ``ensemble.NODE_TABLE_SCHEMA`` and the side of missing values.
NODE_COLUMNS = ["tree", "weight", "node", "feature", "threshold", "left", "right", "value", "inclusive", "missing_left"]


@dataclass(frozen=True)
class BoostParams:
    """The reference's training parameters under their own names."""

    rounds: int = 2000
    max_depth: int = 7
    eta: float = 0.01
    reg_lambda: float = 1.0
    reg_alpha: float = 1.0
    gamma: float = 0.03
    min_child_weight: float = 0.8
    subsample: float = 0.75
    colsample_bytree: float = 0.9
    colsample_bylevel: float = 0.9
    early_stopping_rounds: int = 50
    seed: int = 123
    max_bins: int = 64
    block: int = 50  # trees between two marks of the history

    def replace(self, **kw) -> BoostParams:
        return BoostParams(**{**asdict(self), **kw})


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, leaves have feature -1. Left: code <= bin, missing as ``missing_left`` says."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    g: list[float] = field(default_factory=list)
    h: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, g: float, h: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("missing_left", False), ("left", -1), ("right", -1), ("gain", 0.0), ("value", 0.0)):
            getattr(self, name).append(v)
        self.g.append(g)
        self.h.append(h)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(getattr(self, c)) for c in ("feature", "bin", "missing_left", "left", "right", "value"))


def leaf_of(arrays: tuple[np.ndarray, ...], codes: np.ndarray) -> np.ndarray:
    """The node each row of ``codes`` (rows, features) ends in."""
    feature, split, missing_left, left, right, _ = arrays
    at = np.zeros(len(codes), dtype=np.int64)
    rows = np.arange(len(codes))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        c = codes[rows, np.maximum(f, 0)]
        goes_left = np.where(c == MISSING, missing_left[at], c <= split[at])
        at = np.where(inner, np.where(goes_left, left[at], right[at]), at)


@dataclass
class Booster:
    features: list[str]
    cuts: list[np.ndarray]
    trees: list[Tree]
    history: list[tuple[int, str, float | None]]  # trees, set, AUC
    best_trees: int
    params: BoostParams

    def node_rows(self) -> list[tuple]:
        """The trees as rows of a node table (NODE_COLUMNS)."""
        rows = []
        for k, t in enumerate(self.trees):
            for i, f in enumerate(t.feature):
                if f < 0:
                    rows.append((k, 1.0, i, None, None, None, None, float(t.value[i]), None, None))
                else:
                    cuts = self.cuts[f]
                    threshold = float(cuts[t.bin[i]]) if t.bin[i] < len(cuts) else float("inf")
                    rows.append((k, 1.0, i, self.features[f], threshold, t.left[i], t.right[i], None, False, bool(t.missing_left[i])))
        return rows

    def nodes(self) -> pd.DataFrame:
        return pd.DataFrame(self.node_rows(), columns=NODE_COLUMNS)

    def index(self, k: int | None = None) -> TreeIndex:
        """The first ``k`` trees (the best number without it), to score with."""
        nodes = self.nodes()
        return TreeIndex(nodes[nodes["tree"] < (self.best_trees if k is None else max(1, k))], self.features)


# --- rows ---------------------------------------------------------------------------------

_ROWS = "uid bigint, y double, is_val boolean, codes binary, margin double"
_ROWS_SCHEMA = pa.schema([("uid", pa.int64()), ("y", pa.float64()), ("is_val", pa.bool_()), ("codes", pa.binary()), ("margin", pa.float64())])


def bin_rows(df: DataFrame, features: list[str], cuts: list[np.ndarray], is_val: Column, key: list[str]) -> DataFrame:
    """One row of codes for each row of ``df``, with its label, its set, a hash of its key and margin 0."""
    n = len(features)
    label = F.col(LABEL).cast("double")
    wrong = F.concat(F.lit("a label is neither 0 nor 1: "), F.coalesce(label.cast("string"), F.lit("null")))
    checked = F.when(label.isin(0.0, 1.0), label).otherwise(F.raise_error(wrong).cast("double"))
    columns = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, n), dtype=np.uint8)
            for i, c in enumerate(cuts):
                x = batch.column(i).to_numpy(zero_copy_only=False)
                codes[:, i] = np.where(np.isnan(x), MISSING, np.searchsorted(c, x, side="right"))
            rest = [batch.column(n), batch.column(n + 1), batch.column(n + 2)]
            yield pa.RecordBatch.from_arrays([*rest, _codes_array(codes), pa.array(np.zeros(batch.num_rows))], schema=_ROWS_SCHEMA)

    source = df.select(*columns, F.xxhash64(fields_text(key)).alias("uid"), checked.alias("y"), is_val.alias("is_val"))
    return source.mapInArrow(run, _ROWS)


def _codes_array(codes: np.ndarray) -> pa.Array:
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(codes.tobytes())])
    return fixed.cast(pa.binary())


def _read_codes(batch: pa.RecordBatch) -> np.ndarray:
    a = batch.column(batch.schema.get_field_index("codes"))
    if not len(a):
        return np.zeros((0, 1), dtype=np.uint8)
    width = len(a[0].as_py())
    start = a.offset * width + np.frombuffer(a.buffers()[1], dtype=np.int32)[0]
    return np.frombuffer(a.buffers()[2], dtype=np.uint8)[start : start + len(a) * width].reshape(-1, width)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _margins(batch: pa.RecordBatch, codes: np.ndarray, block: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Stored margins and what the block's trees add."""
    margin = _column(batch, "margin").copy()
    for tree in block:
        margin += tree[-1][leaf_of(tree, codes)]
    return margin


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss, as whole multiples of 1 / UNIT."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - y) * UNIT), np.rint(p * (1.0 - p) * UNIT)


def in_sample(uid: np.ndarray, tree: int, params: BoostParams) -> np.ndarray:
    """Whether rows take part in a tree: a hash of the row's key and the tree."""
    if params.subsample >= 1.0:
        return np.ones(len(uid), dtype=bool)
    z = uid.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1 + (params.seed << 20))) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) < params.subsample


# --- histograms ---------------------------------------------------------------------------


def histogram(
    table: DataFrame, block: list[tuple[np.ndarray, ...]], tree: Tree, open_nodes: list[int], number: int, n_features: int, params: BoostParams
) -> np.ndarray:
    """(open nodes, features, codes, 3): sums of gradients, Hessians (in units) and rows, added up by Spark."""
    width = params.max_bins + 1  # the last one for missing values
    arrays = tree.arrays()
    slot = np.full(len(tree.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))
    cells = len(open_nodes) * n_features * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, cells), dtype=np.int64)
        for batch in batches:
            codes = _read_codes(batch)
            take = in_sample(_column(batch, "uid"), number, params)
            if not take.any():
                continue
            at = slot[leaf_of(arrays, codes)]
            g, h = gradients(_margins(batch, codes, block), _column(batch, "y"))
            take &= at >= 0
            codes, at, g, h = codes[take], at[take], g[take], h[take]
            base = at[:, None] * n_features + np.arange(n_features)
            cell = (base * width + np.where(codes == MISSING, width - 1, codes)).ravel()
            for i, v in enumerate((g, h)):
                sums[i] += np.bincount(cell, weights=np.repeat(v, n_features), minlength=cells).astype(np.int64)
            sums[2] += np.bincount(cell, minlength=cells)
        some = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(s[some]) for s in sums)], names=["cell", "g", "h", "n"])

    parts = table.where(~F.col("is_val")).mapInArrow(run, "cell int, g bigint, h bigint, n bigint")
    got = parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()
    out = np.zeros((cells, 3), dtype=np.int64)
    out[got.column("cell").to_numpy()] = np.stack([got.column(c).to_numpy() for c in ("g", "h", "n")], axis=1)
    return out.reshape(len(open_nodes), n_features, width, 3)


def shrunk(g, alpha: float):
    """The gradient sum after the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(hist: np.ndarray, bins: list[int], active: np.ndarray, params: BoostParams) -> list[dict | None]:
    """The best split of every open node; ``bins``: number of cuts of each feature.

    Ties go to the lower feature, then the lower cut, then missing values right.
    """
    sums = hist.astype(np.float64)
    sums[..., :2] /= UNIT
    present = sums[:, :, :-1].cumsum(axis=2)
    missing = sums[:, :, -1:]
    whole = present[:, :, -1:] + missing
    # Side 0: missing values go right, side 1: left.
    left = np.stack([present, present + missing], axis=3)
    right = whole[:, :, :, None] - left

    def part(s: np.ndarray) -> np.ndarray:
        return shrunk(s[..., 0], params.reg_alpha) ** 2 / (s[..., 1] + params.reg_lambda)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = part(left) + part(right) - part(whole)[:, :, :, None]
    cuts = np.arange(present.shape[2])[None, :] < np.array(bins)[:, None]
    fits = np.zeros(gain.shape, dtype=bool)
    fits[:] = (cuts & active[:, None])[None, :, :, None]
    # All values left and only missing ones right: the place after the last cut.
    fits[..., 0] |= ((np.arange(present.shape[2])[None, :] == np.array(bins)[:, None]) & active[:, None])[None]
    fits &= (left[..., 2] > 0) & (right[..., 2] > 0)
    fits &= (left[..., 1] >= params.min_child_weight) & (right[..., 1] >= params.min_child_weight)
    gain = np.where(fits & np.isfinite(gain), gain, -np.inf)
    out = []
    for node in range(len(gain)):
        at = int(gain[node].argmax())
        f, b, side = np.unravel_index(at, gain[node].shape)
        if not gain[node][f, b, side] > 1e-6:
            out.append(None)
            continue
        out.append(
            {"feature": int(f), "bin": int(b), "missing_left": bool(side), "gain": float(gain[node][f, b, side]),
             "left": left[node, f, b, side], "right": right[node, f, b, side]}
        )
    return out


def _pick(rng: np.random.Generator, columns: np.ndarray, share: float) -> np.ndarray:
    count = max(1, int(share * len(columns)))
    return np.sort(rng.choice(columns, count, replace=False)) if count < len(columns) else columns


def grow(
    table: DataFrame, block: list[tuple[np.ndarray, ...]], number: int, bins: list[int], params: BoostParams
) -> Tree:
    """One tree, level by level: one histogram job each; then pruned and its leaves weighed."""
    n = len(bins)
    rng = np.random.default_rng([params.seed, number])
    columns = _pick(rng, np.arange(n), params.colsample_bytree)
    tree, open_nodes = Tree(), []
    for level in range(params.max_depth):
        if level == 0:
            tree.add(0.0, 0.0)
            open_nodes = [0]
        active = np.zeros(n, dtype=bool)
        active[_pick(rng, columns, params.colsample_bylevel)] = True
        hist = histogram(table, block, tree, open_nodes, number, n, params)
        if level == 0:
            tree.g[0], tree.h[0] = (hist[0, 0, :, :2].sum(axis=0) / UNIT).tolist()
        following = []
        for node, split in zip(open_nodes, best_splits(hist, bins, active, params)):
            if split is None:
                continue
            for side in ("left", "right"):
                getattr(tree, side)[node] = tree.add(float(split[side][0]), float(split[side][1]))
                following.append(getattr(tree, side)[node])
            for name in ("feature", "bin", "missing_left", "gain"):
                getattr(tree, name)[node] = split[name]
        open_nodes = following
        if not open_nodes:
            break
    return _finished(tree, params)


def _finished(tree: Tree, params: BoostParams) -> Tree:
    """Splits above leaves that gain less than ``gamma`` go, from below; the leaves left get their weights."""
    for node in range(len(tree.feature) - 1, -1, -1):  # children come after their parent
        if tree.feature[node] < 0:
            continue
        below = (tree.left[node], tree.right[node])
        if all(tree.feature[c] < 0 for c in below) and tree.gain[node] < params.gamma:
            tree.feature[node] = -1
    out = Tree()

    def copy(node: int) -> int:
        i = out.add(tree.g[node], tree.h[node])
        out.gain[i] = tree.gain[node]
        if tree.feature[node] < 0:
            denominator = tree.h[node] + params.reg_lambda
            out.value[i] = float(-params.eta * shrunk(tree.g[node], params.reg_alpha) / denominator) if denominator > 0 else 0.0
            return i
        for name in ("feature", "bin", "missing_left"):
            getattr(out, name)[i] = getattr(tree, name)[node]
        out.left[i] = copy(tree.left[node])
        out.right[i] = copy(tree.right[node])
        return i

    copy(0)
    return out


# --- training -------------------------------------------------------------------------------


def add_block(table: DataFrame, block: list[tuple[np.ndarray, ...]]) -> DataFrame:
    """The rows with the block's trees in their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("margin")
            margin = pa.array(_margins(batch, _read_codes(batch), block))
            yield batch.set_column(at, batch.schema.field(at), margin)

    return table.mapInArrow(run, _ROWS)


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = work_path(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def set_auc(table: DataFrame) -> dict[str, float | None]:
    """The AUC of the stored margins of both sets; one aggregation."""
    rows = table.select(F.when(F.col("is_val"), F.lit("val")).otherwise(F.lit("train")).alias("set"), F.col("y").alias(LABEL), F.col("margin").alias("score"))
    return {r["set"]: r["auc"] for r in auc(rows, by=["set"]).collect()}


def train(
    df: DataFrame,
    params: BoostParams = BoostParams(),
    is_val: Column | None = None,
    features: list[str] | None = None,
    key: list[str] | None = None,
    cuts: list[np.ndarray] | None = None,
) -> Booster:
    """M2-M4: fit on the rows of ``df`` that are not ``is_val``; features are taken as they are, missing values included.

    Stops after ``early_stopping_rounds`` trees without a better AUC of the
    validation rows (of the training rows if there are none).
    """
    feats = list(features or FEATURES)
    if not 2 <= params.max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be between 2 and {MAX_BINS}")
    is_val = F.lit(False) if is_val is None else F.coalesce(is_val, F.lit(False))
    if cuts is None:
        found = quantiles.summaries(df.where(~is_val), feats, 16 * params.max_bins)
        cuts = [quantiles.cut_points(s, params.max_bins) for s in found]
    bins = [len(c) for c in cuts]
    spark: SparkSession = df.sparkSession
    table, path = _write(bin_rows(df, feats, cuts, is_val, key or KEY))
    if table.where(~F.col("is_val")).isEmpty():
        raise ValueError("no rows to train on")
    trees: list[Tree] = []
    history: list[tuple[int, str, float | None]] = []
    best, best_trees = float("-inf"), 0
    while len(trees) < params.rounds:
        block: list[tuple[np.ndarray, ...]] = []
        for _ in range(min(params.block, params.rounds - len(trees))):
            trees.append(grow(table, block, len(trees), bins, params))
            block.append(trees[-1].arrays())
        new, new_path = _write(add_block(table, block))
        delete_path(spark, path)
        table, path = new, new_path
        at = set_auc(table)
        history += [(len(trees), name, at[name]) for name in sorted(at)]
        now = at.get("val", at.get("train"))
        if now is not None and now > best:
            best, best_trees = now, len(trees)
        elif len(trees) - best_trees >= params.early_stopping_rounds:
            break
    delete_path(spark, path)
    return Booster(feats, cuts, trees, history, best_trees or len(trees), params)
