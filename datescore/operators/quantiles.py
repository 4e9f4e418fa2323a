"""Mergeable weighted quantile summaries: the cut points of histogram boosting (M2).

A summary of weighted values is a sorted list of values, each with bounds on its
rank: ``below`` (the weight surely less than it), ``through`` (the weight at most
up to and including it) and ``weight`` (the weight surely at it). Summaries are
merged without loss and pruned to a fixed size, which widens a rank by at most
1/size of the whole weight. A task merges its batches like a binary counter, so
its rank error is bounded by their logarithm; the tasks' summaries are merged in
two shuffles (by feature and part, then by feature), one pass over the data.

With at most ``size`` distinct values nothing is pruned and ranks are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 64  # summaries of a feature that are left after the first shuffle


@dataclass
class Summary:
    value: np.ndarray
    below: np.ndarray
    through: np.ndarray
    weight: np.ndarray

    @property
    def total(self) -> float:
        return float(self.through[-1]) if len(self.value) else 0.0

    def error(self) -> float:
        """The largest doubt about a rank, as a share of the whole weight."""
        if not len(self.value):
            return 0.0
        own = self.through - self.below - self.weight
        between = self.through[1:] - self.weight[1:] - self.below[:-1] - self.weight[:-1]
        return float(max(own.max(), between.max(initial=0.0)) / self.total)

    def values_at(self, ranks: np.ndarray) -> np.ndarray:
        """The values whose rank bounds lie nearest to the given ranks."""
        middle = (self.below + self.through) / 2
        at = np.clip(np.searchsorted(middle, ranks), 1, max(1, len(middle) - 1))
        lower = np.abs(ranks - middle[at - 1]) <= np.abs(middle[np.minimum(at, len(middle) - 1)] - ranks)
        return self.value[np.where(lower, at - 1, np.minimum(at, len(middle) - 1))]


def exact(values: np.ndarray, weights: np.ndarray) -> Summary:
    """The summary of weighted values, without any doubt about ranks."""
    distinct, where = np.unique(values, return_inverse=True)
    w = np.bincount(where, weights=weights, minlength=len(distinct)).astype(np.float64)
    through = np.cumsum(w)
    return Summary(distinct, through - w, through, w)


def merge(parts: list[Summary]) -> Summary:
    """The summary of all values: bounds of ranks add up."""
    parts = [p for p in parts if len(p.value)]
    if not parts:
        return exact(np.zeros(0), np.zeros(0))
    if len(parts) == 1:
        return parts[0]
    value = np.unique(np.concatenate([p.value for p in parts]))
    below, through, weight = (np.zeros(len(value)) for _ in range(3))
    for p in parts:
        at = np.searchsorted(p.value, value)
        has = (at < len(p.value)) & (p.value[np.minimum(at, len(p.value) - 1)] == value)
        # A value that this part lacks lies between two of its entries.
        before = np.where(at > 0, (p.below + p.weight)[at - 1], 0.0)
        after = np.where(at < len(p.value), (p.through - p.weight)[np.minimum(at, len(p.value) - 1)], p.total)
        own = np.minimum(at, len(p.value) - 1)
        below += np.where(has, p.below[own], before)
        through += np.where(has, p.through[own], after)
        weight += np.where(has, p.weight[own], 0.0)
    return Summary(value, below, through, weight)


def prune(s: Summary, size: int) -> Summary:
    """At most ``size`` + 2 entries: the ends and those nearest to evenly spaced ranks."""
    if len(s.value) <= size:
        return s
    middle = (s.below + s.through) / 2
    ranks = np.linspace(0, s.total, size + 1)
    at = np.clip(np.searchsorted(middle, ranks), 1, len(middle) - 1)
    nearest = np.where(ranks - middle[at - 1] <= middle[at] - ranks, at - 1, at)
    keep = np.unique(np.concatenate([[0], nearest, [len(middle) - 1]]))
    return Summary(s.value[keep], s.below[keep], s.through[keep], s.weight[keep])


class _Counter:
    """Summaries of 1, 2, 4, ... batches: two of one size are merged into the next."""

    def __init__(self, size: int):
        self.size, self.levels = size, []

    def add(self, s: Summary) -> None:
        for i, held in enumerate(self.levels):
            if held is None:
                self.levels[i] = prune(s, self.size)
                return
            s, self.levels[i] = prune(merge([held, s]), self.size), None
        self.levels.append(prune(s, self.size))

    def result(self) -> Summary:
        return prune(merge([s for s in self.levels if s is not None]), self.size)


_DDL = "feature int, part int, value array<double>, below array<double>, through array<double>, weight array<double>"
_LISTS = ("value", "below", "through", "weight")
_SCHEMA = pa.schema([("feature", pa.int32()), ("part", pa.int32())] + [(c, pa.list_(pa.float64())) for c in _LISTS])


def _rows(features: list[int], parts: list[int], summaries: list[Summary]) -> list[pa.Array]:
    arrays = [pa.array(features, pa.int32()), pa.array(parts, pa.int32())]
    return arrays + [pa.array([getattr(s, c) for s in summaries], pa.list_(pa.float64())) for c in _LISTS]


def _read(table: pa.Table | pa.RecordBatch) -> list[Summary]:
    columns = [table.column(c).to_pylist() for c in _LISTS]
    return [Summary(*(np.array(c, dtype=np.float64) for c in row)) for row in zip(*columns)]


def summaries(df: DataFrame, features: list[str], size: int, weight: Column | None = None) -> list[Summary]:
    """The summary of each feature's values that are neither null nor NaN, in one pass over ``df``.

    On the driver there are at most len(features) x (size + 2) entries.
    """
    n = len(features)
    columns = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    w = (F.lit(1.0) if weight is None else weight.cast("double")).alias("w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [_Counter(size) for _ in range(n)]
        for batch in batches:
            weights = batch.column(n).to_numpy(zero_copy_only=False)
            for i, counter in enumerate(counters):
                x = batch.column(i).to_numpy(zero_copy_only=False)  # null is NaN here
                some = ~np.isnan(x)
                if some.any():
                    counter.add(exact(x[some], weights[some]))
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays(_rows(list(range(n)), [part] * n, [c.result() for c in counters]), schema=_SCHEMA)

    def combine(table: pa.Table) -> pa.Table:
        feature, part = (table.column(c)[0].as_py() for c in ("feature", "part"))
        return pa.Table.from_arrays(_rows([feature], [part], [prune(merge(_read(table)), size)]), schema=_SCHEMA)

    parts = df.select(*columns, w).mapInArrow(run, _DDL)
    first = parts.groupBy("feature", "part").applyInArrow(combine, _DDL)
    last = first.groupBy("feature").applyInArrow(combine, _DDL).toArrow()
    found = dict(zip(last.column("feature").to_pylist(), _read(last)))
    return [found.get(i) or exact(np.zeros(0), np.zeros(0)) for i in range(n)]


def cut_points(s: Summary, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 thresholds: all values but the least, or those at even ranks if there are more."""
    if len(s.value) <= bins:
        return s.value[1:]
    ranks = np.arange(1, bins) / bins * s.total
    cuts = np.unique(s.values_at(ranks))
    return cuts[cuts > s.value[0]]
