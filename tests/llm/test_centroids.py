"""Centroid clustering: whole vectors only, exact rounds against plain integers, ties, blocks."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from datescore.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vector string, cluster string, occurring int"
EXTRA = (1, "x", "x", "x", 1)


def vectors():
    rng = random.Random(3)
    some = lambda: [rng.uniform(-1, 1) for _ in range(64)]
    hot = some()
    out = [(i, some()) for i in range(150)] + [(200 + i, hot) for i in range(90)]
    out += [(400, hot[:63]), (401, hot + [0.0]), (402, None), (403, []), (404, [None, *hot[1:]]), (405, [math.nan, *hot[1:]])]
    out += [(406, [math.inf, *hot[1:]]), (407, [-math.inf, *hot[1:]]), (5, some()), (5, some()), (None, some()), (None, hot)]
    out += [(410, [-1e-9] * 64), (411, [0.0] * 64), (412, [1000.5] * 64), (413, [-1000.5] * 64)] + [(414, [0.25] * 64)] * 3
    rng.shuffle(out)
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame([(i, v, *EXTRA) for i, v in data], SCHEMA).repartition(parts)


def brute(data, k=40, rounds=5):
    kept = [(i, v) for i, v in data if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    x = [[math.floor(256 * c) for c in v] for _, v in kept]
    centers = [list(v) for v in x[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)) for v in x]

    for _ in range(rounds):
        got = assign()
        for j in range(len(centers)):
            members = [v for v, (_, to) in zip(x, got) if to == j]
            if members:
                centers[j] = [sum(column) // len(members) for column in zip(*members)]
    got = assign()
    inertia = [sum(d for d, to in got if to == j) for j in range(len(centers))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, inertia[j], sum(inertia), digests[j]) for (i, _), (d, j) in zip(kept, got)), key=str)


@pytest.mark.parametrize("parts", [1, 4])
def test_equals_plain_integers(spark, parts):
    got = C.cluster_report(frame(spark, vectors(), parts))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(vectors())


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 7)
    assert sorted((tuple(r) for r in C.cluster_report(frame(spark, vectors(), 2)).collect()), key=str) == brute(vectors())


def test_fewer_vectors_than_centroids_and_none(spark):
    few = vectors()[:9]
    assert sorted((tuple(r) for r in C.cluster_report(frame(spark, few)).collect()), key=str) == brute(few)
    assert C.cluster_report(frame(spark, [(1, None), (2, [0.0])])).collect() == []
    assert C.cluster_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_that_could_overflow_are_an_error():
    ids, far = pa.array([1]), pa.array([[1e6] * 64], pa.list_(pa.float64()))
    with pytest.raises(ValueError, match="beyond"):
        C.whole_vectors(ids, far)
    ids, x = C.whole_vectors(ids, pa.array([[float(C.LIMIT // 256)] * 64], pa.list_(pa.float64())))
    assert x.tolist() == [[C.LIMIT] * 64]


def test_tables_are_exact_for_small_and_large_integers():
    rng = np.random.default_rng(1)
    for top in (300, C.LIMIT):
        x = rng.integers(-top, top, (50, 64), endpoint=True)
        centers = rng.integers(-top, top, (6, 64), endpoint=True)
        block = C._Codes(C._block(pa.array(range(50)), x), 0)
        cluster, distance = block.nearest(centers)
        plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centers] for v in x]
        assert [(p.index(min(p)), min(p)) for p in plain] == list(zip(cluster.tolist(), distance.tolist()))
        assert block.sums(cluster, 6).tolist() == [[int(s) for s in x[cluster == j].sum(axis=0)] for j in range(6)]
