"""Guided search: the process against its formulas, and the search against random points on known surfaces."""

from __future__ import annotations

import numpy as np
import pytest

from datescore.operators import surrogate as G

BOX = np.array([[2.0, 15.0], [1.0, 20.0], [0.01, 0.2], [0.0, 0.1], [0.5, 1.0]])
WHOLE = np.array([True, True, False, False, False])


def surface(p):
    """Best (0) at depth 6, 14 trees, rate 0.12; the other parameters matter little."""
    u = (np.where(WHOLE, np.floor(p), p) - BOX[:, 0]) / (BOX[:, 1] - BOX[:, 0])
    target = np.array([4 / 13, 13 / 19, 0.58, 0.2, 0.7])
    return -float((np.array([1.0, 1.0, 1.0, 0.05, 0.05]) * (u - target) ** 2).sum())


def random_points(rng, n):
    return BOX[:, 0] + rng.random((n, len(BOX))) * (BOX[:, 1] - BOX[:, 0])


def guided(seed, n_init=10, n_iter=25, batch=5):
    points = random_points(np.random.default_rng(seed), n_init)
    scores = np.array([surface(p) for p in points])
    while len(points) < n_init + n_iter:
        new = G.propose(points, scores, BOX, min(batch, n_init + n_iter - len(points)), seed + len(points), WHOLE)
        points = np.concatenate([points, new])
        scores = np.append(scores, [surface(p) for p in new])
    return points, scores


def test_beats_random_points_in_most_seeds():
    wins = 0
    for seed in range(20):
        points, scores = guided(seed)
        assert len(points) == 35 and (points >= BOX[:, 0]).all() and (points <= BOX[:, 1]).all()
        wins += scores.max() > max(surface(p) for p in random_points(np.random.default_rng(seed), 35))
    assert wins >= 17


def test_same_seed_same_points():
    assert np.array_equal(guided(3)[0], guided(3)[0]) and not np.array_equal(guided(3)[0], guided(4)[0])


def test_process_passes_through_what_it_knows():
    rng = np.random.default_rng(0)
    x = rng.random((12, 3))
    y = np.sin(4 * x[:, 0]) + x[:, 1]
    model = G._fit(x, y, 0.6, 1e-6)
    mean, deviation = model.at(x)
    assert mean == pytest.approx(y, abs=1e-3) and deviation.max() < 5e-3
    far, wide = model.at(np.full((1, 3), 40.0))
    assert far[0] == pytest.approx(y.mean(), abs=1e-6) and wide[0] == pytest.approx(y.std(), rel=1e-6)
    # The formula, by a plain inverse.
    k = G.kernel(x, x, 0.6) + (1e-6 + 1e-9) * np.eye(12)
    p = rng.random((4, 3))
    z = (y - y.mean()) / y.std()
    assert model.at(p)[0] == pytest.approx(y.mean() + y.std() * G.kernel(p, x, 0.6) @ np.linalg.inv(k) @ z, abs=1e-6)


def test_batches_spread_and_missing_scores_are_left_out():
    points = random_points(np.random.default_rng(1), 10)
    scores = np.array([surface(p) for p in points])
    batch = G.propose(points, scores, BOX, 5, 1, WHOLE)
    unit = (batch - BOX[:, 0]) / (BOX[:, 1] - BOX[:, 0])
    assert min(np.abs(a - b).max() for i, a in enumerate(unit) for b in unit[:i]) > 1e-3
    scores[::2] = np.nan
    assert np.isfinite(G.propose(points, scores, BOX, 3, 1, WHOLE)).all()
    assert G.propose(points, np.full(10, np.nan), BOX, 4, 1).shape == (4, 5)
    assert np.isfinite(G.propose(points, np.zeros(10), BOX, 2, 1)).all()  # all scores equal
    assert np.isfinite(G.propose(np.repeat(points[:1], 6, axis=0), np.arange(6.0), BOX, 2, 1)).all()  # one point again and again
