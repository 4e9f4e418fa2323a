"""A Gaussian-process model of trial scores and batches of promising points (M9).

The observations are the rows of a trial table (tens of rows, whatever the data
the trials ran on), so the model is a small matrix on the driver; what is
expensive, the trials, runs on the cluster. A batch is proposed by expected
improvement; after each point of the batch the model believes its own mean
there, so the points of one batch differ and can be tried side by side.

Points are in the unit cube; whole-number parameters are truncated first, so the
model sees what a trial really uses.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

CANDIDATES = 2000
# Length scales and noises that are tried for the best evidence.
SCALES = (0.1, 0.2, 0.35, 0.6, 1.0, 1.8)
NOISES = (1e-6, 1e-3, 1e-2, 1e-1)


def kernel(a: np.ndarray, b: np.ndarray, scale: float) -> np.ndarray:
    """Matern 5/2 covariance of points with unit variance."""
    d = np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2), 0.0)) * (math.sqrt(5.0) / scale)
    return (1.0 + d + d * d / 3.0) * np.exp(-d)


@dataclass
class Process:
    """A fitted process: observed points, the factor of their covariance and the weights of their scores."""

    x: np.ndarray
    scale: float
    noise: float
    mean: float
    spread: float
    factor: np.ndarray
    weights: np.ndarray
    evidence: float

    def at(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of the score at points."""
        k = kernel(points, self.x, self.scale)
        v = np.linalg.solve(self.factor, k.T)
        variance = np.maximum(1.0 + 1e-12 - (v * v).sum(axis=0), 1e-12)
        return self.mean + self.spread * (k @ self.weights), self.spread * np.sqrt(variance)


def _fit(x: np.ndarray, y: np.ndarray, scale: float, noise: float) -> Process:
    mean, spread = float(y.mean()), float(y.std()) or 1.0
    z = (y - mean) / spread
    factor = np.linalg.cholesky(kernel(x, x, scale) + (noise + 1e-9) * np.eye(len(x)))
    weights = np.linalg.solve(factor.T, np.linalg.solve(factor, z))
    evidence = float(-0.5 * z @ weights - np.log(np.diag(factor)).sum())
    return Process(x, scale, noise, mean, spread, factor, weights, evidence)


def fit(x: np.ndarray, y: np.ndarray) -> Process:
    """The process whose length scale and noise explain the scores best."""
    return max((_fit(x, y, s, n) for s in SCALES for n in NOISES), key=lambda p: p.evidence)


def _normal(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Density and distribution of the standard normal."""
    return np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi), np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])


def expected_improvement(process: Process, points: np.ndarray, best: float) -> np.ndarray:
    mean, deviation = process.at(points)
    z = (mean - best) / deviation
    density, below = _normal(z)
    return (mean - best) * below + deviation * density


def propose(
    points: np.ndarray, scores: np.ndarray, box: np.ndarray, count: int, seed: int, whole: np.ndarray | None = None, candidates: int = CANDIDATES
) -> np.ndarray:
    """``count`` points of ``box`` (low and high of each parameter) to try next; points without a score are left out.

    Candidates are drawn in the whole box and around the best points. ``whole``
    says which parameters are truncated to whole numbers by a trial.
    """
    rng = np.random.default_rng(seed)
    low, width = box[:, 0], np.maximum(box[:, 1] - box[:, 0], 1e-300)
    whole = np.zeros(len(box), dtype=bool) if whole is None else whole

    def unit(p: np.ndarray) -> np.ndarray:
        return (np.where(whole, np.floor(p), p) - low) / width

    known = np.isfinite(scores)
    if not known.any():
        return low + rng.random((count, len(box))) * width
    x, y = unit(points[known]), scores[known].astype(float)
    out = []
    model = fit(x, y)
    for _ in range(count):
        near = points[known][np.argsort(-scores[known])[:3]]
        local = near[rng.integers(0, len(near), candidates // 2)] + rng.normal(0, 0.08, (candidates // 2, len(box))) * width
        wide = low + rng.random((candidates - len(local), len(box))) * width
        drawn = np.clip(np.concatenate([wide, local]), box[:, 0], box[:, 1])
        at = unit(drawn)
        chosen = int(expected_improvement(model, at, float(y.max())).argmax())
        out.append(drawn[chosen])
        # What the model expects there stands in for the score until the batch is tried.
        x, y = np.concatenate([x, at[chosen : chosen + 1]]), np.append(y, model.at(at[chosen : chosen + 1])[0])
        model = _fit(x, y, model.scale, max(model.noise, 1e-6))
    return np.array(out)
