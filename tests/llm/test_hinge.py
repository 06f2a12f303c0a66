"""The linear model of the quality classifier against a plain solver of the same hinge loss."""

from __future__ import annotations

import math

import numpy as np
import pytest

from echoloom.llm import nbsvm


@pytest.mark.parametrize("noise", [0.0, 0.3])
def test_fit_equals_a_plain_solver_of_the_hinge_loss(noise):
    rng = np.random.default_rng(3)
    n, width = 40, 30
    labels = (rng.random(n) < 0.4).astype(int)
    rows = []
    for label in labels:
        side = label if rng.random() >= noise else 1 - label
        chosen = np.where(rng.random(12) < 0.7, rng.integers(0, 15, 12) + 15 * side, rng.integers(0, width, 12))
        rows.append(np.unique(chosen).astype(np.int64))
    model = nbsvm.fit(rows, labels.tolist(), rounds=3000)

    y = np.where(labels == 1, 1.0, -1.0)
    counts = np.full((2, nbsvm.DIMENSIONS), nbsvm.SMOOTHING)
    for found, label in zip(rows, labels):
        counts[label, found] += 1
    ratio = (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()))[:width]
    x = np.zeros((n, width + 1))
    for i, found in enumerate(rows):
        x[i, found] = ratio[found] / math.sqrt(len(found))
    x[:, width] = 1.0
    positive = labels.sum()
    cost = np.where(y > 0, 0.5 * n / positive, 0.5 * n / (n - positive)) * nbsvm.COST
    # Projected gradients on the dual, whose multipliers lie between 0 and the cost.
    q = (x @ x.T) * y[:, None] * y[None, :]
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(200_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, cost)
    w = (alpha * y) @ x

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()

    found = np.append(model.weights[:width].astype(float) / np.where(ratio == 0, 1, ratio), model.bias)
    assert loss(found) <= loss(w) * 1.01  # the fit stops at slopes of a hundredth
    assert x @ found == pytest.approx(x @ w, abs=0.05)
    if noise:
        assert np.isclose(alpha, cost).any() and (alpha < 1e-9).any()
