"""Isotonic calibration of raw scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Isotonic:
    """A non-decreasing step function, whose steps begin halfway between the scores on their sides."""

    starts: np.ndarray
    values: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(len(x))
        at = np.maximum(np.searchsorted(self.starts, x, side="right") - 1, 0)
        return self.values[at]


def fit_isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> Isotonic:
    """Pool adjacent violators: `total` is the weighted sum of the 0/1 labels at each x."""
    order = np.argsort(x, kind="stable")
    starts: list[float] = []
    ends: list[float] = []
    weights: list[float] = []
    totals: list[float] = []
    for value, w, t in zip(x[order].tolist(), weight[order].tolist(), total[order].tolist(), strict=True):
        starts.append(value)
        ends.append(value)
        weights.append(w)
        totals.append(t)
        while len(starts) > 1 and (starts[-1] == starts[-2] or totals[-2] * weights[-1] >= totals[-1] * weights[-2]):
            starts.pop()
            ends[-2:] = ends[-1:]
            w, t = weights.pop(), totals.pop()
            weights[-1] += w
            totals[-1] += t
    halfway = (np.array(starts[1:]) + np.array(ends[:-1])) / 2
    return Isotonic(np.concatenate([starts[:1], halfway]), np.array(totals) / np.maximum(np.array(weights), 1e-300))
