"""Boosted regression trees with L1 and L2 leaf penalties; runs inside tasks, one series per call.

A series has at most 12 or 26 rows per year, so a whole fit is a few small histograms. Trees leave the task as
leaves: a value and the box of the feature space in which it holds. Everything after the fit is column expressions.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF_TYPE = "struct<value: double, box: array<struct<feature: int, low: double, high: double, share: double>>>"
MIN_GAIN = 1e-6
TIE = 1e-9


def cut_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Borders between bins: all midpoints of neighbours, or quantiles where there are more than ``max_bins`` values."""
    distinct = np.unique(values)
    if len(distinct) <= max_bins:
        return (distinct[:-1] + distinct[1:]) / 2
    return np.unique(np.quantile(values, np.arange(1, max_bins) / max_bins))


def shrunk(gradient, l1: float):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def best_split(bins: np.ndarray, gradient: np.ndarray, width: int, l1: float, l2: float):
    """(feature, bin) of the largest gain over gradient and curvature histograms, None where no split gains.

    The curvature of the squared error is one per row, so it is a count. Gains that differ only by rounding are ties,
    and ties go to the first feature and bin: two features that split the rows alike must not be told apart by chance.
    """
    features = bins.shape[1]
    at = (bins + np.arange(features) * width).ravel()
    sums = np.bincount(at, np.repeat(gradient, features), features * width).reshape(features, width)
    counts = np.bincount(at, minlength=features * width).reshape(features, width)
    left_sum, left_count = sums.cumsum(1)[:, :-1], counts.cumsum(1)[:, :-1]
    total, n = gradient.sum(), len(gradient)

    def score(g, h):
        return shrunk(g, l1) ** 2 / (h + l2)

    with np.errstate(divide="ignore", invalid="ignore"):  # empty sides, taken out below
        gain = score(left_sum, left_count) + score(total - left_sum, n - left_count) - score(total, n)
    gain[(left_count == 0) | (left_count == n)] = -np.inf
    if not gain.size or gain.max() <= MIN_GAIN:
        return None
    return np.unravel_index((gain >= gain.max() * (1 - TIE)).argmax(), gain.shape)


def fit(x: np.ndarray, y: np.ndarray, trees: int, depth: int, step: float, l1: float, l2: float, max_bins: int = 256):
    """Mean of the target and the leaves of all trees, each (value, {feature: (low, high, share)}).

    ``share`` is the part of the rows that a path keeps at its splits on this feature, as attribution needs it.
    """
    cuts = [cut_points(x[:, f], max_bins) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)])
    width = max(len(c) for c in cuts) + 1
    base = y.mean()
    prediction = np.full(len(y), base)
    leaves = []

    def grow(rows: np.ndarray, levels: int, box: dict) -> None:
        split = best_split(bins[rows], gradient[rows], width, l1, l2) if levels else None
        if split is None:
            value = -step * shrunk(gradient[rows].sum(), l1) / (len(rows) + l2)
            prediction[rows] += value
            leaves.append((float(value), box))
            return
        feature, border = int(split[0]), float(cuts[split[0]][split[1]])
        left = bins[rows, feature] <= split[1]
        low, high, share = box.get(feature, (-np.inf, np.inf, 1.0))
        kept = float(left.mean())
        grow(rows[left], levels - 1, {**box, feature: (low, border, share * kept)})
        grow(rows[~left], levels - 1, {**box, feature: (border, high, share * (1 - kept))})

    for _ in range(trees):
        gradient = prediction - y
        grow(np.arange(len(y)), depth, {})
    return float(base), leaves


def fitter(features, target: str, order: str, **settings):
    """The grouped-map function: all rows of a series -> one row (terminal_id, base, leaves)."""

    def fit_series(key, rows):
        # a fixed order of the rows fixes the last bits of the sums, whatever order the shuffle gave
        rows = rows.sort_values([order, target, *features])
        base, leaves = fit(rows[list(features)].to_numpy(float), rows[target].to_numpy(float), **settings)
        packed = [
            {"value": value, "box": [{"feature": f, "low": a, "high": b, "share": s} for f, (a, b, s) in box.items()]}
            for value, box in leaves
        ]
        return pd.DataFrame({"terminal_id": [key[0]], "base": [base], "leaves": [packed]})

    return fit_series
