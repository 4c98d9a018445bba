"""The small linear solve of the per-terminal ridge model; runs inside tasks, one terminal per row."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def solve_batch(
    n: pd.Series, gram: pd.Series, cross: pd.Series, means: pd.Series, target_mean: pd.Series, alpha: pd.Series
) -> pd.DataFrame:
    """Centred second moments of each terminal -> coefficients and intercept."""
    coefficients, intercepts = [], []
    for count, g, c, m, t, a in zip(n, gram, cross, means, target_mean, alpha):
        center = np.asarray(m, dtype=float)
        k = len(center)
        upper = np.zeros((k, k))
        upper[np.triu_indices(k)] = g
        matrix = (upper + np.triu(upper, 1).T) * count + a * np.eye(k)
        coefficient = np.linalg.solve(matrix, np.asarray(c, dtype=float) * count)
        coefficients.append(coefficient.tolist())
        intercepts.append(float(t - center @ coefficient))
    return pd.DataFrame({"coefficients": coefficients, "intercept": intercepts})
