"""Linear recurrences over sorted runs, computed as parallel prefixes with numpy."""

from __future__ import annotations

import numpy as np


def places(*keys: np.ndarray) -> np.ndarray:
    """The place of each row within its run of equal keys."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    begins = np.flatnonzero(new)
    return np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))


def decayed_sums(x: np.ndarray, place: np.ndarray, decay: float) -> np.ndarray:
    """y[i] = decay * y[i - 1] + x[i] within each run, which ``place`` counts from 0.

    Sums over 1, 2, 4, ... rows are doubled until a run is covered or what lies further
    back weighs nothing, so there are logarithmically many passes over the whole array.
    """
    y = x.astype(np.float64, copy=True)
    step = 1
    while step <= place.max(initial=0) and decay**step > 1e-300:
        y[step:] += np.where(place[step:] >= step, decay**step * y[:-step], 0.0)
        step *= 2
    return y


def affine_steps(a: np.ndarray, b: np.ndarray, start: float) -> np.ndarray:
    """The values before each of the maps y = a[i] * y + b[i], applied in order from ``start``."""
    a, b = a.astype(np.float64, copy=True), b.astype(np.float64, copy=True)
    step = 1
    while step < len(a):
        b[step:] = a[step:] * b[:-step] + b[step:]
        a[step:] = a[step:] * a[:-step]
        step *= 2
    return np.concatenate(([start], a[:-1] * start + b[:-1])) if len(a) else a
