"""Local quadratic regression, interpolated between the vertices of a k-d tree (Cleveland and Grosse, 1991)."""

from __future__ import annotations

import math

import numpy as np


def _vertices(x: np.ndarray, most: int) -> np.ndarray:
    """Cell boundaries: cells of more than `most` points are cut at their median, ties all going up."""
    margin = 0.005 * max(x[-1] - x[0], 1e-10 * max(abs(x[0]), abs(x[-1])) + 1e-30)
    cells = [(0, len(x) - 1, x[0] - margin, x[-1] + margin)]
    found = {cells[0][2], cells[0][3]}
    while cells:
        first, last, low, high = cells.pop()
        if last - first + 1 <= most or first > last:
            continue
        cut = middle = (first + last + 2) // 2 - 1
        for step in (s for k in range(last - first + 1) for s in ((k, -k) if k else (0,))):
            at = middle + step
            if at >= last or at < first:
                break
            if x[at] != x[at + 1]:
                cut = at
                break
        if x[cut] in (low, high):
            continue
        found.add(x[cut])
        cells += [(first, cut, low, x[cut]), (cut + 1, last, x[cut], high)]
    return np.array(sorted(found))


def _local_fit(q: float, x: np.ndarray, y: np.ndarray, neighbours: int) -> tuple[float, float]:
    """Value and slope at q of a tricube-weighted quadratic over the nearest points."""
    distance = np.abs(x - q)
    near = np.argsort(distance, kind="stable")[:neighbours]
    radius = distance[near[-1]]
    if radius <= 0:
        raise ValueError(f"all {neighbours} nearest points lie at {q}")
    weight = np.sqrt((1 - (distance[near] / radius) ** 3).clip(0) ** 3)
    dx = x[near] - q
    design = weight[:, None] * np.stack([np.ones_like(dx), dx, dx * dx], axis=1)
    norm = np.sqrt((design**2).sum(axis=0))
    norm[norm == 0] = 1
    coefficients = np.linalg.lstsq(design / norm, weight * y[near], rcond=100 * np.finfo(float).eps)[0] / norm
    return coefficients[0], coefficients[1]


def loess_fit(x, y, span: float = 0.75, cell: float = 0.2) -> np.ndarray:
    """Fitted values at x, in the order of x. Needs at least three points among the span's nearest."""
    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    n = len(x)
    neighbours, most = min(n, math.floor(n * span)), math.floor(n * cell * span)
    if neighbours < 3:
        raise ValueError(f"{neighbours} points cannot determine a quadratic")
    v = _vertices(np.sort(x), most)
    value, slope = np.array([_local_fit(q, x, y, neighbours) for q in v]).T
    right = np.searchsorted(v, x, side="left").clip(1, len(v) - 1)
    left = right - 1
    width = v[right] - v[left]
    h = (x - v[left]) / width
    return (
        (1 - h) ** 2 * (1 + 2 * h) * value[left]
        + h**2 * (3 - 2 * h) * value[right]
        + (h * (1 - h) ** 2 * slope[left] + h**2 * (h - 1) * slope[right]) * width
    )
