"""The k nearest stations of many targets at once, in NumPy. Targets are halved until few are left; each part keeps the stations that its box can need
(see operators/neighbours)."""

from __future__ import annotations

import numpy as np

SLACK = 1e-9
#: A part of so many targets, or of as many stations as k by FEW, is not halved again; it is ranked by so many pairs at a time.
LEAF = 64
FEW = 2
PAIRS = 100_000


def reached(lat: np.ndarray, lon: np.ndarray, slat: np.ndarray, slon: np.ndarray, k: int) -> np.ndarray:
    """Which stations the box around the targets can need: those that one of its corners reaches within the farthest of k pivots."""
    y0, y1, x0, x1 = lat.min(), lat.max(), lon.min(), lon.max()
    pivots = np.argpartition(np.hypot(slat - (y0 + y1) / 2, slon - (x0 + x1) / 2), k - 1)[:k]
    kept = np.zeros(len(slat), bool)
    for y in {y0, y1}:
        dy = slat - y
        for x in {x0, x1}:
            d = np.hypot(dy, slon - x)
            kept |= d <= d[pivots].max() + SLACK
    return np.flatnonzero(kept)


def nearest_rows(lat: np.ndarray, lon: np.ndarray, slat: np.ndarray, slon: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each target its min(k, all) nearest stations by (distance in degrees, place in the arrays), and their distances: two arrays of a row a target."""
    k = min(k, len(slat))
    chosen, far = np.empty((len(lat), k), np.int64), np.empty((len(lat), k))
    parts = [(np.arange(len(lat)), np.arange(len(slat)))] if k and len(lat) else []
    while parts:
        rows, near = parts.pop()
        y, x = lat[rows], lon[rows]
        if len(near) > k:
            near = near[reached(y, x, slat[near], slon[near], k)]
        if len(rows) > LEAF and len(near) > FEW * k:
            axis = y if np.ptp(y) >= np.ptp(x) else x
            order = np.argpartition(axis, len(rows) // 2)
            parts += [(rows[order[: len(rows) // 2]], near), (rows[order[len(rows) // 2 :]], near)]
            continue
        step = max(1, PAIRS // len(near))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            dy, dx = lat[some, None] - slat[near], lon[some, None] - slon[near]
            d = np.sqrt(dy * dy + dx * dx)
            first = np.argsort(d, axis=1, kind="stable")[:, :k]
            chosen[some], far[some] = near[first], np.take_along_axis(d, first, axis=1)
    return chosen, far
