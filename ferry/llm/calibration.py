"""Isotonic calibration of raw scores from binned sums (bounded: at most ``BINS`` bins)."""

from __future__ import annotations

import numpy as np

BINS = 2048
LOW, HIGH = -0.5, 1.5


def bin_of(raw: np.ndarray) -> np.ndarray:
    at = (np.clip(raw, LOW, HIGH) - LOW) / (HIGH - LOW) * BINS
    return np.minimum(at.astype(np.int64), BINS - 1)


def isotonic(bins: np.ndarray, rows: np.ndarray, hits: np.ndarray,
             base: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw, probability) of the least-squares increasing fit, pooling adjacent violators.

    No rows give the constant 0.5. With a ``base`` rate, every pooled block counts one more row of that
    rate, so that a block of three or four rows is no proof.
    """
    if not len(bins):
        return np.array([LOW]), np.array([0.5])
    blocks: list[list[float]] = []  # rows, hits, sum of raw
    for b in np.argsort(bins):
        raw = LOW + (bins[b] + 0.5) / BINS * (HIGH - LOW)
        blocks.append([rows[b], hits[b], rows[b] * raw])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    table = np.array(blocks)
    fit = table[:, 1] / table[:, 0]
    if base is not None:
        fit = np.maximum.accumulate((table[:, 1] + base) / (table[:, 0] + 1))
    return table[:, 2] / table[:, 0], fit


def calibrated(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Linear between block centres, constant beyond them."""
    return np.clip(np.interp(raw, *knots), 0.0, 1.0)
