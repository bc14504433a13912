"""A monotone map from raw scores to probabilities."""

from __future__ import annotations

import numpy as np


def monotone(raw: np.ndarray, labels: np.ndarray, rate: float, least: int = 8):
    """(knots, values): pooled non-decreasing means over runs of the raw score.

    Every run is smoothed by two rows at the overall ``rate``. For ``np.interp``.
    """
    order = np.argsort(raw, kind="stable")
    if not len(order):
        return np.array([0.0, 1.0]), np.array([rate, rate])
    blocks = []
    for part in np.array_split(order, max(1, min(40, len(order) // least))):
        blocks.append([labels[part].sum() + 2 * rate, len(part) + 2.0, [raw[part].mean()]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, x = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + x]
    knots, values = [], []
    for s, n, xs in blocks:
        for x in (xs[0], xs[-1])[: len(xs)]:
            knots.append(x)
            values.append(s / n)
    return np.array(knots), np.array(values)
