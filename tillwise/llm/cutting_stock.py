"""The cutting-stock problem by column generation, over a histogram of a few hundred lengths."""

from __future__ import annotations

import numpy as np

_EPS = 1e-9


def _dearest(prices: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest price that fits (unbounded knapsack by dynamic programming)."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(weights, kind="stable")
    w, p = weights[order], prices[order]
    for room in range(1, capacity + 1):
        fits = np.searchsorted(w, room, side="right")
        value[room], choice[room] = value[room - 1], -1
        if fits:
            sums = value[room - w[:fits]] + p[:fits]
            best = int(np.argmax(sums))
            if sums[best] > value[room] + _EPS:
                value[room], choice[room] = sums[best], best
    pattern = np.zeros(len(weights), dtype=np.int64)
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[order[choice[room]]] += 1
            room -= w[choice[room]]
    return float(value[capacity]), pattern


def solve(weights: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-3,
          rounds: int = 5_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a row) and how often the linear program uses each.

    The master program is kept as the inverse of its basis; a column enters when its price at the
    duals is over 1. All demands are met exactly. It ends when no column does, or when the sum of uses is
    within ``gap`` of Farley's lower bound (the sum over the dearest column's price); ``rounds`` bounds
    the work, as the patterns in hand are feasible at any time.
    """
    m = len(weights)
    per = np.maximum(capacity // weights, 1)
    columns = np.diag(per).astype(np.float64)
    inverse = np.diag(1.0 / per)
    x = demand / per
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        price, pattern = _dearest(np.maximum(duals, 0), weights, capacity)
        if price <= 1 + max(gap, 1e-7):
            break
        turn = inverse @ pattern
        grows = turn > _EPS
        ratios = np.full(m, np.inf)
        ratios[grows] = x[grows] / turn[grows]
        leave = int(np.argmin(ratios))
        step = ratios[leave]
        x = np.maximum(x - step * turn, 0)
        x[leave] = step
        columns[:, leave] = pattern
        row = inverse[leave] / turn[leave]
        inverse -= np.outer(turn, row)
        inverse[leave] = row
    return np.rint(columns.T).astype(np.int64), x


def plan(weights: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole numbers of uses that together hold every item exactly once.

    Fractions are cut off; what is left (fewer items than patterns times slots) is placed longest first into
    the first sequence with room.
    """
    if not len(weights):
        return []
    patterns, uses = solve(weights, demand.astype(np.float64), capacity)
    left = demand.astype(np.int64).copy()
    out: list[tuple[np.ndarray, int]] = []
    for pattern, use in zip(patterns, np.floor(uses + 1e-6).astype(np.int64), strict=True):
        held = pattern > 0
        use = int(min(use, (left[held] // pattern[held]).min(initial=use))) if held.any() else 0
        if use > 0:
            out.append((pattern, use))
            left -= pattern * use
    room: list[int] = []
    fill: list[np.ndarray] = []
    for k in np.argsort(-weights, kind="stable"):
        for _ in range(int(left[k])):
            for b, free in enumerate(room):
                if free >= weights[k]:
                    break
            else:
                b = len(room)
                room.append(capacity)
                fill.append(np.zeros(len(weights), dtype=np.int64))
            room[b] -= int(weights[k])
            fill[b][k] += 1
    return out + [(pattern, 1) for pattern in fill]
