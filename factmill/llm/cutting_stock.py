"""Cutting-stock patterns for packing: a linear program by column generation over a length histogram."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_EPS = 1e-9


def _price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the greatest value within ``capacity`` and how many of each item."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = sizes <= c
        best[c] = best[c - 1]
        if fits.any():
            total = np.where(fits, values + best[np.maximum(c - sizes, 0)], -1.0)
            i = int(total.argmax())
            if total[i] > best[c] + _EPS:
                best[c], taken[c] = total[i], i
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= sizes[taken[c]]
    return float(best[capacity]), pattern


def solve_patterns(sizes: Sequence[int], demand: Sequence[int], capacity: int, rounds: int = 4000) -> list[tuple[list[int], int]]:
    """Patterns (how many of each size) and how often to use each, so that every demand is met exactly.

    The linear program's columns are priced by the knapsack on its duals; its solution is rounded down and what is
    left, fewer items than there are sizes times one pattern, is placed largest first. The work depends on the number
    of sizes, never on the number of items.
    """
    sizes, demand = np.asarray(sizes, np.int64), np.asarray(demand, np.int64)
    m = len(sizes)
    if not m:
        return []
    if (sizes > capacity).any() or (sizes < 1).any():
        raise ValueError("sizes must lie within 1 and the capacity")
    basis = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = (inverse * demand).sum(axis=1)
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        value, column = _price(duals, sizes, capacity)
        if value <= 1 + 1e-7:
            break
        direction = (inverse * column).sum(axis=1)  # small sums: no threaded linear algebra beside the JVM
        candidates = np.flatnonzero(direction > 1e-9)
        leaving = candidates[(x[candidates] / direction[candidates]).argmin()]
        basis[:, leaving] = column
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - direction[:, None] * row
        inverse[leaving] = row
        x = np.maximum((inverse * demand).sum(axis=1), 0)
    plan: list[tuple[list[int], int]] = []
    left = demand.copy()
    for k in np.argsort(-x):
        column = basis[:, k]
        used = column > 0
        times = int(min(np.floor(x[k] + 1e-6), (left[used] // column[used]).min()))
        if times > 0:
            plan.append((column.tolist(), times))
            left -= times * column
    order = np.argsort(-sizes)
    while left.any():
        pattern, room = np.zeros(m, np.int64), capacity
        for i in order:
            n = min(int(left[i]), room // int(sizes[i]))
            pattern[i], room = n, room - n * int(sizes[i])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((pattern.tolist(), times))
        left -= times * pattern
    return plan
