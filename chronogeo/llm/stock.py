"""Cutting stock by column generation over a histogram of lengths.

The linear program has a row per length class and a column per pattern (how many of each class share a bin). A knapsack
by dynamic programming prices the next column; the basis inverse is updated by one pivot. Its size depends on the number
of classes alone, never on the number of pieces.
"""

from __future__ import annotations

import numpy as np

GAP = 5e-4  # stop this close to the bound
ROUNDS = 4000


def knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of sizes 1..capacity (value[i] is that of size i+1) within the capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        total = value[:room] + best[room - 1::-1][:room]
        k = int(np.argmax(total))
        best[room], choice[room] = (total[k], k) if total[k] > best[room - 1] else (best[room - 1], -1)
    counts, room = np.zeros(capacity, np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= choice[room] + 1
    return float(best[capacity]), counts


def patterns(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (rows over all sizes) and how often each is used, a fraction, for demand[i] pieces of size i+1."""
    capacity = len(demand)
    sizes = np.flatnonzero(demand)
    m = len(sizes)
    fit = capacity // (sizes + 1)
    basis = np.diag(fit.astype(float))  # column j is pattern j
    inverse, need = np.diag(1.0 / fit), demand[sizes].astype(float)
    cost = np.ones(m)  # 0 for a surplus column
    for _ in range(ROUNDS):
        dual = cost @ inverse
        amount = inverse @ need
        j = int(np.argmin(dual))
        if dual[j] < -1e-9:
            column, price = -np.eye(m)[j], 0.0
        else:
            value = np.zeros(capacity)
            value[sizes] = np.maximum(dual, 0)
            worth, counts = knapsack(value, capacity)
            if worth <= 1 + GAP:
                break
            column, price = counts[sizes].astype(float), 1.0
        step = inverse @ column
        ok = step > 1e-10
        if not ok.any():
            break
        ratio = np.full(m, np.inf)
        ratio[ok] = np.maximum(amount[ok], 0) / step[ok]
        r = int(np.argmin(ratio))
        inverse[r] /= step[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(step[others], inverse[r])
        basis[:, r], cost[r] = column, price
    amount = np.maximum(inverse @ need, 0)
    used = cost > 0
    full = np.zeros((int(used.sum()), capacity), np.int64)
    full[:, sizes] = np.rint(basis[:, used]).T.astype(np.int64)
    return full, amount[used]


def plan(demand: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """(how often, {size: pieces}) that together hold all pieces: demand[i] of size i+1, bins of size len(demand).

    Patterns are used as often as their share rounded down; what is left, a few bins per pattern at most, is filled
    largest piece first into the fullest bin that still has room.
    """
    left = demand.astype(np.int64).copy()
    out: list[tuple[int, dict[int, int]]] = []
    if not left.any():
        return out
    shapes, amount = patterns(left)
    for shape, x in sorted(zip(shapes.tolist(), amount.tolist()), key=lambda p: -p[1]):
        shape = np.array(shape)
        own = np.flatnonzero(shape)
        times = int(min(np.floor(x + 1e-6), *(left[own] // shape[own]))) if len(own) else 0
        if times > 0:
            left[own] -= times * shape[own]
            out.append((times, {int(i) + 1: int(shape[i]) for i in own}))
    room_of: dict[int, list[dict[int, int]]] = {}
    for i in np.flatnonzero(left)[::-1].tolist():
        for _ in range(int(left[i])):
            room = min((r for r, bins in room_of.items() if r >= i + 1 and bins), default=None)
            bin_ = room_of[room].pop() if room is not None else {}
            bin_[i + 1] = bin_.get(i + 1, 0) + 1
            room_of.setdefault((room if room is not None else len(demand)) - i - 1, []).append(bin_)
    return out + [(1, b) for bins in room_of.values() for b in bins]
