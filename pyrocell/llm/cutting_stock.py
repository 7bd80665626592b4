"""The cutting-stock problem over a histogram of lengths: linear program by column generation, then rounding."""

from __future__ import annotations

import math

import numpy as np

#: Patterns that one round of prices gives.
PRICED = 24
#: How far above its lower bound a plan may stay, as a share of all sequences (and half a sequence at least).
GAP = 5e-4


def greedy(demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """First fit by decreasing size on the histogram: (pattern as size -> count, how often). Meets demand exactly."""
    left, out = demand.astype(np.int64).copy(), []
    while True:
        pattern, room = {}, capacity
        for size in np.flatnonzero(left)[::-1].tolist():
            if size > room:
                continue
            pattern[size] = min(int(left[size]), room // size)
            room -= pattern[size] * size
        if not pattern:
            return out
        times = min(int(left[s]) // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[s] -= times * n
        out.append((pattern, times))


def price(value: np.ndarray, capacity: int) -> tuple[float, list[dict[int, int]]]:
    """The greatest worth of a pattern, and some of the patterns that are worth most, the best last: an unbounded knapsack
    by dynamic programming over the room used, whose table also has the best pattern with any one size in it."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    reverse = value[::-1]
    n = len(value)  # value[s] for s in 0..n-1, value[0] = 0
    for room in range(1, capacity + 1):
        m = min(room, n - 1)
        options = best[room - m : room] + reverse[n - 1 - m : n - 1]  # sizes m..1
        k = int(options.argmax())
        if options[k] > best[room - 1]:
            best[room], pick[room] = options[k], m - k
        else:
            best[room] = best[room - 1]

    def pattern(first: int) -> dict[int, int]:
        out, room = {first: 1}, capacity - first
        while room > 0:
            size = int(pick[room])
            if size:
                out[size] = out.get(size, 0) + 1
            room -= size or 1
        return out

    sizes = np.flatnonzero(value)
    worth = value[sizes] + best[capacity - sizes]
    found = {tuple(sorted(p.items())): p for p in (pattern(int(sizes[k])) for k in np.argsort(-worth, kind="stable")[:PRICED])}
    return float(best[capacity]), list(found.values())[::-1]


def least_sequences(demand: np.ndarray, capacity: int) -> int:
    """What no packing can do better than: all lengths together over the capacity, rounded up."""
    return -(-int((np.arange(len(demand)) * demand).sum()) // capacity)


def relaxed(demand: np.ndarray, capacity: int, gap: float = 0.5) -> list[tuple[dict[int, int], float]]:
    """Patterns and fractional amounts that meet demand with the fewest sequences.

    Revised simplex with an explicit inverse. The greedy solution's patterns may enter first; then the knapsack prices
    new ones by the duals, several a round. It ends when the objective is within
    ``gap`` sequences of a lower bound (Farley's: a price list's worth over its best pattern's; or all lengths over the
    capacity), or both are the same rounded up, for then no whole packing can be better, or when no pattern helps. Demand is changed by less than a
    millionth of a piece, so that no step has length zero and the simplex can't go in circles.
    """
    sizes = np.flatnonzero(demand)
    if not len(sizes):
        return []
    m, row = len(sizes), {int(s): k for k, s in enumerate(sizes)}
    wanted = demand[sizes] + np.random.default_rng(1).uniform(1e-7, 5e-7, m) / m
    patterns = [{int(s): capacity // int(s)} for s in sizes]
    inverse = np.diag([1.0 / (capacity // int(s)) for s in sizes])
    amount = inverse @ wanted
    ready = [p for p, _ in greedy(demand, capacity)]
    value = np.zeros(int(sizes[-1]) + 1)
    best = float(least_sequences(demand, capacity))

    def column(pattern):
        c = np.zeros(m)
        for s, n in pattern.items():
            c[row[s]] = n
        return c

    while True:
        duals = inverse.sum(axis=0)
        enter = None
        while ready and enter is None:
            p = ready.pop()
            enter = p if sum(duals[row[s]] * n for s, n in p.items()) > 1 + 1e-9 else None
        total = float(amount.sum())
        if enter is None and (total - best < gap or math.ceil(total - 1e-6) <= math.ceil(best - 1e-6)):
            break
        if enter is None:
            value[sizes] = np.maximum(duals, 0)
            worth, ready = price(value, capacity)
            best = max(best, float(value[sizes] @ demand[sizes]) / max(1.0, worth))
            if worth <= 1 + 1e-9:
                break
            enter = ready.pop()
        step = inverse @ column(enter)
        up = np.flatnonzero(step > 1e-9)
        out = up[np.argmin(amount[up] / step[up])]
        by = max(0.0, amount[out] / step[out])
        amount -= by * step
        amount[out] = by
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        patterns[out] = enter
    return [(p, float(x)) for p, x in zip(patterns, amount, strict=True) if x > 0]


def plan(demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns that use every piece exactly once; ``demand[s]`` pieces have size s; sizes are 1..capacity.

    The relaxation is rounded down, and what is left is a smaller problem of the same kind, relaxed anew, until nothing
    is a whole pattern any more; the last few pieces, some for each size at most, go by decreasing size.
    """
    left, out = demand.astype(np.int64).copy(), []
    gap = max(0.5, GAP * least_sequences(demand, capacity))
    while left.any():
        before = int(left.sum())
        for pattern, amount in relaxed(left, capacity, gap):
            times = min([int(amount + 1e-6), *(int(left[s]) // n for s, n in pattern.items())])
            if times > 0:
                out.append((pattern, times))
                for s, n in pattern.items():
                    left[s] -= times * n
        if int(left.sum()) == before:
            break
    out += greedy(left, capacity)
    whole = greedy(demand, capacity)  # a plan in hand: kept where rounding costs more than the program wins
    return out if sum(n for _, n in out) <= sum(n for _, n in whole) else whole
