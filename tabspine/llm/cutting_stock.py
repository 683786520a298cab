"""Which lengths to put together in a sequence: cutting stock by column generation.

Works on a histogram of lengths, never on documents. A column is a pattern of lengths that fit one sequence. A linear
program over columns says how often each is used; its prices go to a knapsack over the capacity, which finds columns that
would lower the number of sequences. Rounded down, the program covers nearly all pieces; the rest, fewer than the number of
patterns, is filled sequence by sequence to the fullest sum that can be reached.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

Pattern = dict[int, int]


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity when lengths may repeat; the length taken last (0: none), and up to which sum."""
    worth = np.full(capacity + 1, -1.0)
    worth[lengths] = prices
    best, last = np.zeros(capacity + 1), np.zeros((capacity + 1, 2), np.int64)
    for c in range(1, capacity + 1):
        values = best[c - 1 :: -1][:c] + worth[1 : c + 1]
        taken = int(values.argmax())
        if values[taken] > best[c - 1]:
            best[c], last[c] = values[taken], (taken + 1, c)
        else:
            best[c], last[c] = best[c - 1], last[c - 1]
    return best, last


def _pattern(last: np.ndarray, capacity: int) -> Pattern:
    found: Counter = Counter()
    while last[capacity, 0]:
        length, capacity = map(int, last[capacity])
        found[length] += 1
        capacity -= length
    return dict(found)


def fractional(demand: Pattern, capacity: int, gap: float, pivots: int) -> list[tuple[Pattern, float]]:
    """Patterns and how often each is used, within ``gap`` of the program's least sum or after ``pivots`` exchanges."""
    lengths = np.array(sorted(demand))
    at = {int(length): i for i, length in enumerate(lengths)}
    wanted = np.array([demand[int(length)] for length in lengths], float)
    # First columns: a length with its complement, and the more frequent of the two by itself. Their inverse is plain.
    columns: list[Pattern] = [{}] * len(lengths)
    inverse = np.zeros((len(lengths), len(lengths)))
    for length, i in at.items():
        other = capacity - length
        if other in at and other != length and (wanted[i], length) < (wanted[at[other]], other):
            columns[i] = {length: 1, other: 1}
            inverse[i, i], inverse[at[other], i] = 1, -1 / (capacity // other)
        else:
            columns[i] = {length: capacity // length}
            inverse[i, i] = 1 / (capacity // length)
    used = (inverse * wanted).sum(axis=1)
    done = 0
    while done < pivots:
        prices = inverse.sum(axis=0)
        best, last = _knapsack(lengths, prices, capacity)
        if best[capacity] <= 1 + 1e-9 or used.sum() - (wanted * prices).sum() / best[capacity] <= gap * used.sum():
            break
        gain = prices + best[capacity - lengths]
        before = done
        for i in np.argsort(-gain)[:48]:
            column = _pattern(last, capacity - int(lengths[i]))
            column[int(lengths[i])] = column.get(int(lengths[i]), 0) + 1
            rows, counts = [at[x] for x in column], np.array(list(column.values()), float)
            if (inverse[:, rows].sum(axis=0) * counts).sum() <= 1 + 1e-9:
                continue
            step = (inverse[:, rows] * counts).sum(axis=1)
            open_rows = np.flatnonzero(step > 1e-9)
            out = open_rows[np.argmin(used[open_rows] / step[open_rows])]
            amount = max(used[out] / step[out], 0.0)
            used -= amount * step
            used[out] = amount
            inverse[out] /= step[out]
            step[out] = 0
            inverse -= np.outer(step, inverse[out])
            columns[out] = column
            done += 1
        if done == before:
            break
    return [(c, float(x)) for c, x in zip(columns, used) if x > 1e-9]


def _fullest(rest: Counter, capacity: int) -> Pattern:
    """The longest length left, with those that bring the sum nearest to the capacity."""
    first = max(rest)
    taken, room = {first: 1}, capacity - first
    steps, sums = [], 1
    for length in sorted((x for x in rest if x <= room), reverse=True):
        for _ in range(min(rest[length] - (length == first), room // length)):
            steps.append((length, sums))
            sums |= (sums << length) & ((1 << (room + 1)) - 1)
        if sums >> room & 1:
            break
    total = sums.bit_length() - 1
    for length, before in reversed(steps):
        if total and not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def plan(demand: Pattern, capacity: int, gap: float = 0.001, pivots: int = 1500) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences each makes; together they hold every piece exactly once."""
    rest = Counter({length: n for length, n in demand.items() if n})
    planned: list[tuple[Pattern, int]] = []
    if rest:
        for pattern, times in sorted(fractional(dict(rest), capacity, gap, pivots), key=lambda p: -p[1]):
            times = min([int(times), *(rest[length] // n for length, n in pattern.items())])
            if times:
                planned.append((pattern, times))
                rest -= Counter({length: n * times for length, n in pattern.items()})
    while rest:
        pattern = _fullest(rest, capacity)
        times = min(rest[length] // n for length, n in pattern.items())
        planned.append((pattern, times))
        rest -= Counter({length: n * times for length, n in pattern.items()})
    return planned
