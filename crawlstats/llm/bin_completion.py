"""Bin completion on a histogram of lengths.

Packing needs only how many items there are of each length, so the search
runs on at most ``capacity`` counts, whatever the number of items. A step
takes the largest length left and completes its bin: it enumerates the
undominated fillings of the rest of the bin and gives each to a number of bins
at once, first as many as the counts and the bound allow, at last every number
down to one. A branch ends when its waste is more than an improvement on the
best known solution allows. Best-fit decreasing gives the first known solution;
the search ends when a solution meets the lower bound, its tree is empty (then
the best solution is optimal) or ``max_nodes`` steps are spent, on fillings
tried or on items put together while enumerating them, and keeps the best
solution so far.

A filling is dominated by one that holds more, or that holds a longer item in
place of one of its own. Fillings of more than ``ENUMERATED_ITEMS`` items are
completed longest item first, without others of that kind.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

#: What one bin holds, as ((length, how many), ...), and the number of such bins.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs: volume, and large items that cannot share a bin.

    For each threshold a, items over capacity - a fill a bin alone, items
    over half a bin need one each, and what these leave free must take the
    items of at least a.
    """
    cap = len(counts) - 1
    size = np.arange(cap + 1)
    number, volume = np.cumsum(counts), np.cumsum(counts * size)
    best = -(-int(volume[-1]) // cap)
    half = cap // 2
    for a in range(1, half + 1):
        large = int(number[cap] - number[half])
        middle_volume = int(volume[cap - a] - volume[half])
        middle = int(number[cap - a] - number[half])
        small = int(volume[half] - volume[a - 1])
        best = max(best, large + max(0, -(-(small - (middle * cap - middle_volume)) // cap)))
    return best


def best_fit_decreasing(counts: np.ndarray) -> list[Pattern]:
    """Each length, longest first, goes to the fullest bin that still takes it; equal bins move together."""
    cap = len(counts) - 1
    open_bins: dict[int, list[list]] = defaultdict(list)  # room -> [[filling, bins], ...]
    for length in range(cap, 0, -1):
        left = int(counts[length])
        while left:
            room = min((r for r, g in open_bins.items() if r >= length and g), default=None)
            if room is None:
                each = cap // length
                whole, rest = divmod(left, each)
                if whole:
                    open_bins[cap - each * length].append([((length, each),), whole])
                if rest:
                    open_bins[cap - rest * length].append([((length, rest),), 1])
                break
            filling, bins = open_bins[room].pop()
            each = room // length
            take = min(bins, left // each)
            if take:
                open_bins[room - each * length].append([(*filling, (length, each)), take])
                left -= take * each
            if bins > take and left and left < each:
                open_bins[room - left * length].append([(*filling, (length, left)), 1])
                left, take = 0, take + 1
            if bins > take:
                open_bins[room].append([filling, bins - take])
    return [(f, n) for groups in open_bins.values() for f, n in groups]


#: Fillings are enumerated up to so many items; what fits beyond them is added longest first.
ENUMERATED_ITEMS = 40


def fill_up(counts: np.ndarray, room: int) -> tuple[int, tuple[int, ...]]:
    """One filling, longest items first, and its waste."""
    items: list[int] = []
    for x in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        take = min(int(counts[x]), room // x) if x else 0
        items += [x] * take
        room -= x * take
    return room, tuple(items)


class Steps:
    """Steps that the search may still take."""

    def __init__(self, left: int):
        self.left = left

    def take(self) -> bool:
        self.left -= 1
        return self.left >= 0


def fillings(counts: np.ndarray, room: int, steps: Steps) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of the undominated fillings of ``room``: of one and two items by increasing waste, then larger ones.

    The last item of a filling is always the longest that still fits: a
    shorter one is dominated.
    """
    there = np.flatnonzero(counts[: room + 1])
    there = there[there > 0]
    if not len(there):
        yield room, ()
        return
    longest = int(there[-1])
    if longest == room:
        yield 0, (longest,)
        return  # any other filling of the room can take the place of this item
    fit = np.zeros(room + 1, dtype=np.int64)  # fit[x]: the longest available length of at most x
    fit[there] = there
    fit = np.maximum.accumulate(fit)
    a = there[::-1]
    b = fit[np.minimum(a, room - a)]
    b = np.where((b == a) & (counts[a] < 2), fit[np.maximum(b - 1, 0)], b)
    good = b > 0
    order = np.argsort(room - a[good] - b[good], kind="stable")
    pairs = list(zip(a[good][order].tolist(), b[good][order].tolist()))
    if not dominated(counts, room - longest, (longest,)):
        yield room - longest, (longest,)
    for x, y in pairs:
        if not steps.take():
            return
        if not dominated(counts, room - x - y, (x, y)):
            yield room - x - y, (x, y)
    if pairs:
        yield from larger(there.tolist(), counts, room, steps)


def dominated(counts: np.ndarray, waste: int, filling: tuple[int, ...]) -> bool:
    """Whether an item that is left fits in, or fits in the place of a shorter one."""
    left = counts[: max(filling) + waste + 1].copy()
    for x in filling:
        left[x] -= 1
    there = np.flatnonzero(left[1:] > 0) + 1
    if len(there) and there[0] <= waste:
        return True
    return any(len(there) and (i := np.searchsorted(there, x, side="right")) < len(there) and there[i] <= x + waste for x in set(filling))


def larger(there: list[int], counts: np.ndarray, room: int, steps: Steps) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of three and more items, in descending order of their items; ``there`` ascends."""
    left = {x: int(counts[x]) for x in there}

    def grow(rest: int, upto: int, chosen: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        if len(chosen) >= ENUMERATED_ITEMS:
            own = np.zeros(rest + 1, dtype=np.int64)
            for x in there[: upto + 1]:
                if x <= rest:
                    own[x] = left[x]
            waste, more = fill_up(own, rest)
            yield waste, (*chosen, *more)
            return
        for i in range(min(upto, bisect_right(there, rest) - 1), -1, -1):
            x = there[i]
            if not left[x]:
                continue
            if not steps.take():
                return
            left[x] -= 1
            chosen.append(x)
            if next((y for y in there if left[y]), room) <= rest - x:  # something still fits
                yield from grow(rest - x, i, chosen)
            elif len(chosen) > 2 and not dominated(counts, rest - x, tuple(chosen)):
                yield rest - x, tuple(chosen)
            chosen.pop()
            left[x] += 1

    yield from grow(room, len(there) - 1, [])


def solve(counts: np.ndarray, max_nodes: int = 200_000) -> list[Pattern]:
    """Patterns that hold every item; ``counts[l]`` items of length l, capacity ``len(counts) - 1``."""
    counts = np.asarray(counts, dtype=np.int64)
    cap, total = len(counts) - 1, int((counts * np.arange(len(counts))).sum())
    if not total:
        return []
    best = best_fit_decreasing(counts)
    best_bins, bound = sum(n for _, n in best), lower_bound(counts)
    left, path, waste, steps = counts.copy(), [], 0, Steps(max_nodes)
    todo: list[Iterator] = []  # the fillings still to try, for each step of the path

    def largest() -> int:
        there = np.flatnonzero(left)
        return int(there[-1]) if len(there) and there[-1] else 0

    def room_for(w: int, most: int) -> int:
        """Bins that a filling of this waste may get."""
        return min(most, ((best_bins - 1) * cap - total - waste) // w) if w else most

    def choices() -> Iterator[tuple[int, tuple, int]]:
        """(waste, filling, bins): every filling for as many bins as it may get, then for fewer."""
        top = largest()
        rest = left.copy()
        rest[top] -= 1
        for fewer in (False, True):
            for w, more in fillings(rest, cap - top, steps):
                lengths = (top, *more)
                filling = tuple(sorted(((x, lengths.count(x)) for x in set(lengths)), reverse=True))
                most = room_for(w, min(int(left[x]) // k for x, k in filling))
                for n in range(most - 1, 0, -1) if fewer else (max(most, 0),):
                    yield w, filling, n if n <= room_for(w, n) else 0

    todo.append(choices())
    while todo and best_bins > bound and steps.take():
        if len(path) == len(todo):  # take back what was tried before at this step
            filling, n, w = path.pop()
            for length, k in filling:
                left[length] += k * n
            waste -= w * n
        step = next(todo[-1], None)
        if step is None:
            todo.pop()
            continue
        w, filling, n = step
        if not n:  # it wastes more than is left for an improvement
            path.append((filling, 0, 0))
            continue
        for length, k in filling:
            left[length] -= k * n
        waste += w * n
        path.append((filling, n, w))
        if largest():
            todo.append(choices())
        else:
            bins = sum(n for _, n, _ in path)
            if bins < best_bins:
                best, best_bins = [(f, n) for f, n, _ in path if n], bins
    return best
