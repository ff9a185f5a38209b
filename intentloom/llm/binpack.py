"""Bin packing of a histogram of lengths, by best fit and by bin completion.

Items of one length are alike, so a packing is a list of fillings, each with how often
it is used. Its size depends on the number of lengths and not on the number of items.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

#: length -> how many of it
Filling = dict[int, int]
Packing = list[tuple[Filling, int]]
#: Sets that a node looks at before it orders the fillings found among them by waste.
LOOK_AHEAD = 64


def bins(packing: Packing) -> int:
    return sum(times for _, times in packing)


def best_fit(counts: Filling, capacity: int) -> Packing:
    """Best fit of falling lengths: each item goes to the fullest bin that it fits.

    Bins that are filled alike are handled together. As a bin that just took an item is
    the fullest one for the next of that length, it takes as many as it can.
    """
    open_bins: dict[int, list[tuple[Filling, int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(filling: Filling, times: int, room: int) -> None:
        if times:
            if not open_bins[room]:
                bisect.insort(rooms, room)
            open_bins[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                filling, times, room = {}, left, capacity
            else:
                room = rooms[at]
                filling, times = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
            each = room // length
            full = min(times, left // each)
            put(filling | {length: each}, full, room - each * length)
            left -= full * each
            times -= full
            if left and times:  # fewer are left than one more bin would take
                put(filling | {length: left}, 1, room - left * length)
                left, times = 0, times - 1
            if filling:  # of the empty bins only the used ones count
                put(filling, times, room)
    return [found for same in open_bins.values() for found in same]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs. counts: by length, 0 to capacity.

    For every size k: items over capacity - k stand alone; those over half need a bin
    each, whose room the items from k to one half may use.
    """
    sizes = np.arange(capacity + 1)
    items = np.concatenate([[0], np.cumsum(counts)])
    filled = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    k = np.arange(half + 1)
    large, total = items[-1] - items[half + 1], filled[-1]
    alone = items[-1] - items[capacity - k + 1]
    room = (large - alone) * capacity - (filled[capacity - k + 1] - filled[half + 1])
    small = filled[half + 1] - filled[k]
    bound = large + np.maximum(0, -((room - small) // capacity))
    return int(max(bound.max(), -(-total // capacity)))


def undominated(counts: np.ndarray, largest: int, capacity: int, effort: list[int]) -> Iterator[Filling | None]:
    """Fillings of one bin around an item of the largest length, greatest items first.

    A filling is dominated if an item that is left out could replace one or more smaller
    ones of it, which would then be free for other bins; None stands for such fillings.
    effort[0] falls by one for every set that is looked at; at 0 the search ends.
    """
    there = [int(x) for x in np.flatnonzero(counts)[::-1]]
    have = {x: int(counts[x]) for x in there}
    lengths = [x for x in there if x <= capacity - largest]
    present = sum(1 << x for x in there)

    def grown(at: int, filling: Filling, room: int) -> Iterator[Filling]:
        effort[0] -= 1
        if effort[0] < 0:
            return
        while at < len(lengths) and lengths[at] > room:
            at += 1
        if at == len(lengths):
            left_out = present
            for length, n in filling.items():
                if n == have[length]:
                    left_out ^= 1 << length
            yield None if _dominated(left_out, largest, filling, room) else filling
            return
        length = lengths[at]
        most = min(have[length] - (length == largest), room // length)
        for n in range(most, -1, -1):
            more = dict(filling)
            if n:
                more[length] = more.get(length, 0) + n
            yield from grown(at + 1, more, room - n * length)
            if effort[0] < 0:
                return

    yield from grown(0, {largest: 1}, capacity - largest)


def _dominated(left_out: int, largest: int, filling: Filling, room: int) -> bool:
    """Whether an item that is left out fits in place of nothing or of smaller items.

    left_out has a bit for every length of which an item is left out.
    """
    one, several = 0, 0  # bit s: one item, or several, of the filling are s long together
    for length, n in filling.items():
        for _ in range(n - (length == largest)):
            several |= (several << length) | (one << length)
            one |= 1 << length
    larger = _above(one | several | 1, room) if room else 0
    return bool(left_out & (larger | several))


def _above(sums: int, room: int) -> int:
    """Bits of all lengths from 1 to `room` more than one of the sums."""
    found, width = sums << 1, 1
    while width < room:
        step = min(width, room - width)
        found |= found << step
        width += step
    return found


def complete_bins(counts: Filling, capacity: int, effort: int) -> Packing:
    """The best packing that branch and bound finds, never worse than best fit.

    Bins are completed one after another around the largest item that is left, by
    undominated fillings in the order of their waste. A branch ends where its bins and
    the lower bound of the rest, that is the least waste, reach the best packing so far.
    Best fit gives the first packing, and another one from the rest of every branch.
    `effort` bounds the sets, and the lengths packed by best fit, that are looked at; a
    search that ends before it has proved its packing the smallest.
    """
    best = best_fit(counts, capacity)
    rest = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        rest[length] = n
    goal = lower_bound(rest, capacity)
    left = [effort]

    def branches() -> Iterator[tuple[Filling, int]]:
        found = undominated(rest.copy(), int(np.flatnonzero(rest)[-1]), capacity, left)
        while looked_at := [f for _, f in zip(range(LOOK_AHEAD), found)]:
            some = [f for f in looked_at if f is not None]
            some.sort(key=lambda f: capacity - sum(x * n for x, n in f.items()))
            for filling in some:
                most = min(int(rest[x]) // n for x, n in filling.items())
                yield filling, most
                if most > 1:
                    yield filling, 1

    def take(filling: Filling, times: int) -> None:
        for length, n in filling.items():
            rest[length] -= n * times

    path: Packing = []
    stack = [branches()] if bins(best) > goal else []
    while stack and left[0] > 0 and bins(best) > goal:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                filling, times = path.pop()
                take(filling, -times)
            continue
        take(*step)
        path.append(step)
        least = bins(path) + lower_bound(rest, capacity)
        if least < bins(best):
            others = {int(x): int(rest[x]) for x in np.flatnonzero(rest)}
            left[0] -= len(others)
            whole = path + best_fit(others, capacity)
            if bins(whole) < bins(best):
                best = whole
        if least < bins(best):
            stack.append(branches())
        else:
            path.pop()
            take(step[0], -step[1])
    return best
