"""Bin completion over a histogram of sizes: which sizes share a bin, and how often."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

Filling = tuple[int, ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The least number of bins by volume, and by items that leave no room for one another."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for small in sorted({s for s in counts if 2 * s <= capacity} | {0}):
        wide = sum(n for s, n in counts.items() if s > capacity - small)
        half = [(s, n) for s, n in counts.items() if 2 * s > capacity and s <= capacity - small]
        room = sum(n * (capacity - s) for s, n in half)
        rest = sum(s * n for s, n in counts.items() if small <= s and 2 * s <= capacity)
        best = max(best, wide + sum(n for _, n in half) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing with equal bins handled together; the first incumbent."""
    open_bins: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append((filling, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                full, over = divmod(left, each)
                if full:
                    put(capacity - each * size, (size,) * each, full)
                if over:
                    put(capacity - over * size, (size,) * over, 1)
                break
            room = rooms[at]
            filling, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            used = min(n, left)
            put(room - size, (*filling, size), used)
            if n > used:
                put(room, filling, n - used)
            left -= used
    return [x for group in open_bins.values() for x in group]


def dominates(a: Filling, b: Filling) -> bool:
    """Whether the items of ``b`` fit into the items of ``a`` as into bins: then ``a`` is never worse."""
    if sum(a) < sum(b):
        return False

    def fits(rooms: tuple[int, ...], items: Filling) -> bool:
        if not items:
            return True
        return any(
            fits((*rooms[:k], room - items[0], *rooms[k + 1 :]), items[1:])
            for k, room in enumerate(rooms) if room >= items[0] and room not in rooms[:k]
        )

    return len(b) <= 8 and fits(a, b)


def fillings(sizes: list[int], counts: dict[int, int], room: int, waste: int, want: int, nodes: int) -> list[Filling]:
    """Undominated ways to fill ``room`` with at most ``waste`` left over, the least waste first.

    ``sizes`` ascending. Items come in descending order, and a branch ends when what is left could
    not bring the waste below the best known. The first descent always ends in a filling.
    """
    found: list[Filling] = []
    best, budget = [room + 1], [nodes]

    def descend(chosen: Filling, left: int, top: int) -> None:
        budget[0] -= 1
        at = bisect_right(sizes, min(left, top)) - 1
        tried = False
        while at >= 0 and (budget[0] > 0 or not tried) and best[0] > 0:
            size = sizes[at]
            if counts[size] > chosen.count(size):
                # the rest, all at most ``size``, must be able to use up what is over the bound
                if tried and left - size * (left // size) > best[0] and size * 2 <= sizes[0]:
                    break
                tried = True
                descend((*chosen, size), left - size, size)
            at -= 1
            if left < sizes[0]:
                break
        if not tried:
            best[0] = min(best[0], left)
            found.append(chosen)

    descend((), room, room)
    found.sort(key=lambda f: (-sum(f), len(f)))
    kept: list[Filling] = []
    for f in found:
        if len(kept) == want or (kept and room - sum(f) > max(waste, room - sum(kept[0]))):
            break
        if not any(dominates(k, f) for k in kept):
            kept.append(f)
    return kept


@dataclass
class Plan:
    """Fillings with the number of bins that use each; ``bound`` is the least number any plan can have."""

    bins: list[tuple[Filling, int]]
    bound: int
    capacity: int
    count: int = field(init=False)

    def __post_init__(self):
        self.count = sum(n for _, n in self.bins)


def complete(counts: dict[int, int], capacity: int, limit: int | None, skips: tuple[int, ...], want: int, nodes: int):
    """One descent of the search: bins are filled around the largest item left, equal bins at once.

    ``skips`` names the steps that take their second-best filling. Ends without a result when the
    waste so far exceeds what ``limit`` bins allow.
    """
    left = {s: n for s, n in counts.items() if n}
    sizes = sorted(left)
    allowed = None if limit is None else limit * capacity - sum(s * n for s, n in left.items())
    bins, wasted, step = [], 0, 0
    while left:
        top = sizes[-1]
        left[top] -= 1
        slack = capacity if allowed is None else allowed - wasted
        ways = fillings(sizes, left, capacity - top, slack, want, nodes) or [()]
        left[top] += 1
        way = ways[1] if step in skips and len(ways) > 1 else ways[0]
        step += 1
        filling = (top, *way)
        times = min(left[s] // filling.count(s) for s in set(filling))
        wasted += (capacity - sum(filling)) * times
        if allowed is not None and wasted > allowed:
            return None
        bins.append((filling, times))
        for s in filling:
            left[s] -= times
        for s in set(filling):
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))
    return bins


def plan(counts: dict[int, int], capacity: int, tries: int = 6, want: int = 4, nodes: int = 400) -> Plan:
    """Few bins for all items of a histogram: at most ``capacity`` sizes, however many items.

    The incumbent starts as best fit. Descents of the completion search must beat it by the waste
    bound; later descents take a second-best filling at one step each. The search ends at the lower
    bound or after ``tries`` descents, and any incumbent holds every item.
    """
    counts = {s: n for s, n in counts.items() if n}
    bound = lower_bound(counts, capacity) if counts else 0
    best = Plan(best_fit(counts, capacity), bound, capacity)
    for k in range(tries):
        if best.count <= bound:
            break
        bins = complete(counts, capacity, best.count - 1, (k - 1,) if k else (), want, nodes)
        if bins is not None:
            best = Plan(bins, bound, capacity)
    return best
