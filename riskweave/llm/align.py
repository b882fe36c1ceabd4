"""Alignment of two sequences of integers with bit vectors held in Python integers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


def _places(a: Sequence[int]) -> dict[int, int]:
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    return places


def banded_distance(a: Sequence[int], b: Sequence[int], limit: int) -> int | None:
    """Edit distance (insert, delete, substitute) if it is at most `limit`, else None.

    Only the diagonals within `limit` of the main one are kept: bit t of a column is the row that lies
    t - limit below it, so the window moves down by one row with each column.
    """
    if limit < 0 or abs(len(a) - len(b)) > limit:
        return None
    head, most = 0, min(len(a), len(b))
    while head < most and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    rows, columns = len(a), len(b)
    if not rows or not columns:
        return max(rows, columns) if max(rows, columns) <= limit else None
    k = min(limit, max(rows, columns))
    places, width = _places(a), 2 * k + 1
    full = (1 << width) - 1
    bottom = 1 << (width - 1)
    plus, minus = full & ~((1 << (k + 1)) - 1), 0  # rows from 1 on grow by one in column 0
    distance = k
    for j in range(1, columns + 1):
        shift = j - k - 1
        seen = places.get(b[j - 1], 0)
        same = (seen >> shift if shift >= 0 else seen << -shift) & full
        up, down = plus >> 1 | bottom, minus >> 1
        diagonal = (((same & up) + up) ^ up | same | down) & full
        right = (down | ~(diagonal | up)) & full
        left = diagonal & up
        if not diagonal & bottom:
            distance += 1
        right_above, left_above = (right << 1 | 1) & full, left << 1 & full
        plus = (left_above | ~(diagonal | right_above)) & full
        minus = diagonal & right_above
    # The tracked cell is row columns + k; walk up to the last real row.
    at = rows - columns + k
    distance -= (plus >> (at + 1)).bit_count() - (minus >> (at + 1)).bit_count()
    return distance if distance <= limit else None


def similar(a: Sequence[int], b: Sequence[int], least: float) -> float | None:
    """1 - distance / longer length if that is at least `least`, else None. Two empty sequences: 1."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int(longer * (1 - least) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return None
    # At most the common multiset can be matched.
    if longer - (Counter(a) & Counter(b)).total() > limit:
        return None
    distance = banded_distance(a, b, limit)
    return None if distance is None else 1 - distance / longer


def common_subsequence(a: Sequence[int], b: Sequence[int]) -> int:
    """Length of the longest common subsequence."""
    places, full = _places(a), (1 << len(a)) - 1
    rows = full
    for x in b:
        hit = rows & places.get(x, 0)
        if hit:
            rows = (rows + hit | rows - hit) & full
    return len(a) - rows.bit_count()
