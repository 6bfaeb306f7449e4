"""BK-trees over 64-bit fingerprints, and the links they find within a shard."""

from __future__ import annotations

from collections.abc import Iterable


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent.

    A node is [fingerprint, label, children]. All nodes below child k differ from the
    parent in exactly k bits, so a search for radius r around a value at distance d from
    the parent needs the children d - r to d + r only.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int, label: int) -> None:
        if self.root is None:
            self.root = [value, label, {}]
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            child = node[2].get(distance)
            if child is None:
                node[2][distance] = [value, label, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Labels of all nodes at most `radius` bits from `value`."""
        found, open_ = [], [self.root] if self.root else []
        while open_:
            node = open_.pop()
            distance = (node[0] ^ value).bit_count()
            if distance <= radius:
                found.append(node[1])
            children = node[2]
            if children:
                if len(children) <= 2 * radius + 1:
                    open_ += [c for k, c in children.items() if -radius <= k - distance <= radius]
                else:
                    open_ += [children[k] for k in range(distance - radius, distance + radius + 1) if k in children]
        return found


def shard_links(values: Iterable[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value linked to it inside the shard) for values that have links.

    One row per value at most, not one per pair: links between values of one class that
    are implied by these are left out, the classes are the same.
    """
    ordered = sorted(set(values))
    parent = list(range(len(ordered)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = BKTree()
    for i, value in enumerate(ordered):
        for j in tree.within(value, radius):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(value, i)
    return [(v, ordered[find(i)]) for i, v in enumerate(ordered) if find(i) != i]
