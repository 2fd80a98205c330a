"""Deep-shallow sorting of fixed-length byte strings, with the longest common prefix of neighbours.

Up to a shallow depth, strings are sorted by multikey quicksort, eight bytes at a time: within a
group of equal beginnings the next word is sorted, and only groups with more than one string go
on. What is still equal at that depth has a long common prefix, for which comparing from the front
would be wasted: each such group is ordered by a blind trie, which stores only where strings
branch. A string goes down the trie without comparing, is compared once, as a whole, with the leaf
it arrives at, and is inserted where they differ.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 40


class Branch:
    """An inner node of a blind trie: the depth at which its strings differ, and a child for each byte."""

    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


def blind_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(order, common prefix of each string in that order with the one before; 0 for the first)."""
    width = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root: Branch | list[int] = [0]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while isinstance(node, Branch):
            # an unknown byte: any leaf below agrees with the string as far as it can
            node = node.kids.get(s[node.depth]) or next(iter(node.kids.values()))
        other = numbers[node[0]] ^ numbers[i]
        if not other:
            node.append(i)
            continue
        common = width - (other.bit_length() + 7) // 8
        above, node = None, root
        while isinstance(node, Branch) and node.depth < common:
            above, node = node, node.kids[s[node.depth]]
        if isinstance(node, Branch) and node.depth == common:
            node.kids[s[common]] = [i]
            continue
        leaf = node
        while isinstance(leaf, Branch):
            leaf = next(iter(leaf.kids.values()))
        new = Branch(common, {strings[leaf[0]][common]: node, s[common]: [i]})
        if above is None:
            root = new
        else:
            above.kids[s[above.depth]] = new
    order, commons, todo = [], [], [(root, 0)]
    while todo:
        node, common = todo.pop()
        if isinstance(node, Branch):
            kids = [node.kids[b] for b in sorted(node.kids)]
            todo.extend((k, node.depth) for k in reversed(kids[1:]))
            todo.append((kids[0], common))
        else:
            order += node
            commons += [common] + [width] * (len(node) - 1)
    return order, commons


def deep_shallow_sort(strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the order of the rows of ``strings`` (n x width bytes), and the common prefix of
    each row in that order with the row before it (0 for the first)."""
    n, width = strings.shape
    order, common = np.arange(n), np.zeros(n, np.int64)
    if n < 2:
        return order, common
    wide = -(-width // 8) * 8
    padded = np.zeros((n, wide), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    # rows that are not alone yet, in their current order, and the place where each group starts
    places, starts = np.arange(n), np.zeros(n, np.int64)
    for k in range(min(shallow, wide) // 8):
        word = words[order[places], k]
        by = np.lexsort((word, starts))
        order[places] = order[places][by]
        word = word[by]
        differs = (word[1:] != word[:-1]) & (starts[1:] == starts[:-1])
        at = np.flatnonzero(differs) + 1
        same_bytes = (padded[order[places[at]], 8 * k:8 * k + 8] != padded[order[places[at - 1]], 8 * k:8 * k + 8]).argmax(axis=1)
        common[places[at]] = 8 * k + same_bytes
        new = np.concatenate([[True], differs | (starts[1:] != starts[:-1])])
        sizes = np.diff(np.append(np.flatnonzero(new), len(places)))
        group = np.repeat(np.arange(len(sizes)), sizes)
        keep = sizes[group] > 1
        starts = places[np.flatnonzero(new)][group][keep]
        places = places[keep]
        if not len(places):
            return order, common
    cuts = np.append(np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1]])), len(places))
    for first, last in zip(cuts, cuts[1:]):
        lo, hi = int(places[first]), int(places[last - 1]) + 1
        rows = order[lo:hi]
        inner, commons = blind_order([padded[r].tobytes() for r in rows.tolist()])
        order[lo:hi] = rows[inner]
        common[lo + 1:hi] = np.minimum(commons[1:], width)
    return order, common
