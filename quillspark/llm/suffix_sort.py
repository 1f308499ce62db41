"""Deep-shallow sorting of suffixes up to a depth.

Shallow: multikey quicksort whose characters are eight, then four bytes; all groups of a level are split at once, in numpy.
Deep: groups that still share SHALLOW bytes, and whose members differ somewhere before the depth, are ordered by a blind
trie each: it branches on single bytes and compares whole strings only once per insertion.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def words(data: np.ndarray, starts: np.ndarray, size: int = 8) -> np.ndarray:
    """The `size` bytes from each start on as a number whose order is that of the bytes. data has 8 bytes to spare."""
    view = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,))
    found = view[starts].astype(np.uint64)
    return found >> np.uint64(8 * (8 - size)) if size < 8 else found


class BlindTrie:
    """Leaves are [string, rows], inner nodes (depth, {byte: child})."""

    def __init__(self) -> None:
        self.root = None

    def insert(self, text: bytes, row: int) -> None:
        node = self.root
        if node is None:
            self.root = [text, [row]]
            return
        while isinstance(node, tuple):
            below = node[1].get(text[node[0]])
            node = below if below is not None else next(iter(node[1].values()))
        if node[0] == text:
            node[1].append(row)
            return
        n = len(text)
        differ = int.from_bytes(text, "big") ^ int.from_bytes(node[0], "big")
        depth = n - (differ.bit_length() + 7) // 8
        other = node[0][depth]
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][text[node[0]]]
        leaf = [text, [row]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][text[depth]] = leaf
            return
        split = (depth, {other: node, text[depth]: leaf})
        if above is None:
            self.root = split
        else:
            above[1][text[above[0]]] = split

    def in_order(self) -> list[list[int]]:
        """Rows of equal strings, by string."""
        out, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            if isinstance(node, tuple):
                waiting.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.append(node[1])
        return out


def sort_suffixes(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes by their first `depth` bytes (more than SHALLOW; all inside data, which has 8 bytes to
    spare behind them), and for each place in it whether the suffix there equals the one before up to the depth."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = words(data, starts)
    order = np.argsort(key)
    group = np.zeros(n, np.uint64)
    for at in range(8, SHALLOW + 4, 4):
        key = key[order] if at == 8 else key[moved]
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.cumsum(edge, dtype=np.uint64) - np.uint64(1)
        if at == SHALLOW:
            break
        key = group << np.uint64(32) | words(data, starts[order] + at, 4)  # group and next character in one number
        moved = np.argsort(key)
        order = order[moved]
    group = group.astype(np.int64)
    same = ~edge
    if not same.any():
        return order, same
    # which neighbours in a group are equal all the way down
    rows = np.flatnonzero(same)
    equal = np.ones(len(rows), bool)
    for at in range(SHALLOW, depth, 8):
        size = min(8, depth - at)
        equal &= words(data, starts[order[rows]] + at, size) == words(data, starts[order[rows - 1]] + at, size)
    unlike = np.unique(group[rows[~equal]])
    same[rows] = equal
    first = np.searchsorted(group, unlike)
    last = np.searchsorted(group, unlike, "right")
    raw = data.tobytes() if len(unlike) else b""
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a == 2:  # two that differ: one comparison is all a trie would make
            x, y = (int(starts[order[i]]) for i in (a, a + 1))
            if raw[x : x + depth] > raw[y : y + depth]:
                order[a], order[a + 1] = order[a + 1], order[a]
            continue
        trie = BlindTrie()
        for row, s in zip(order[a:b].tolist(), starts[order[a:b]].tolist(), strict=True):
            trie.insert(raw[s : s + depth], row)
        found = trie.in_order()
        order[a:b] = [r for rows in found for r in rows]
        same[a:b] = [i > 0 for rows in found for i in range(len(rows))]
    return order, same
