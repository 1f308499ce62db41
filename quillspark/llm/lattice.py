"""Lattices of all segmentations of many short texts into vocabulary pieces, as numpy columns. Pieces have a
space where the vocabulary writes U+2581.

Units (words) are laid end to end as code points. From every position the pieces are followed one code point at a time;
positions drop out as soon as no piece goes on, so work follows the number of pieces found. In units of more than DEEP code
points, a position that no piece spans is certain: every segmentation passes it. Sums start anew behind it, which changes
no probability, and from DEEP code points behind it on they carry an exponent of their own, so units of any length are
summed as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Code points behind a certain position from which sums carry an exponent; most code points that exact_parts leaves together.
DEEP, MOST = 24, 1 << 16
_M = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 18
NEAR, NONE = 512, -2


def load_pieces(model_path: str | None = None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path or public_tokenizers.path("piece_bpe_32k.model"))


class Pieces:
    """The text pieces of a vocabulary, findable by hashes of their prefixes."""

    def __init__(self, model_path: str | None = None) -> None:
        processor = load_pieces(model_path)
        self.size = processor.get_piece_size()
        self.bytes = {}
        self.text: list[bytes] = [b""] * self.size
        prefixes: dict[int, tuple[str, int]] = {}
        ranks = np.full(self.size, np.inf)
        m, mask = int(_M), (1 << 64) - 1
        for i in range(self.size):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
                continue
            if processor.is_control(i) or processor.is_unknown(i):
                continue
            piece = piece.replace("▁", " ")  # so a literal U+2581 of a text matches no piece
            self.text[i] = piece.encode()
            ranks[i] = max(1.0, -processor.get_score(i))
            h = 0
            for k, c in enumerate(piece, 1):
                h = (h * m + ord(c) + 1) & mask
                old, found = prefixes.get(h, (piece[:k], -1))
                assert old == piece[:k], "two prefixes share a hash"
                prefixes[h] = (old, i if k == len(piece) else found)
        self.longest = max(len(p) for p, _ in prefixes.values())
        self.ranks = ranks
        #: Open addressing by the hashes' top bits, 0 where a slot is free.
        self.hashes = np.zeros((1 << TABLE_BITS) + 64, np.uint64)
        self.piece = np.full(len(self.hashes), -1, np.int32)
        for h, (_, found) in prefixes.items():
            at = h >> 64 - TABLE_BITS
            while self.hashes[at]:
                at += 1
            self.hashes[at], self.piece[at] = h, found
        self.marks = (self.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)  # half as wide: more of it stays in the cache
        self.marks[(self.hashes != 0) & (self.marks == 0)] = 1
        #: Pieces by their first one and two code points: NONE if no piece goes on so, -1 if none ends there.
        self.one = np.full(0x110000, NONE, np.int32)
        self.two = np.full(NEAR * NEAR, NONE, np.int32)
        for prefix, found in prefixes.values():
            if len(prefix) == 1:
                self.one[ord(prefix)] = found
            elif len(prefix) == 2 and max(map(ord, prefix)) < NEAR:
                self.two[ord(prefix[0]) * NEAR + ord(prefix[1])] = found

    def starts(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """find() for single code points."""
        piece = self.one[code]
        rows = np.flatnonzero(piece != NONE)
        return rows, piece[rows]

    def pairs(self, a: np.ndarray, b: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """find() for two code points."""
        near = (a < NEAR) & (b < NEAR)
        if near.all():
            piece = self.two[a * np.uint32(NEAR) + b]
        else:
            piece = np.full(len(a), NONE, np.int32)
            piece[near] = self.two[a[near] * np.uint32(NEAR) + b[near]]
            far = np.flatnonzero(~near)
            rows, found = self.find(h[far])
            piece[far[rows]] = found
        rows = np.flatnonzero(piece != NONE)
        return rows, piece[rows]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are prefixes of pieces (row numbers, sorted), and the piece that ends there or -1."""
        at = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
        mark = h.astype(np.uint32)
        mark[mark == 0] = 1
        there = self.marks[at]
        hit = there == mark
        hit[hit] = self.hashes[at[hit]] == h[hit]
        open_rows = np.flatnonzero((there != 0) & ~hit)
        while len(open_rows):
            at[open_rows] += 1
            there = self.hashes[at[open_rows]]
            same = there == h[open_rows]
            hit[open_rows[same]] = True
            open_rows = open_rows[(there != 0) & ~same]
        rows = np.flatnonzero(hit)
        return rows, self.piece[at[rows]]


@dataclass
class Lattice:
    """Nodes are unit borders and positions within units; edges are pieces, sorted by the node where they end."""

    first: np.ndarray  # first node of each unit; the last is first[i + 1] - 1
    code: np.ndarray  # code point behind each node (0 at a unit's end)
    start: np.ndarray  # of each edge: node
    stop: np.ndarray
    piece: np.ndarray  # -1: the one code point has no piece
    certain: np.ndarray  # first nodes, and in long units the nodes that no edge spans
    long: bool  # whether there are long units
    groups: list[tuple[int, slice]]  # edges by how far they end behind the certain node before


def order_of(keys: np.ndarray) -> np.ndarray:
    """Stable argsort of whole numbers from 0: numpy sorts numbers several times as fast as it sorts their places."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> 63 - bits:
        return np.argsort(keys, kind="stable")
    held = keys.astype(np.int64) << bits | np.arange(len(keys))
    held.sort()
    return held & ((1 << bits) - 1)


def build(units: list[str], pieces: Pieces) -> Lattice:
    lengths = np.fromiter(map(len, units), np.int32, len(units))
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate(([0], np.cumsum(lengths + 1, dtype=np.int32)))
    node = np.arange(len(codes), dtype=np.int32) + np.repeat(np.arange(len(units), dtype=np.int32), lengths)  # of each code point
    code = np.zeros(first[-1], np.uint32)
    code[node] = codes
    step = code.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(codes), np.uint64)
    active = node
    starts, stops, found = [], [], []
    single = np.zeros(first[-1], bool)
    for k in range(pieces.longest):
        h = h * _M + step[active + k]
        rows, piece = pieces.starts(code[active]) if k == 0 else pieces.pairs(code[active], code[active + 1], h) if k == 1 else pieces.find(h)
        active, h = active[rows], h[rows]
        whole = np.flatnonzero(piece >= 0)
        ends = active[whole]
        starts.append(ends)
        stops.append(ends + np.int32(k + 1))
        found.append(piece[whole])
        if k == 0:
            single[ends] = True
        go = np.flatnonzero(code[active + (k + 1)])  # no code point: the unit's end
        active, h = active[go], h[go]
        if not len(active):
            break
    bare = node[~single[node]]
    starts.append(bare)
    stops.append(bare + np.int32(1))
    found.append(np.full(len(bare), -1, np.int32))
    start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(found)
    n = int(first[-1])
    long = bool(len(lengths)) and int(lengths.max()) > DEEP
    certain = np.zeros(n, bool)
    certain[first[:-1]] = True
    if long:
        free = np.cumsum(np.bincount(start + 1, minlength=n + 1)[:n] - np.bincount(stop, minlength=n)[:n]) == 0
        certain |= free & np.repeat(lengths > DEEP, lengths + 1)
    at = np.arange(n, dtype=np.int32)
    before = np.maximum.accumulate(np.where(certain, at, 0)) if n else at
    depth = at - np.concatenate((before[:1], before[:-1]))
    depth = depth[stop]
    wide = n.bit_length()
    order = order_of((depth.astype(np.int64) << wide | stop) << pieces.longest.bit_length() | (stop - start))  # no two keys are equal
    start, stop, piece, depth = start[order], stop[order], piece[order], depth[order]
    edges = np.flatnonzero(np.concatenate(([True], depth[1:] != depth[:-1], [True]))) if len(depth) else np.zeros(1, np.int64)
    groups = [(int(depth[a]), slice(a, b)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return Lattice(first, code, start, stop, piece, certain, long, groups)


def _edges(at: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))


@dataclass
class Sums:
    """Of each node and model, the summed probability of all segmentations from the certain node before: as they leave the
    node (1 at certain nodes) and as they reach it. Both times 2 to the power of their exponent (None: 0 throughout)."""

    leaving: np.ndarray
    reaching: np.ndarray
    leaving_exponent: np.ndarray | None
    reaching_exponent: np.ndarray | None


def forward(lattice: Lattice, weights: np.ndarray) -> Sums:
    """weights: per edge, one column for each model."""
    shape = (int(lattice.first[-1]), weights.shape[1])
    leaving = np.zeros(shape)
    leaving[lattice.certain] = 1
    reaching = np.zeros(shape) if lattice.long else leaving
    deep = bool(lattice.groups) and lattice.groups[-1][0] > DEEP
    out, into = (np.zeros(shape, np.int32), np.zeros(shape, np.int32)) if deep else (None, None)
    for depth, part in lattice.groups:
        start, stop = lattice.start[part], lattice.stop[part]
        edge = _edges(stop)
        at, value = stop[edge], leaving[start] * weights[part]
        if depth <= DEEP:
            total = np.add.reduceat(value, edge, axis=0)
        else:
            largest = np.maximum.reduceat(out[start], edge, axis=0)
            counts = np.diff(np.append(edge, len(stop)))
            total, exponent = np.frexp(np.add.reduceat(np.ldexp(value, out[start] - np.repeat(largest, counts, axis=0)), edge, axis=0))
            into[at] = exponent + largest
        reaching[at] = total
        if lattice.long:
            inner = ~lattice.certain[at]
            leaving[at[inner]] = total[inner]
            if depth > DEEP:
                out[at[inner]] = into[at[inner]]
    return Sums(leaving, reaching, out, into)


def shares(lattice: Lattice, weights: np.ndarray, sums: Sums) -> np.ndarray:
    """Of the segmentations that reach an edge's end, the share that comes by the edge."""
    found = sums.leaving[lattice.start] * weights / sums.reaching[lattice.stop]
    if sums.leaving_exponent is not None:
        found = np.ldexp(found, sums.leaving_exponent[lattice.start] - sums.reaching_exponent[lattice.stop])
    return found


def posteriors(lattice: Lattice, share: np.ndarray) -> np.ndarray:
    """For each edge the probability that a unit's segmentation has it. share: of one model."""
    node = lattice.certain.astype(float)
    node[lattice.first[1:] - 1] = 1
    out = np.zeros(len(share))
    for _, part in reversed(lattice.groups):
        # all edges into a depth come before any out of it, so a node's later edges have been added by now
        out[part] = node[lattice.stop[part]] * share[part]
        inner = np.flatnonzero(~lattice.certain[lattice.start[part]])
        if len(inner):
            start = lattice.start[part][inner]
            order = np.argsort(start, kind="stable")
            edge = _edges(start[order])
            node[start[order][edge]] += np.add.reduceat(out[part][inner][order], edge)
    return out


def log_whole(lattice: Lattice, sums: Sums) -> np.ndarray:
    """Log of the summed probability of all segmentations of each unit (rows; none is empty) in each model (columns)."""
    if not lattice.long:
        return np.log(sums.reaching[lattice.first[1:] - 1])
    ends = lattice.certain.copy()
    ends[lattice.first[:-1]] = False
    ends[lattice.first[1:] - 1] = True
    ends = np.flatnonzero(ends)
    logs = np.log(sums.reaching[ends])
    if sums.reaching_exponent is not None:
        logs += sums.reaching_exponent[ends] * np.log(2)
    return np.add.reduceat(logs, np.searchsorted(ends, lattice.first[:-1]), axis=0) if len(ends) else logs


def exact_parts(text: str, pieces: Pieces) -> list[str]:
    """A long text cut at certain positions, so that its segmentations are those of its parts one after another. A stretch
    without one stays whole."""
    out, a = [], 0
    while len(text) - a > MOST:
        span = MOST
        while True:
            window = build([text[a : a + span + pieces.longest]], pieces)
            cuts = np.flatnonzero(window.certain[1 : span + 1])
            if len(cuts) or a + span >= len(text):
                break
            span *= 2
        if not len(cuts) or a + 1 + cuts[-1] >= len(text):
            break
        out.append(text[a : a + 1 + int(cuts[-1])])
        a += 1 + int(cuts[-1])
    return [*out, text[a:]]


@lru_cache(maxsize=2)
def pieces_of(model_path: str | None = None) -> Pieces:
    """One for each worker process."""
    return Pieces(model_path)
