"""SentencePiece encoding and decoding: forward-filtering backward-sampling over the piece lattice.

A text, with a space in front, falls into units: spaces and what follows up to the next space. No piece of the vocabulary
goes on beyond a unit, so the units' lattices, one after another, are the text's. The forward pass sums the probability of all segmentations up to each position of each distinct unit; then every
occurrence draws its own segmentation backwards from its end, a piece with its share of the sum. The draws are a
hash of row key, unit and step: they depend on nothing else, so a row has the same pieces on any cluster. Code points
without a piece become byte pieces, so decoding gives back every text.

Defined cases: a null or empty text has no pieces and decodes to an empty text; repeated rows (equal keys and texts) have
equal pieces; a null key is a key like any other; a very long text is worked on some units at a time, and a very long unit
in parts between positions that no piece spans; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame

from quillspark.llm.common import by_slice
from quillspark.llm.lattice import MOST, _edges, build, exact_parts, forward, order_of, pieces_of, shares

SEED = 17
#: The more texts are handled together, the more often a unit's lattice is used.
BATCH_BYTES = 6 << 20
#: Code points of distinct units whose lattices are held together.
MOST_CODES = 2 << 20
_UNIT = re.compile(r" *[^ ]+| +")
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def draws(key: np.ndarray, step: int) -> np.ndarray:
    """Uniform in [0, 1), from 64-bit keys."""
    x = key + np.uint64((step + 1) * int(_C1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


class Sampler:
    def __init__(self, model_path: str | None = None, sharpness: float = 1.0) -> None:
        """sharpness: exponent on the probabilities; the larger, the more often the likeliest segmentation is drawn."""
        self.pieces = pieces_of(model_path)
        p = 1 / (self.pieces.ranks + 10)
        p = (p / p.sum()) ** sharpness
        self.byte = p[p > 0].min()
        self.weights = np.append(p, 0)
        self.byte_ids = np.array([self.pieces.bytes[b] for b in range(256)])
        self.text = pa.array(self.pieces.text, pa.large_binary())

    def _bytes_of(self, code: int) -> list[int]:
        return [self.pieces.bytes[b] for b in chr(code).encode("utf-8", "surrogatepass")]

    def _units(self, text: str) -> list[str]:
        found = _UNIT.findall(" " + text) if text else []
        if len(text) > MOST and max(map(len, found)) > MOST:
            return [p for u in found for p in exact_parts(u, self.pieces)]
        return found

    def encode(self, keys: list[int], texts: list[str]) -> list[np.ndarray]:
        """ids of each text. keys: 64-bit seeds of the rows."""
        if len(texts) == 1 and len(texts[0]) > MOST_CODES:
            units, out, a = self._units(texts[0]), [], 0
            while a < len(units):
                b, size = a + 1, len(units[a])
                while b < len(units) and size + len(units[b]) <= MOST_CODES:
                    size += len(units[b])
                    b += 1
                out += self._encode(keys, *_numbered([units[a:b]]), a)
                a = b
            return [np.concatenate(out)]
        number, units, sizes = _numbered(map(self._units, texts))
        if len(texts) > 1 and sum(map(len, number)) > MOST_CODES:
            half = len(texts) // 2
            return self.encode(keys[:half], texts[:half]) + self.encode(keys[half:], texts[half:])
        return self._encode(keys, number, units, sizes)

    def _encode(self, keys: list[int], number: dict[str, int], units: np.ndarray, sizes: list[int], place: int = 0) -> list[np.ndarray]:
        """ids of each text, given by the numbers of its units; place: which unit of its text is the first."""
        if not len(units):
            return [np.zeros(0, np.int32) for _ in sizes]
        lattice = build(list(number), self.pieces)
        w = self.weights[lattice.piece]
        bare = lattice.piece < 0
        code = lattice.code[lattice.start].astype(np.int64)
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        w[bare] = self.byte ** width[bare]
        share = shares(lattice, w[:, None], forward(lattice, w[:, None]))[:, 0]
        # likely pieces first: most draws end at the first; whole numbers, so that the order is the same in any company
        rank = (1 << 20) - (share * (1 << 20)).astype(np.int64)
        first = _edges(lattice.stop)  # edges into a node lie together, the shortest first
        nth = np.arange(len(rank)) - np.repeat(first, np.diff(np.append(first, len(rank))))
        few = int(nth.max()).bit_length()
        held = (lattice.stop.astype(np.int64) << 21 | rank) << few | nth
        held.sort()
        into = np.zeros(lattice.first[-1], np.int64)
        into[lattice.stop[first]] = first
        order = into[held >> 21 + few] + (held & ((1 << few) - 1))
        start, stop, piece, code, share = lattice.start[order], lattice.stop[order], lattice.piece[order], code[order].astype(np.int32), share[order]
        edge = np.flatnonzero(np.append(stop[1:] != stop[:-1], True))  # last edge into each node
        begin = np.append(0, edge[:-1] + 1)
        nth = np.arange(len(stop)) - np.repeat(begin, np.diff(np.append(-1, edge)))
        bounds = share.copy()
        for k in range(1, int(nth.max()) + 1):  # summed within each node alone: no rounding depends on other texts
            rows = np.flatnonzero(nth == k)
            bounds[rows] += bounds[rows - 1]
        bounds[edge] = 1  # an edge is drawn where the draw falls below its bound
        likeliest = np.zeros(lattice.first[-1], np.int32)
        likeliest[stop[edge]] = begin
        sizes = np.array(sizes)
        at = place + np.arange(len(units)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        seeds = np.repeat(np.array(keys, np.uint64), sizes) ^ (at.astype(np.uint64) + np.uint64(1)) * _C3
        active = order_of(units)  # occurrences of a unit side by side: near nodes are read together
        seeds, node, begin = seeds[active], lattice.first[units[active] + 1] - 1, lattice.first[units[active]]
        lengths = np.zeros(len(units), np.int32)
        drawn = []
        while len(active):
            draw = draws(seeds, len(drawn))
            at = likeliest[node]
            on = np.flatnonzero(draw >= bounds[at])
            while len(on):
                at[on] += 1
                on = on[draw[on] >= bounds[at[on]]]
            drawn.append((active, at))
            node = start[at]
            going = node > begin
            lengths[active[~going]] = len(drawn)
            more = np.flatnonzero(going)
            node, begin, active, seeds = node[more], begin[more], active[more], seeds[more]
        ends = np.cumsum(lengths)
        edges = np.empty(ends[-1], np.int32)
        for k, (active, at) in enumerate(drawn):
            edges[ends[active] - 1 - k] = at
        ids, codes = piece[edges], code[edges]
        long = np.ones(len(ids), np.int64)
        missing = ids < 0
        long[missing] = 1 + (codes[missing] > 0x7F) + (codes[missing] > 0x7FF) + (codes[missing] > 0xFFFF)
        to = np.concatenate(([0], np.cumsum(long)))
        out = np.repeat(ids, long)
        one = missing & (long == 1)
        out[to[:-1][one]] = self.byte_ids[codes[one]]
        wide = np.flatnonzero(missing & (long > 1))
        for c in np.unique(codes[wide]).tolist():
            rows = wide[codes[wide] == c]
            for j, b in enumerate(self._bytes_of(c)):
                out[to[rows] + j] = b
        unit_ends = to[np.concatenate(([0], ends))]
        text_ends = unit_ends[np.concatenate(([0], np.cumsum(sizes)))]
        out = out.astype(np.int32)
        return [out[a:b] for a, b in zip(text_ends[:-1].tolist(), text_ends[1:].tolist(), strict=True)]

    def decode(self, ids) -> str:
        """The text that was encoded: the pieces' bytes without the space in front."""
        return b"".join(map(self.pieces.text.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")

    def decode_all(self, rows: pa.ListArray) -> Iterable[str]:
        """decode() of each row; null pieces decode to an empty text."""
        taken = self.text.take(rows.flatten())
        held, ends = memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
        sizes = pa.compute.fill_null(pa.compute.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        at = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield str(held[a + 1 : b], "utf-8", "surrogatepass") if b > a else ""


def _numbered(texts: Iterable[list[str]]) -> tuple[dict[str, int], np.ndarray, list[int]]:
    """Numbers of the distinct units, those of all units in order, and how many units each text has."""
    units: list[str] = []
    sizes = []
    for found in texts:
        sizes.append(len(found))
        units += found
    number: dict[str, int] = defaultdict(count().__next__)
    return number, np.fromiter(map(number.__getitem__, units), np.int32, len(units)), sizes


def row_key(value, seed: int = SEED) -> int:
    return xxhash.xxh64_intdigest(b"" if value is None else str(value).encode(), seed)


def _encoder(id_col: str, text_col: str, seed: int):
    def run(batches):
        sampler = Sampler()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = [row_key(k, seed) for k in batch.column(0).to_pylist()]
            rows = sampler.encode(keys, [t or "" for t in batch.column(1).to_pylist()])
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows)))], [id_col, "pieces"])

        return by_slice(work, text_col, BATCH_BYTES)(batches)

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, pieces array<int>) for each row of docs: a narrow map."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_encoder(id_col, text_col, seed), f"`{id_col}` {kind}, pieces array<int>")


def _arrays(batch: pa.RecordBatch):
    """The pieces of each row of an encoded batch, one at a time."""
    column = batch.column(1)
    for i in range(len(column)):
        yield column[i].values.to_numpy() if column[i].is_valid else np.zeros(0, np.int32)


def decode(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, text) from (id, pieces); null pieces decode to an empty text."""

    def run(batches):
        sampler = Sampler()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sampler.decode_all(batch.column(1)), pa.string())], [id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "pieces").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n_pieces, pieces_sha256 of little-endian 32-bit ids, decoded_sha256 of the text decoded from them): encode and
    decode in one worker, without handing the pieces to Spark."""

    def run(batches):
        sampler = Sampler()
        for batch in _encoder(id_col, text_col, seed)(batches):
            rows = [(len(x), hashlib.sha256(x.astype("<i4").tobytes()).hexdigest(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()) for x, text in zip(_arrays(batch), sampler.decode_all(batch.column(1)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in zip(*rows, strict=True))], [id_col, "n_pieces", "pieces_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string")
