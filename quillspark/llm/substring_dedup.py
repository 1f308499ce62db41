"""Suffix-array dedup: every byte inside a string of `length` bytes that also starts in a document with a smaller id goes.

Texts lie in a table bucketed by block (a few MB of documents), so the rounds below read them without dealing them out
again. Only what can repeat is sorted:

1. Every window of `length` bytes is led by the least of its 16-byte grams; windows with equal bytes have equal leaders.
   A run of windows with one leader falls into two halves, by where the leader stands in them; those of the left half have
   some bytes before the leader in common, those of the right half some behind it. A leader with these bytes is the half's
   key (33 bytes or more: a leader alone is shared by chance in large tables), and a window whose key stands in one
   document only repeats nowhere. Blocks send their distinct keys with how many runs each has, and learn which of them
   several documents have, and which have very many runs.
2. The part of a run that has shared keys is a string. A block sorts its strings as suffixes (suffix_sort) and
   compares their bytes, so that equal ones are sent once, with the least id. What is sent is sorted again, all windows as
   suffixes, by ranges of leaders: the strings first, since most that have equals are equal as a whole, then all windows of
   the distinct strings of leaders that have several; neighbours equal over `length` bytes are the same window, and all but
   those of the least id go. Keys with very many runs send single windows, dealt by content and one for each block, so a common
   passage lands in no single task. Where most of the text repeats, ranges of leaders are sent in several turns, so that an
   exchange has no more than about TURN_SHARE of the text's bytes.

Hashes choose what is sent where; what goes is decided by bytes of neighbours among sorted suffixes. What is sent are packed
rows, at most one for each block and part and none without content: their number is bounded by that of the leaders, so it
grows with the text.

Defined cases: a null or empty text has no bytes; a null id is above all others; rows with equal ids never take from each
other; texts shorter than `length` stay whole; a text longer than a block is a block of its own that is worked on in
pieces; an empty table gives an empty result; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import fresh, new_path, partitions, written
from quillspark.llm.suffix_sort import sort_suffixes, words

LENGTH, GRAM = 50, 16
#: Bytes of a block, blocks in a bucket, bytes that are worked on at a time (a longer text is cut, its windows are not).
BLOCK_BYTES, BLOCKS, CHUNK = 4 << 20, 3, 1 << 19
#: Buckets (files and tasks of a round) at most: beyond them a bucket has more blocks, which are read one after another.
BUCKETS = 20_000
#: A part of the leaders covers so many bytes of text; so many parts where there is less text.
PART_BYTES, PARTS = 64 << 20, 48
#: Bytes of one turn's strings, as a share of the text's bytes; bytes that a shared key is taken to send.
TURN_SHARE, SENT_EACH = 1.0, 52
#: Distinct runs of one key, summed over blocks, beyond which single windows are dealt by content.
MANY = 1024
NO_ID = (1 << 63) - 1
_M1, _M2, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_LOW = np.uint64(0xFFFFFF)
#: Bits of a leader's hash that a tag of the run replaces where distinct runs are counted.
_TAG = np.uint64(0xFFFF)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _B and of its inverse modulo 2 to 64."""
    if not _powers or len(_powers[0]) <= n:
        _powers[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, x, np.uint64)))) for x in (_B, pow(_B, -1, 1 << 64))]
    return _powers[0], _powers[1]


_BYTE_CODES = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big") for b in range(256)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_M1)
    return h ^ (h >> np.uint64(29))


class Runs:
    """Runs of windows with one leader in a piece of text: leader's hash and place in the run, a hash of the run's bytes,
    document (row), first and last window, how many windows are of its left half, keys of its halves; and the piece's bytes."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], length: int) -> None:
        sizes = np.array([len(x) for _, _, x in pieces], np.int64)
        self.raw = b"".join(x for _, _, x in pieces) + bytes(64)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.pieces = pieces
        n = len(self.raw) - 64
        ends = np.cumsum(sizes)
        counts = np.maximum(0, sizes - length + 1)
        total = int(counts.sum())
        self.begin = ends - sizes
        if not total:
            self.leader = self.context = self.left = self.right = np.zeros(0, np.uint64)
            self.doc = self.low = self.high = self.lead = self.lefts = np.zeros(0, np.int64)
            return
        m1, m2 = np.uint64(_M1), np.uint64(_M2)
        load = np.ndarray((n + 16,), "<u8", buffer=self.raw, strides=(1,)).astype(np.uint64)
        b = load[8 : n + 8]
        h = load[:n] * m1 ^ ((b >> np.uint64(29)) | (b << np.uint64(35))) * m2
        h = (h ^ (h >> np.uint64(32))) * m1
        h ^= h >> np.uint64(29)
        least = (h & ~_LOW) | np.arange(n, dtype=np.uint64)  # by hash, then leftmost
        span, s = length - GRAM + 1, 1
        while 2 * s <= span:
            least = np.minimum(least[: len(least) - s], least[s:])
            s *= 2
        if span > s:
            least = np.minimum(least[: len(least) - (span - s)], least[span - s :])
        where = np.repeat(self.begin - (np.cumsum(counts) - counts), counts) + np.arange(total)
        row = np.repeat(np.arange(len(pieces), dtype=np.int32), counts)
        at = (least[where] & _LOW).astype(np.int32)
        first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]))))
        self.low = where[first]
        self.high = where[np.append(first[1:], total) - 1]
        leader_at = at[first].astype(np.int64)
        self.lead = leader_at - self.low
        docs = np.array([d for d, _, _ in pieces], np.int64)
        self.doc = docs[row[first]]
        # the least of many hashes are small numbers: mixed again, so that ranges of them are equally full
        leader = (h[leader_at] ^ (h[leader_at] >> np.uint64(31))) * m2
        self.leader = leader ^ (leader >> np.uint64(32))
        # windows with `half` bytes or more before the leader, and the others; grams that all of a half's windows hold
        half = (length - GRAM) // 2 + 1
        behind = length - half + 1 - GRAM
        self.lefts = np.clip(self.lead - half + 1, 0, self.high - self.low + 1)
        gram = lambda shift: h[np.clip(leader_at + shift, 0, n - 1)]
        self.left = mixed(mixed(self.leader ^ gram(-half)) + gram(min(GRAM - half, 0)))
        self.right = mixed(mixed(self.leader + gram(behind)) ^ gram(min(GRAM, behind)))
        power, inverse = _power_tables(max(n, CHUNK + 4096))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_CODES[self.data[:n]] * power[:n])))
        c = (sums[self.high + length] - sums[self.low]) * inverse[self.low]
        c ^= self.lead.astype(np.uint64) * m2 ^ (self.high - self.low).astype(np.uint64) * m1
        c = (c ^ (c >> np.uint64(31))) * m1
        self.context = c ^ (c >> np.uint64(30))


def window_hash(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the bytes of each window."""
    h = np.zeros(len(at), np.uint64)
    for k in range(0, length, 8):
        h = (h ^ words(data, at + k, min(8, length - k))) * np.uint64(_M1)
        h ^= h >> np.uint64(32)
    return h * np.uint64(_M2)


class Block:
    """The documents of a block in a fixed order, and all their runs."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, length: int) -> None:
        ids = [NO_ID if x is None else x for x in table.column(id_col).to_pylist()]
        texts = [x or b"" for x in table.column(text_col).cast(pa.binary()).to_pylist()]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        self.texts = [texts[i] for i in self.order]
        # documents of one id count as one: the row number of its first
        self.rank = np.searchsorted(self.ids, self.ids)
        self.length = length
        groups: list[Runs] = []
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for i, text in enumerate(self.texts):
            if len(text) < length:
                continue
            for a in range(0, max(1, len(text) - length + 1), CHUNK):
                piece = text[a : a + CHUNK + length - 1]
                if held and size + len(piece) > CHUNK + 2048:
                    groups.append(Runs(held, length))
                    held, size = [], 0
                held.append((i, a, piece))
                size += len(piece)
        if held:
            groups.append(Runs(held, length))
        gather = lambda name, kind: np.concatenate([np.zeros(0, kind), *(getattr(g, name) for g in groups)])
        self.leader, self.context = gather("leader", np.uint64), gather("context", np.uint64)
        self.doc = self.rank[gather("doc", np.int64)] if len(self.ids) else np.zeros(0, np.int64)
        self.low, self.high, self.lead = gather("low", np.int64), gather("high", np.int64), gather("lead", np.int64)
        lefts, left, right = gather("lefts", np.int64), gather("left", np.uint64), gather("right", np.uint64)
        # halves: those of the left first
        first, second = np.flatnonzero(lefts > 0), np.flatnonzero(lefts <= self.high - self.low)
        self.lefts, self.n_left = lefts, len(first)
        self.run, self.key = np.concatenate((first, second)), np.concatenate((left[first], right[second]))
        # all pieces end to end: where each run begins in them, and (document, offset in it, place, bytes) of each piece
        self.raw = b"".join([*(g.raw for g in groups), bytes(64)])
        self.data = np.frombuffer(self.raw, np.uint8)
        base = np.cumsum([0, *(len(g.raw) for g in groups)])
        self.at = self.low + np.repeat(base[:-1], [len(g.leader) for g in groups]) if groups else self.low
        self.pieces = [(doc, offset, int(b + start), len(x)) for b, g in zip(base[:-1].tolist(), groups, strict=True) for (doc, offset, x), start in zip(g.pieces, g.begin.tolist(), strict=True)]

    def leaders(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys (48 bits, sorted), about how many distinct runs each has (255 at most), and which of them each half
        has."""
        key = self.key & ~_TAG | self.context[self.run] & _TAG
        order = np.argsort(key)
        key = key[order]
        leader = key >> np.uint64(16)
        new = np.concatenate((np.ones(min(1, len(key)), bool), leader[1:] != leader[:-1]))
        differs = new | np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        runs = np.add.reduceat(differs.astype(np.int64), np.flatnonzero(new)) if len(key) else np.zeros(0, np.int64)
        return leader[new], np.minimum(runs, 255).astype(np.uint8), which

    def several(self, found: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether two documents of the block have a key."""
        low = np.full(len(found), np.iinfo(np.int64).max)
        high = np.full(len(found), -1)
        doc = self.doc[self.run]
        np.minimum.at(low, which, doc)
        np.maximum.at(high, which, doc)
        return low < high

    def units(self, shared: np.ndarray, many: np.ndarray) -> Units:
        """What is shared of each run. shared, many: of each half, whether its key is shared and has very many runs."""
        state = np.zeros((2, len(self.low)), np.int8)
        answer = np.where(shared, 1 + many, 0)
        state[0, self.run[: self.n_left]], state[1, self.run[self.n_left :]] = answer[: self.n_left], answer[self.n_left :]
        most, span = state.max(axis=0), self.high - self.low
        whole = (self.lefts == 0) | (self.lefts > span) | (state[0] == state[1])
        one, left, right = np.flatnonzero(whole & (most > 0)), np.flatnonzero(~whole & (state[0] > 0)), np.flatnonzero(~whole & (state[1] > 0))
        run = np.concatenate((one, left, right))
        skipped = np.concatenate((np.zeros(len(one) + len(left), np.int64), self.lefts[right]))
        stop = np.concatenate((span[one], self.lefts[left] - 1, span[right]))
        kind = np.concatenate((most[one], state[0][left], state[1][right]))
        return Units(self, self.leader[run], self.doc[run], self.at[run] + skipped, stop - skipped, self.lead[run] - skipped, kind == 2)


@dataclass
class Units:
    """Strings of a block whose keys are shared: the leader and its place in the string, document, where it begins, windows
    less one, and whether its key has very many runs."""

    block: Block
    leader: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    span: np.ndarray
    lead: np.ndarray
    many: np.ndarray

    def distinct(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the given units: themselves, in some order; which entry (distinct string) each belongs to; and per entry, sorted
        by leader, the least document and a unit of it."""
        if not len(runs):
            return runs, runs, runs, runs
        length = self.block.length
        order, equal = equal_strings(self.block.data, self.at[runs], self.span[runs] + length, length)
        runs = runs[order]
        heads = np.flatnonzero(~equal)
        least = np.minimum.reduceat(self.doc[runs], heads)
        rank = np.empty(len(heads), np.int64)
        by_leader = np.argsort(self.leader[runs[heads]])
        rank[by_leader] = np.arange(len(heads))
        entry, least = rank[np.cumsum(~equal) - 1], least[by_leader]
        own = np.flatnonzero(self.doc[runs] == least[entry])
        first = np.empty(len(heads), np.int64)
        first[entry[own]] = runs[own]
        return runs, entry, least, first


def equal_strings(data: np.ndarray, at: np.ndarray, width: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of strings (place, bytes: `length` at least) in which equal ones are neighbours, and whether each equals the
    one before. They are sorted as suffixes from their first window on; those of one first window by a hash of what
    follows; neighbours are equal only if all their bytes are."""
    order, same = sort_suffixes(data, at, length)
    group = (np.cumsum(~same) - 1).astype(np.uint64)
    place, wide = at[order], width[order]
    behind = length // 8 * 8
    rest = wide.astype(np.uint64) * np.uint64(_M2)
    tail = lambda rows, k: words(data, place[rows] + k) >> (np.uint64(64) - np.uint64(8) * np.minimum(8, wide[rows] - k).astype(np.uint64))
    shared = np.flatnonzero(same | np.append(same[1:], False))
    for k in range(behind, int(wide.max()), 8):
        rows = shared[wide[shared] > k]
        rest[rows] = (rest[rows] ^ tail(rows, k)) * np.uint64(_M1)
        rest[rows] ^= rest[rows] >> np.uint64(32)
    inner = np.argsort(group << np.uint64(32) | rest >> np.uint64(32))
    order, place, wide, group = order[inner], place[inner], wide[inner], group[inner]
    equal = np.concatenate(([False], (group[1:] == group[:-1]) & (wide[1:] == wide[:-1])))
    for k in range(behind, int(wide.max()), 8):
        rows = np.flatnonzero(equal)
        rows = rows[wide[rows] > k]
        equal[rows] = tail(rows, k) == tail(rows - 1, k)
    return order, equal


def _part_of(leaders: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """The part of each leader of `bits` bits: equal ranges of its first 32 bits, in order."""
    return ((leaders >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _runs_of(sorted_numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(number, first, behind the last) of each run of equal numbers."""
    edges = np.flatnonzero(np.concatenate(([True], sorted_numbers[1:] != sorted_numbers[:-1], [True]))) if len(sorted_numbers) else np.zeros(1, np.int64)
    return [(int(sorted_numbers[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _gathered(replies: dict, round_: int, kind: int, sizes: list[tuple[int, int]]) -> np.ndarray:
    """The bits that parts replied to a block in a round, one after another. sizes: (part, bits)."""
    return np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(replies[round_, kind, part], np.uint8), count=n) for part, n in sizes)]).astype(bool)


SENT = "part int, block int, kind int, blob binary"
REPLY = "block int, round int, kind int, part int, blob binary, ones long"
_SENT = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_REPLY = pa.schema([("block", pa.int32()), ("round", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("blob", pa.binary()), ("ones", pa.int64())])


def _replies(table: pa.Table) -> dict:
    return {(r["round"], r["kind"], r["part"]): r["blob"] for r in table.to_pylist()}


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


class Rounds:
    """What blocks send and what parts reply; everything is derived anew from the texts, so any task can run again."""

    def __init__(self, parts: int, id_col: str, text_col: str, length: int, block_col: str = "block") -> None:
        self.parts, self.id_col, self.text_col, self.length, self.block_col = parts, id_col, text_col, length, block_col
        #: Turns of the second round, each for a range of parts; the first one also has all single windows.
        self.turns = 1

    def block(self, table: pa.Table) -> Block:
        return Block(table, self.id_col, self.text_col, self.length)

    def number(self, table: pa.Table) -> int:
        return table.column(self.block_col)[0].as_py()

    # round 1
    def send_leaders(self, table: pa.Table) -> pa.Table:
        block, number = self.block(table), self.number(table)
        found, runs, which = block.leaders()
        several = block.several(found, which)
        packed = found.view(np.uint8).reshape(-1, 8)[:, :6]
        return _rows(_SENT, [(p, number, 0, packed[a:b].tobytes() + runs[a:b].tobytes() + np.packbits(several[a:b]).tobytes()) for p, a, b in _runs_of(_part_of(found, 48, self.parts))])

    def reply_leaders(self, rows: list[dict]) -> Iterator[tuple]:
        """Two kinds of bits for each key sent: several documents have it; it has very many runs."""
        found, runs, several, sizes = [], [], [], []
        for r in rows:
            blob = r["blob"]
            n = 8 * len(blob) // 57  # 7 bytes and a bit each, the bits filled up to a byte
            raw = np.zeros((n, 8), np.uint8)
            raw[:, :6] = np.frombuffer(blob, np.uint8, 6 * n).reshape(-1, 6)
            found.append(raw.view(np.uint64).ravel())
            runs.append(np.frombuffer(blob, np.uint8, n, offset=6 * n))
            several.append(np.unpackbits(np.frombuffer(blob, np.uint8, offset=7 * n), count=n))
            sizes.append(n)
        found = np.concatenate(found)
        order = np.argsort(found)
        new = np.concatenate(([True], found[order][1:] != found[order][:-1]))
        starts, of = np.flatnonzero(new), np.cumsum(new) - 1
        counts = np.diff(np.append(starts, len(found)))
        total = np.add.reduceat(np.concatenate(runs)[order].astype(np.int64), starts)
        marked = np.add.reduceat(np.concatenate(several)[order].astype(np.int64), starts) > 0
        answer = np.empty((2, len(found)), bool)
        answer[0, order], answer[1, order] = (marked | (counts > 1))[of], (total > MANY)[of]
        for kind in range(2):
            for r, part in zip(rows, np.split(answer[kind], np.cumsum(sizes)[:-1]), strict=True):
                yield r["block"], 1, kind, r["part"], np.packbits(part).tobytes(), int(part.sum())

    def units(self, block: Block, replies: dict) -> Units:
        found, _, which = block.leaders()
        sizes = [(p, b - a) for p, a, b in _runs_of(_part_of(found, 48, self.parts))]
        return block.units(_gathered(replies, 1, 0, sizes)[which], _gathered(replies, 1, 1, sizes)[which])

    def entries(self, units: Units, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units.distinct() of a turn's units, and for each entry whether its key has very many runs."""
        of = _part_of(units.leader, 64, self.parts) * self.turns // self.parts
        runs, entry, least, first = units.distinct(np.flatnonzero(np.where(units.many, 0, of) == turn))
        return runs, entry, least, first, units.many[first]

    # round 2
    def windows(self, units: Units, least: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
        """Entries that are sent whole (sorted by leader); and of the others: entry of each window and which distinct window
        it is; and of the distinct ones, sorted by part, where the window is, its least document and its part."""
        whole, alone = np.flatnonzero(~many), np.flatnonzero(many)
        if not len(alone):
            return whole, alone, alone, alone, alone, alone
        data, each = units.block.data, units.span[first[alone]] + 1
        of = np.repeat(alone, each)
        at = np.repeat(units.at[first[alone]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        order, same = sort_suffixes(data, at, self.length)
        number = np.cumsum(~same) - 1
        order = order[np.lexsort((least[of][order], number))]  # the least document of a window first
        heads = order[np.flatnonzero(~same)]
        part = _part_of(window_hash(data, at[heads], self.length), 64, self.parts)
        by_part = np.argsort(part, kind="stable")
        rank = np.empty(len(heads), np.int64)
        rank[by_part] = np.arange(len(heads))
        which = np.empty(len(at), np.int64)
        which[order] = rank[number]
        heads = heads[by_part]
        return whole, of, which, at[heads], least[of[heads]], part[by_part]

    def send_windows(self, table: pa.Table, answers: pa.Table, turn: int = 0) -> pa.Table:
        if not table.num_rows:
            return _rows(_SENT, [])
        block, number, out = self.block(table), self.number(table), []
        units = self.units(block, _replies(answers))
        _, _, least, first, many = self.entries(units, turn)
        whole, _, _, head_at, head_doc, part = self.windows(units, least, first, many)
        runs = first[whole]
        at, stop = units.at[runs], units.at[runs] + units.span[runs] + self.length
        for p, a, b in _runs_of(_part_of(units.leader[runs], 64, self.parts)):
            out.append((p, number, 0, self._packed(block.raw, at[a:b], stop[a:b], block.ids[least[whole[a:b]]], units.lead[runs[a:b]])))
        for p, a, b in _runs_of(part):
            out.append((p, number, 1, self._packed(block.raw, head_at[a:b], head_at[a:b] + self.length, block.ids[head_doc[a:b]], np.zeros(b - a))))
        return _rows(_SENT, out)

    @staticmethod
    def _packed(raw: bytes, at: np.ndarray, stop: np.ndarray, ids: np.ndarray, lead: np.ndarray) -> bytes:
        """Strings with their ids and where their leaders stand in them."""
        texts = [raw[a:b] for a, b in zip(at.tolist(), stop.tolist(), strict=True)]
        return np.array([len(at)], np.int64).tobytes() + ids.astype(np.int64).tobytes() + (stop - at).astype(np.uint16).tobytes() + lead.astype(np.uint8).tobytes() + b"".join(texts)

    def reply_windows(self, rows: list[dict]) -> Iterator[tuple]:
        """For each window sent, in order, whether a smaller document has it."""
        for kind in range(2):
            mine = [r for r in rows if r["kind"] == kind]
            if not mine:
                continue
            ids, sizes, lead, texts, counts = [], [], [], [], []
            for r in mine:
                blob = r["blob"]
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                ids.append(np.frombuffer(blob, np.int64, n, offset=8))
                sizes.append(np.frombuffer(blob, np.uint16, n, offset=8 + 8 * n).astype(np.int64))
                lead.append(np.frombuffer(blob, np.uint8, n, offset=8 + 10 * n))
                texts.append(blob[8 + 11 * n :])
                counts.append(int((sizes[-1] - self.length + 1).sum()))
            repeated = self._repeated(np.concatenate(ids), np.concatenate(sizes), np.concatenate(lead), np.frombuffer(b"".join(texts) + bytes(8), np.uint8), kind == 1)
            for r, part in zip(mine, np.split(repeated, np.cumsum(counts)[:-1]), strict=True):
                yield r["block"], 2, r["kind"], r["part"], np.packbits(part).tobytes(), int(part.sum())

    def _repeated(self, ids: np.ndarray, sizes: np.ndarray, lead: np.ndarray, data: np.ndarray, single: bool) -> np.ndarray:
        """For each window of the strings, whether a string of a smaller id has it."""
        begin, each = np.cumsum(sizes) - sizes, sizes - self.length + 1
        order, equal = equal_strings(data, begin, sizes, self.length)
        heads, entry = np.flatnonzero(~equal), np.empty(len(ids), np.int64)
        entry[order] = np.cumsum(~equal) - 1
        least, one = np.minimum.reduceat(ids[order], heads), order[heads]  # of each distinct string
        later = ids > least[entry]  # a smaller document has the whole string
        if single:
            return later
        # distinct strings around one leader may share some windows: all of theirs are sorted
        gram = begin[one] + lead[one]
        first, second = words(data, gram), words(data, gram + 8)
        by_gram = np.lexsort((second, first))
        differs = (first[by_gram][1:] != first[by_gram][:-1]) | (second[by_gram][1:] != second[by_gram][:-1])
        alone = np.empty(len(one), bool)
        alone[by_gram] = np.concatenate(([True], differs)) & np.concatenate((differs, [True]))
        open_ = np.flatnonzero(~alone)
        n = each[one]
        start = np.cumsum(n) - n
        flags = np.zeros(int(n.sum()), bool)  # of the windows of distinct strings
        if len(open_):
            own = n[open_]
            shift = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            owner = np.repeat(least[open_], own)
            sorted_, same = sort_suffixes(data, np.repeat(begin[one[open_]], own) + shift, self.length)
            smallest = np.minimum.reduceat(owner[sorted_], np.flatnonzero(~same))
            found = np.empty(len(owner), bool)
            found[sorted_] = owner[sorted_] > smallest[np.cumsum(~same) - 1]
            flags[np.repeat(start[open_], own) + shift] = found
        shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        return np.repeat(later, each) | flags[np.repeat(start[entry], each) + shift]

    def removed(self, block: Block, replies: dict) -> list[np.ndarray]:
        """For each document of the block, which of its bytes go."""
        units, edge = self.units(block, replies), np.zeros(len(block.raw) + 1, np.int32)
        for turn in range(self.turns):  # as they were sent
            self._removed(units, replies, turn, edge)
        covered = np.cumsum(edge) > 0
        # windows of pieces of one long text meet in the text
        out = [np.zeros(len(t), bool) for t in block.texts]
        for doc, offset, start, n in block.pieces:
            out[doc][offset : offset + n] |= covered[start : start + n]
        return out

    def _removed(self, units: Units, replies: dict, turn: int, edge: np.ndarray) -> None:
        """Adds to edge where windows of a turn that go begin and end."""
        runs, entry, least, first, many = self.entries(units, turn)
        whole, of, which, _, head_doc, part = self.windows(units, least, first, many)
        each = units.span[first] + 1
        flags = np.zeros(int(each.sum()), bool)  # of the windows of all entries, whether a smaller document has them
        begin = np.cumsum(each) - each
        if len(whole):
            sizes = [(p, int(each[whole[a:b]].sum())) for p, a, b in _runs_of(_part_of(units.leader[first[whole]], 64, self.parts))]
            own = each[whole]
            flags[np.repeat(begin[whole] - (np.cumsum(own) - own), own) + np.arange(own.sum())] = _gathered(replies, 2, 0, sizes)
        if len(of):
            bits = _gathered(replies, 2, 1, [(p, b - a) for p, a, b in _runs_of(part)])
            own = each[many]
            flags[np.repeat(begin[many] - (np.cumsum(own) - own), own) + np.arange(own.sum())] = bits[which] | (least[of] > head_doc[which])  # a smaller document of the block counts too
        later = units.doc[runs] > least[entry]  # a smaller document of the block has the string
        at, span = units.at[runs[later]], units.span[runs[later]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + span + self.length, -1)
        rest = np.flatnonzero(~later)
        own = each[entry[rest]]
        shift = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        gone = flags[np.repeat(begin[entry[rest]], own) + shift]
        at = (np.repeat(units.at[runs[rest]], own) + shift)[gone]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.length, -1)


def _reduce(work: Callable[[list[dict]], Iterator[tuple]]) -> Callable:
    """For mapInArrow over rows sorted by part: a part at a time."""

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["part"] != r["part"]:
                    yield from _rows(_REPLY, list(work(held))).to_batches()
                    held = []
                held.append(r)
        if held:
            yield from _rows(_REPLY, list(work(held))).to_batches()

    return run


def _in_blocks(docs: DataFrame, id_col: str, text_col: str, block_col: str) -> tuple[DataFrame, int]:
    """docs as a table bucketed by block, and their bytes. The table leaves the catalogue at once; its files stay."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = min(BUCKETS, max(partitions(spark), -(-total // (BLOCK_BYTES * BLOCKS))))
    blocks = max(buckets * BLOCKS, -(-total // BLOCK_BYTES))
    path = new_path(spark, "blocks")
    name = f"blocks_{path[-32:]}"
    # by id and text, so that rows without an id don't all fall into one block
    named = docs.withColumn(block_col, F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int"))
    dealt = named.repartition(buckets, block_col)
    dealt.write.bucketBy(buckets, block_col).option("path", path).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved: the plan knows files and buckets  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return table, total


def _turns(shared: int, total: int, parts: int) -> int:
    """In how many turns strings are sent: so many that none sends much more than TURN_SHARE of the text's bytes."""
    return max(1, min(parts, ceil(shared * SENT_EACH / max(1.0, TURN_SHARE * total))))


def repeats(docs: DataFrame, finish: Callable[[Block, list[np.ndarray], pa.Table, str], pa.Table], schema: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """finish(block, removed bytes of each of its documents, its rows, its block column) for every block, as rows of the schema."""
    spark = docs.sparkSession
    (block_col,) = fresh(docs, "block")
    blocks, total = _in_blocks(docs, id_col, text_col, block_col)
    parts = max(min(partitions(spark), PARTS), total // PART_BYTES)
    rounds = Rounds(parts, id_col, text_col, length, block_col)
    slim = blocks.select(id_col, text_col, block_col).groupBy(block_col)

    def exchanged(sent: DataFrame, work: Callable) -> DataFrame:
        dealt = sent.repartitionById(min(parts, BUCKETS), F.col("part")).sortWithinPartitions("part", "block", "kind")
        return written(dealt.mapInArrow(_reduce(work), REPLY), "replies")

    def send(turn: int) -> Callable:
        return lambda rows, answers: rounds.send_windows(rows, answers, turn)

    first = replies = exchanged(slim.applyInArrow(lambda rows: rounds.send_leaders(rows), SENT), rounds.reply_leaders)
    rounds.turns = _turns(first.where("kind = 0").agg(F.sum("ones")).first()[0] or 0, total, parts)
    for turn in range(rounds.turns):
        replies = replies.union(exchanged(slim.cogroup(first.groupBy("block")).applyInArrow(send(turn), SENT), rounds.reply_windows))

    def last(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = rounds.block(table)
        return finish(block, rounds.removed(block, _replies(answers)), table, block_col)

    return blocks.groupBy(block_col).cogroup(replies.groupBy("block")).applyInArrow(last, schema)


def kept_bytes(text: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(text, np.uint8)[~gone].tobytes()


FIELDS = ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of docs: id and FIELDS."""
    kind = docs.schema[id_col].dataType
    names = [id_col, *(x.split()[0] for x in FIELDS)]

    def finish(block: Block, gone: list[np.ndarray], table: pa.Table, block_col: str) -> pa.Table:
        count = [int(g.sum()) for g in gone]
        runs = [int((np.diff(np.concatenate(([False], g)).astype(np.int8)) == 1).sum()) for g in gone]
        kept = [hashlib.sha256(kept_bytes(t, g) if n else t).hexdigest() for t, g, n in zip(block.texts, gone, count, strict=True)]
        ids = table.column(id_col).take(pa.array(block.order, pa.int64()))
        return pa.Table.from_arrays([ids, pa.array([len(t) for t in block.texts], pa.int64()), pa.array(count, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.string())], names)

    return repeats(docs.select(id_col, text_col), finish, f"`{id_col}` {kind.simpleString()}, {', '.join(FIELDS)}", id_col, text_col, length)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut out of the texts; what is left of a character that was cut through goes too. A text
    that was null stays null."""

    def finish(block: Block, gone: list[np.ndarray], table: pa.Table, block_col: str) -> pa.Table:
        rows = table.take(pa.array(block.order, pa.int64()))
        was = rows.column(text_col).is_null().to_pylist()
        texts = [None if null else kept_bytes(t, g).decode("utf-8", "ignore") for null, t, g in zip(was, block.texts, gone, strict=True)]
        at = rows.schema.get_field_index(text_col)
        return rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type)).drop_columns([block_col])

    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema.fields])
    return repeats(docs, finish, schema, id_col, text_col, length)


SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(length(h) // 2 - {LENGTH} + 1)) AS p, h FROM d WHERE length(h) >= {2 * LENGTH}),
s AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * LENGTH}) AS s FROM w),
f AS (SELECT s, min(doc_id) AS first_doc FROM s GROUP BY s HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT s.doc_id, s.p FROM s JOIN f USING (s) WHERE s.doc_id > f.first_doc),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS new FROM r),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM g),
runs AS (SELECT doc_id, island, min(p) AS a, max(p) + {LENGTH} AS b FROM i GROUP BY doc_id, island),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
parts AS (
  SELECT doc_id, before AS place, substr(h, 2 * before + 1, 2 * (a - before)) AS piece FROM gaps JOIN d USING (doc_id)
  UNION ALL
  SELECT d.doc_id, coalesce(e.b, 0), substr(h, 2 * coalesce(e.b, 0) + 1) FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY doc_id) e ON d.doc_id = e.doc_id),
kept AS (SELECT doc_id, sha256(unhex(string_agg(piece, '' ORDER BY place))) AS kept_sha256 FROM parts GROUP BY doc_id),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN cut ON cut.doc_id = d.doc_id
"""
