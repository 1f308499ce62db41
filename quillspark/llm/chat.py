"""Chat formatting: columnar byte assembly.

Turns become `<|turn|>role<|says|>text<|end|>`. Inside roles and texts each `<`, `[` and backslash gets a backslash
behind it, so that no control string of this or other templates (`</s>`, `[INST]`, `<|...|>`) survives there, and
reading back drops the byte behind each of them. Lengths, offsets and target places are numpy columns; every byte is
copied once, into one preallocated buffer which is the Arrow column of the result: the turns of a conversation lie side by
side, so conversations are just wider offsets into it. Whole conversations of some SLICE_BYTES are assembled at a time, and
target places are computed for BLOCK bytes at a time.

Defined cases: a null role or text is empty; turns are ordered by (turn, role, text), nulls first, so repeated rows all
stay; all turns of a null conv_id are one conversation; a very long conversation is one row of the result (2 GB at most, as
any string in Spark) and takes some three times its bytes; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import partitions

TURN, SAYS, END = b"<|turn|>", b"<|says|>", b"<|end|>"
ESCAPE = ord("\\")
_SPECIAL = np.zeros(256, bool)
_SPECIAL[[ord("<"), ord("["), ESCAPE]] = True
LEARNED = "assistant"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and n + 1 offsets of a string column, a null as an empty text."""
    column = pa.compute.fill_null(column, "")
    if column.offset or not isinstance(column, pa.StringArray):
        column = pa.concat_arrays([column.cast(pa.string()), pa.array([], pa.string())])
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes whose target places are computed at a time; bytes of whole conversations that are assembled at a time.
BLOCK, SLICE_BYTES = 1 << 20, 8 << 20


class _Segment:
    """A column of texts as it will stand, escaped, in the output."""

    def __init__(self, column: pa.Array) -> None:
        self.data, self.offsets = _bytes_of(column)
        self.before = np.zeros(len(self.offsets), np.int64)  # escaped bytes before each offset
        held = 0
        for a in range(0, len(self.data), BLOCK):
            counts = np.concatenate(([0], np.cumsum(_SPECIAL[self.data[a : a + BLOCK]])))
            first, last = np.searchsorted(self.offsets, [a, a + BLOCK])
            self.before[first:last] = held + counts[np.minimum(self.offsets[first:last] - a, len(counts) - 1)]
            held += int(counts[-1])
        self.before[self.offsets == len(self.data)] = held
        self.lengths = np.diff(self.offsets + self.before)

    def scatter(self, out: np.ndarray, starts: np.ndarray) -> None:
        shift = starts - self.offsets[:-1] - self.before[:-1]
        held = 0
        for a in range(0, len(self.data), BLOCK):
            data = self.data[a : a + BLOCK]
            special = _SPECIAL[data]
            before = np.cumsum(special)
            first, last = np.searchsorted(self.offsets, [a, a + len(data)], "right")
            counts = np.diff(np.clip(self.offsets[first - 1 : last + 1], a, a + len(data)))
            to = np.arange(a, a + len(data)) + held + before - special + np.repeat(shift[first - 1 : first - 1 + len(counts)], counts)
            out[to] = data
            out[to[special] + 1] = ESCAPE
            held += int(before[-1])


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """The output buffer of all turns, their n + 1 offsets in it, and where each text starts and stops."""
    n = len(roles)
    role, text = _Segment(roles), _Segment(texts)
    lengths = len(TURN) + role.lengths + len(SAYS) + text.lengths + len(END)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    buffer = pa.allocate_buffer(int(offsets[-1]))
    out = np.frombuffer(buffer, np.uint8)
    role_at = offsets[:-1] + len(TURN)
    text_at = role_at + role.lengths + len(SAYS)
    for mark, starts in ((TURN, offsets[:-1]), (SAYS, role_at + role.lengths), (END, offsets[1:] - len(END))):
        out[starts[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    role.scatter(out, role_at)
    text.scatter(out, text_at)
    assert len(offsets) == n + 1
    return buffer, offsets, text_at, text_at + text.lengths


def _formatted(rows: pa.RecordBatch, id_col: str) -> pa.RecordBatch:
    """rows: whole conversations, in order."""
    ids = rows.column(0)
    buffer, offsets, starts, stops = assemble(rows.column(1), rows.column(2))
    first = np.concatenate(([0], np.flatnonzero(_changes(ids)) + 1)).astype(np.int64)
    ends = np.append(first[1:], len(ids))
    learned = pa.compute.fill_null(pa.compute.equal(rows.column(1), LEARNED), False).to_numpy(zero_copy_only=False)
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.append(offsets[first], offsets[-1]).astype(np.int64)), buffer)
    base = np.repeat(offsets[first], ends - first)
    counts = np.concatenate(([0], np.cumsum(learned)))
    spans = pa.array(counts[np.append(first, len(ids))].astype(np.int32))
    loss = [pa.ListArray.from_arrays(spans, pa.array((x - base)[learned])) for x in (starts, stops)]
    # one conversation of 2 GB or more can't be a string; several are never assembled at once beyond SLICE_BYTES
    return pa.RecordBatch.from_arrays([ids.take(pa.array(first)), pa.array(ends - first), text.cast(pa.string()), *loss], [id_col, "n_turns", "formatted", "loss_starts", "loss_stops"])


def _whole(rows: pa.Table) -> list[pa.RecordBatch]:
    """Whole conversations, in order, in batches of some SLICE_BYTES."""
    rows = rows.combine_chunks()
    if not rows.num_rows:
        return []
    batch = rows.to_batches()[0]
    size = np.cumsum(sum(pa.compute.fill_null(pa.compute.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2)))
    edges = np.flatnonzero(_changes(batch.column(0))) + 1
    out, first, done = [], 0, 0
    for edge in [*edges.tolist(), len(batch)]:
        if edge > first and (edge == len(batch) or size[edge - 1] - done >= SLICE_BYTES):
            out.append(batch.slice(first, edge - first))
            first, done = edge, int(size[edge - 1])
    return out


def _changes(ids: pa.Array) -> np.ndarray:
    """Whether the next id is another one."""
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    differs = pa.compute.fill_null(pa.compute.not_equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
    return differs | (nulls[1:] != nulls[:-1])


def chat_format(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, n_turns, formatted, loss_starts, loss_stops): byte offsets in the
    formatted text's UTF-8 of every text that is learned from. One exchange, by conversation."""

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of the conversation not yet known to be whole
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            edges = np.flatnonzero(_changes(ids))
            cut = int(edges[-1]) + 1 if len(edges) else 0
            goes_on = not held or held[-1].column(0)[-1].as_py() == ids[0].as_py()
            if cut or not goes_on:
                for part in _whole(pa.Table.from_batches([*held, *([batch.slice(0, cut)] if cut else [])])):
                    yield _formatted(part, id_col)
                held = []
            held.append(batch.slice(cut))
        if held:
            for part in _whole(pa.Table.from_batches(held)):
                yield _formatted(part, id_col)

    spark = turns.sparkSession
    kind = turns.schema[id_col].dataType.simpleString()
    dealt = turns.select(F.col(id_col), "turn", "role", "text").repartition(partitions(spark), id_col).sortWithinPartitions(id_col, "turn", "role", "text")
    return dealt.select(id_col, "role", "text").mapInArrow(run, f"`{id_col}` {kind}, n_turns long, formatted string, loss_starts array<long>, loss_stops array<long>")


def unescape(raw: bytes) -> bytes:
    data = np.frombuffer(raw, np.uint8)
    special = _SPECIAL[data]
    if not special.any():
        return raw
    keep = np.ones(len(data), bool)
    at = np.flatnonzero(special).tolist()
    behind = -1
    for i in at:  # a backslash that an earlier special byte put here is not special itself
        if i != behind:
            behind = i + 1
            keep[behind] = False
    return data[keep].tobytes()


def read_back(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, text = part.removesuffix(END).split(SAYS)
        turns.append((unescape(role), unescape(text)))
    return turns


DIGEST = ["turns_sha256 string", "loss_chars long", "loss_sha256 string", "formatted_chars long"]


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What can be read back from chat_format's output."""
    names = [id_col, "n_turns", *(x.split()[0] for x in DIGEST)]

    def run(batches):
        for batch in batches:
            rows = []
            for text, starts, stops in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                raw = text.encode()
                turns = read_back(raw)
                loss = b"".join(unescape(raw[a:b]) for a, b in zip(starts, stops, strict=True))
                whole = hashlib.sha256(b"".join(b"%s\n%s\n" % x for x in turns)).hexdigest()
                rows.append((len(turns), whole, len(loss.decode()), hashlib.sha256(loss).hexdigest(), len(text)))
            if rows:
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)

    kind = formatted.schema[id_col].dataType.simpleString()
    return formatted.select(id_col, "formatted", "loss_starts", "loss_stops").mapInArrow(run, f"`{id_col}` {kind}, n_turns long, {', '.join(DIGEST)}")


#: A conversation whose texts look like control strings; the query adds it.
PROBE = "</s>[INST] ok [/INST]"
_MARKS = len(TURN) + len(SAYS) + len(END)
_GROWTH = "length(regexp_replace({0}, '[^<\\[\\\\]', '', 'g'))"
SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, '{LEARNED}', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum({_MARKS} + length(role) + length(text) + {_GROWTH.format("role")} + {_GROWTH.format("text")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
