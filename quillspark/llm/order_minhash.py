"""Document fingerprints: Order MinHash.

The k-byte substrings of a text are numbered by occurrence, so that a repeated one counts as often as it stands there.
For each of `sketches` hash functions the `tuple_size` least of them are taken, put back into text order and hashed
together: an entry of the signature is equal for two texts only if they share these substrings in the same order, which
makes the likeness (share of equal entries) fall with edit distance rather than with the set of substrings alone.

Documents are dealt by ranges of ids and go through a worker in descending order, so a document's next one mostly follows
it. The first and the last document of each range are written with their texts, and a second small step pairs the ranges'
borders; nothing of that passes the driver, and the plan is the same for any number of ranges.

Defined cases: a null or empty text counts as one empty substring; a text shorter than k bytes is one substring; a very long
text's substrings are hashed BLOCK at a time; equal texts have equal fingerprints; the order of documents is by id (of any
type that has an order), then text, nulls least; with one document the next is the document itself; repeated rows each have
a row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import by_slice, partitions, slices, written

K, SKETCHES, TUPLE = 8, 32, 2
#: Code points of a text that decide its range among texts of one id.
PREFIX = 64
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SALTS = (np.arange(1, 257, dtype=np.uint64) * _M1 ^ np.uint64(0x94D049BB133111EB)) * _M2 | np.uint64(1)
#: Substrings handled at a time, so that a very long text needs little memory.
BLOCK = 1 << 15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(29))


def numbered(raw: bytes, k: int = K) -> np.ndarray:
    """A hash of each k-byte substring (k up to 8) together with how often it stood in the text before."""
    if len(raw) < k:
        raw = raw.ljust(k, b"\xff")
    data = np.frombuffer(raw, np.uint8)
    n = len(data) - k + 1
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams << np.uint64(8) | data[j : n + j]
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    at = np.arange(n)
    times = np.empty(n, np.uint64)
    times[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _mix(_mix(grams * _M1) + times * _M1)


def signature(raw: bytes, sketches: int = SKETCHES, size: int = TUPLE, k: int = K) -> np.ndarray:
    hashes = numbered(raw, k)
    salts = _SALTS[:sketches, None]
    best = where = None
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK] * salts  # an odd factor: a permutation of 64 bits; its high bits decide
        m = min(size, part.shape[1])
        take = []
        for _ in range(m):
            i = part.argmin(axis=1)
            take.append((i, part[np.arange(sketches), i]))
            part[np.arange(sketches), i] = np.uint64(0xFFFFFFFFFFFFFFFF)
        values, places = np.stack([v for _, v in take], 1), np.stack([i for i, _ in take], 1) + at
        if best is not None:
            values, places = np.concatenate([best, values], 1), np.concatenate([where, places], 1)
            keep = np.argsort(values, axis=1, kind="stable")[:, :size]
            values, places = np.take_along_axis(values, keep, 1), np.take_along_axis(places, keep, 1)
        best, where = values, places
    in_order = np.take_along_axis(best, np.argsort(where, axis=1, kind="stable"), 1)
    out = np.full(sketches, np.uint64(in_order.shape[1]))
    for j in range(in_order.shape[1]):
        out = _mix((out ^ in_order[:, j]) * _M1)
    return out.astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """text, its last third (floor) replaced by the first as many code points of the following one, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


FIELDS = ["n_chars long", "edited_sha256 string", "fingerprint binary", "edited_fingerprint binary", "near_edited double", "near_next double"]
ROW, HEAD, TAIL = 0, 1, 2


def order_minhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketches: int = SKETCHES, size: int = TUPLE, k: int = K) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex digits), near_edited, near_next."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [x.split()[0] for x in FIELDS]
    types = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def fields(text: str, mine: np.ndarray, following: str, its: np.ndarray) -> tuple:
        new = edited(text, following)
        after = signature(new.encode(), sketches, size, k)
        return len(text), hashlib.sha256(new.encode()).hexdigest(), mine.tobytes(), after.tobytes(), likeness(mine, after), likeness(mine, its)

    def in_order(batches):
        """A row for each document but the last; the first and the last one with their texts."""
        number = TaskContext.get().partitionId()
        held = None  # the document that waits for the one behind it

        def rows(out: list[tuple], ids: pa.Array) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            fixed = [pa.array(cols[0], pa.int32()), pa.array([number] * len(out), pa.int32()), pa.array(cols[1], ids), pa.array(cols[2], pa.string())]
            return pa.RecordBatch.from_arrays([*fixed, *(pa.array(c, t) for c, t in zip(cols[3:], types, strict=True))], ["kind", "range", "id", "text", *names])

        none = (None,) * len(names)
        for part in slices(batches):
            out = []
            for key, text in zip(*(part.column(i).to_pylist() for i in range(2)), strict=True):
                text = text or ""
                mine = signature(text.encode(), sketches, size, k)
                out.append((HEAD, key, text, *none) if held is None else (ROW, held[0], None, *fields(held[1], held[2], text, mine)))
                held = key, text, mine
            if out:
                yield rows(out, part.schema.field(0).type)
                ids = part.schema.field(0).type
        if held is not None:
            yield rows([(TAIL, held[0], held[1], *none)], ids)

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ranges = slim.repartitionByRange(partitions(docs.sparkSession), "id", F.substring("text", 1, PREFIX)).sortWithinPartitions(F.desc_nulls_last("id"), F.desc_nulls_last("text"))
    done = written(ranges.mapInArrow(in_order, f"kind int, range int, id {kind}, text string, {', '.join(FIELDS)}"), "ranges")
    heads = done.where(f"kind = {HEAD}").select("range", F.col("text").alias("following"))
    below = F.lag("range").over(Window.orderBy("range"))
    behind = heads.select("range", F.coalesce(below, F.max("range").over(Window.partitionBy())).alias("behind"))  # a row for each range
    tails = done.where(f"kind = {TAIL}").select("range", "id", "text").join(behind, "range").join(heads.withColumnRenamed("range", "behind"), "behind")

    def borders(batch: pa.RecordBatch) -> pa.RecordBatch:
        sign = lambda t: signature(t.encode(), sketches, size, k)
        out = [fields(a, sign(a), b, sign(b)) for a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], ["id", *names])

    last = tails.select("id", "text", "following").mapInArrow(by_slice(borders), f"id {kind}, {', '.join(FIELDS)}")
    digits = [F.lower(F.hex(n)).alias(n) if n.endswith("fingerprint") else F.col(n) for n in names]
    return done.where(f"kind = {ROW}").select("id", *names).unionByName(last).select(F.col("id").alias(id_col), *digits)
