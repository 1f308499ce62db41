"""SimHash near-dedup: deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints with at most two differing bits, one segment
differs by one bit at most; so each segment is indexed whole and with each of its bits masked out, equal index keys bring
candidates together, and the remaining distance is verified. Work is on distinct fingerprints: copies cost one row.
Keys are gone through in sorted order, a batch at a time. Groups of up to SMALL fingerprints under a key are compared by
shifts; larger ones are joined by masking further bits, so that equal masked values prove a link and a spanning forest is
emitted, never all pairs. A key of more than BIG fingerprints goes back to Spark: the other segment is cut in two in its
turn, and the rows are dealt out again by the masked halves, of which none holds more than 2 to the 18 fingerprints.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text of fewer than `width` words is
one shingle; a very long text's shingles are hashed BLOCK at a time; repeated rows share a component; a null doc_id is kept
and never names a component unless all are null; an empty table gives an empty result; further columns are ignored by
near_duplicates and carried along by keep_first, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quillspark.llm import near_copies
from quillspark.llm.common import as_bytes, by_slice, clear_unread, fresh, made, partitions, written
from quillspark.llm.components import components
from quillspark.llm.near_copies import ROWS_EACH, by_key, gathered

WIDTH, SEED, DISTANCE = 3, 42, 2
SMALL = 32
#: Fingerprints under one key beyond which the key is dealt out again.
BIG = 1 << 16
#: Shingles whose hashes are held as bits at a time.
BLOCK = 1 << 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, width: int = WIDTH) -> int:
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = len(words) - width + 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, fp): the 64 bits as a signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(raw, width) for raw in as_bytes(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(by_slice(work, text_col), f"`{id_col}` {kind}, fp long")


def _keyed(fps: DataFrame) -> DataFrame:
    """(key, fp): for each segment the value whole (variant 32) and with each bit masked out (variants 0 to 31)."""
    keys = []
    for segment in range(2):
        value = f"(shiftrightunsigned(fp, {32 * segment}) & 4294967295L)"
        for variant in range(33):
            masked = f"({value} & {~(1 << variant) & 0xFFFFFFFF}L)" if variant < 32 else value
            keys.append(f"({(segment << 6 | variant) << 32}L | {masked})")
    return fps.selectExpr(f"explode(array({', '.join(keys)})) AS key", "fp")


class _Forest:
    """Union-find over row numbers that keeps only edges that join two trees."""

    def __init__(self, n: int) -> None:
        self.root = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def equal(self, keys: np.ndarray) -> None:
        """Joins rows with equal keys."""
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        for a, b in zip(order[:-1][same].tolist(), order[1:][same].tolist(), strict=True):
            x, y = self.top(a), self.top(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.edges.append((a, b))


def _large_group(fps: np.ndarray, variant: int, other: int) -> np.ndarray:
    """Edges (pairs of row numbers) that connect all of fps that link; fps are equal in one segment but for bit `variant`
    (32: equal throughout). other: shift of the other segment. Every key masks two bits at most, so equal keys are links."""
    forest = _Forest(len(fps))
    one = np.uint64(1)
    bits = [one << np.uint64(other + j) for j in range(32)]
    if variant < 32:
        own = ~(one << np.uint64(32 - other + variant))
        for bit in bits:
            forest.equal(fps & own & ~bit)
    else:
        for i in range(32):
            for j in range(i):
                forest.equal(fps & ~(bits[i] | bits[j]))
    return np.array(forest.edges, np.int64).reshape(-1, 2)


def _dense_group(fps: np.ndarray) -> np.ndarray:
    """Edges (pairs of row numbers) that connect all of fps that link, whichever bits they differ in; for few such bits."""
    forest, one = _Forest(len(fps)), np.uint64(1)
    varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [one << np.uint64(i) for i in range(64) if varying >> i & 1]
    if len(bits) <= 2:
        forest.equal(np.zeros(len(fps), np.uint64))
    for i in range(len(bits)):
        for j in range(i):
            forest.equal(fps & ~(bits[i] | bits[j]))
    return np.array(forest.edges, np.int64).reshape(-1, 2)


def _links(keys: np.ndarray, fps: np.ndarray, dense: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among rows with equal keys (sorted); a spanning forest for groups beyond SMALL."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(starts, len(keys)))
    size = np.repeat(counts, counts)
    a, b = [], []
    small = (size > 1) & (size <= SMALL)
    k, f = keys[small], fps[small]
    for shift in range(1, SMALL):
        same = k[shift:] == k[:-shift]
        if not same.any():
            break
        near = same & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= DISTANCE)
        a.append(f[:-shift][near])
        b.append(f[shift:][near])
    for at, n in zip(starts[counts > SMALL], counts[counts > SMALL], strict=True):
        group, kind = fps[at : at + n], int(keys[at] >> np.uint64(32))
        found = _dense_group(group) if dense else _large_group(group, kind & 63, 32 * (1 - (kind >> 6)))
        a.append(group[found[:, 0]])
        b.append(group[found[:, 1]])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([*a, empty]), np.concatenate([*b, empty])


def _gone_through(batches, most: int | None):
    """(a, b, again): links; and (key, fp, true) for the rows of keys with more than `most` of them."""
    row = lambda a, b, again: pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), again))], ["a", "b", "again"])
    if most is None:
        for keys, fps in by_key(batches):
            yield row(*_links(keys.view(np.uint64), fps.view(np.uint64), dense=True), False)
        return
    held, big = [np.zeros(0, np.int64)] * 2, None  # rows of the last key, and the key that is being dealt out again
    for new in gathered(batches):
        now = [np.concatenate(x) for x in zip(held, new, strict=True)]
        keys, fps = now
        start = int(np.searchsorted(keys, big, "right")) if big is not None else 0
        if start:
            yield row(keys[:start], fps[:start], True)
        at = max(start, int(np.searchsorted(keys, keys[-1])))
        yield from _cut(keys[start:at], fps[start:at], most, row)
        held = [x[at:] for x in now]
        if len(held[0]) > most:
            big = held[0][0]
            yield row(*held, True)
            held = [x[:0] for x in held]
    yield from _cut(*held, most, row)


def _cut(keys: np.ndarray, fps: np.ndarray, most: int, row):
    """The links of whole keys, and the rows of those that are too large."""
    if not len(keys):
        return
    counts = np.diff(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))))
    large = np.repeat(counts > most, counts)
    if large.any():
        yield row(keys[large], fps[large], True)
    yield row(*_links(keys[~large].view(np.uint64), fps[~large].view(np.uint64)), False)


def _halves(again: DataFrame) -> DataFrame:
    """(key, fp) for keys that are too large, by the other segment's halves of 16 bits. Under a whole segment the other one
    differs by two bits at most: the halves, whole and with a bit masked. Under a masked one it differs by one bit at most,
    since fingerprints that don't differ in the masked bit meet under the whole segment: the halves, whole."""
    other = "(CASE WHEN shiftrightunsigned(a, 38) = 0 THEN shiftrightunsigned(b, 32) ELSE b END & 4294967295L)"
    keys = []
    for variant in (16, *range(16)):
        for half in range(2):
            value = f"(shiftrightunsigned({other}, {16 * half}) & 65535L)"
            masked = f"({value} & {~(1 << variant) & 0xFFFF}L)" if variant < 16 else value
            keys.append(f"xxhash64(a, {half * 17 + variant}, {masked})")
    whole = "(shiftrightunsigned(a, 32) & 63) = 32"
    return again.selectExpr(f"explode(CASE WHEN {whole} THEN array({', '.join(keys)}) ELSE array({', '.join(keys[:2])}) END) AS key", "b AS fp")


def links(fps: DataFrame, most: int = BIG) -> DataFrame:
    """(a, b): enough of the linked pairs of distinct fingerprints to connect all that link. fps: a written table."""
    spark = fps.sparkSession

    def dealt(keyed: DataFrame, rows: int, bound: int | None) -> DataFrame:
        parts = max(partitions(spark), rows // ROWS_EACH)
        return keyed.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(lambda batches: _gone_through(batches, bound), "a long, b long, again boolean")

    found = written(dealt(_keyed(fps), 66 * fps.count(), most), "links")
    again = found.where("again")
    edges = found.where("NOT again").select("a", "b")
    if more := again.count():
        edges = edges.union(dealt(_halves(again), 34 * more, None).select("a", "b"))
    return edges


def _named(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, first, component) from (fp, first): component is the least fingerprint reachable by edges."""
    named = components(edges).withColumnRenamed("node", "fp")
    return distinct.join(named, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (smallest id reachable by links)."""
    found = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = written(found.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    whole = _named(distinct, links(distinct.select("fp")))
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = whole.join(least, "component").select("fp", "component_id")
    return found.join(by_fp, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, null ids last, and among rows of that id
    the first by a hash of the text. Besides near_duplicates' links, texts of like sets of 5-word shingles (near_copies)
    are linked. Rows are told apart by id and text, so that ids may be null or repeated. Of the tables that were written on
    the way, only those stay that the result reads."""
    older = made()
    # ids as a pair without nulls; single columns at the end, since a struct is cast, and so dealt out again, for a join
    key = F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col), F.lit(0).cast(docs.schema[id_col].dataType)).alias("id"), F.xxhash64(text_col).alias("hash"))
    named = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    sigs = [f"w{k}" for k in range(near_copies.WORDS)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(1))
        fps = np.array([fingerprint(raw, width) for raw in texts], np.uint64)
        n, wide = [], np.zeros((len(texts), near_copies.WORDS), np.uint64)
        for i, raw in enumerate(texts):
            held = near_copies.shingles(raw)
            n.append(len(held))
            wide[i] = near_copies.wide(held)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), pa.array(n, pa.int64()), *(pa.array(np.ascontiguousarray(w).view(np.int64)) for w in wide.T)], ["key", "fp", "n", *sigs])

    kind = named.schema["key"].dataType.simpleString()
    found = written(named.mapInArrow(by_slice(work, "text"), f"key {kind}, fp long, n long, {', '.join(f'{w} long' for w in sigs)}"), "fingerprints")
    nodes = written(found.where("n > 0").groupBy("fp", "n", *sigs).agg(F.min("key.hash").alias("node")), "nodes")
    distinct = written(found.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    texts = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
    fp_of = nodes.select("node", "fp")

    def placed(parts: DataFrame) -> DataFrame:
        return nodes.join(parts, "fp", "left").withColumn("part", F.coalesce("part", "fp"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Edges between the fingerprints of pairs of texts that are verified to be alike."""
        near = near_copies.verified(pairs, texts)
        return near.join(fp_of.toDF("a", "fp_a"), "a").join(fp_of.toDF("b", "fp_b"), "b").where("fp_a <> fp_b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))

    def like(parts: DataFrame, masks: np.ndarray) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Edges across the components of parts(fp, part), the pairs that were verified for them, and what is left to
        go through, (key, node)."""
        found = near_copies.candidates(written(placed(parts), "placed"), masks)
        pairs = written(found.where("NOT again").select("a", "b").distinct(), "pairs")
        return linked(pairs), pairs, found.where("again").selectExpr("a AS key", "b AS node")

    none = fp_of.limit(0).select("fp", F.col("fp").alias("part"))
    edges, pairs, again = like(none, near_copies.MASKS[: near_copies.FIRST])
    edges = written(links(distinct.select("fp")).union(edges), "edges")
    parts = components(edges).toDF("fp", "part")
    edges, pairs_2, again_2 = like(parts, near_copies.MASKS[near_copies.FIRST :])
    edges = written(parts.union(edges).toDF("a", "b"), "edges")
    again = again.union(again_2)
    if not again.isEmpty():
        parts = components(edges).toDF("fp", "part")
        more = near_copies.overlapping(again, placed(parts), texts).join(pairs.union(pairs_2), ["a", "b"], "left_anti")
        edges = parts.union(linked(written(more, "pairs"))).toDF("a", "b")
    whole = _named(distinct, edges)
    *own, nth = fresh(docs, "none", "id", "hash", "nth")
    heads = whole.groupBy("component").agg(F.min("first").alias("first")).select(*(F.col(f"first.{part}").alias(name) for part, name in zip(("none", "id", "hash"), own, strict=True)))
    order = F.row_number().over(Window.partitionBy(*own).orderBy(text_col))
    keyed = docs.select("*", key.alias(nth)).select(*(F.col(f"`{c}`") for c in docs.columns), *(F.col(f"{nth}.{part}").alias(name) for part, name in zip(("none", "id", "hash"), own, strict=True)))
    first = keyed.withColumn(nth, order).where(F.col(nth) == 1)  # cut by a group limit before the exchange
    return clear_unread(first.join(heads, own, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns)), older)
