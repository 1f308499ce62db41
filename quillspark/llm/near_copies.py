"""Near copies by SimHash over many masks: pairs of texts whose sets of 5-word shingles have similarity 0.8 or more.

At similarity 0.8 some 15 % of the bits of two SimHashes differ, too many for two segments. So a wide SimHash of 256 bits
is indexed under TABLES masks that each leave BITS of its bits; equal masked values bring candidates together. Candidates
are verified by their sets of shingles, so every link is a true one; what is missed is what shares no masked value.
Groups of up to SMALL texts under a key give all their pairs; in larger ones a leader is linked to all texts that may be
like it, and what is left chooses the next leader, so that a group of copies doesn't give all its pairs.

There are three rounds: the first few masks bring large groups of near copies together, and what they join counts as one
component in the second round, which only looks for pairs across components. A follower that proves unlike its leader may
still be like another one; so the third round goes through the texts of the larger groups again (`overlapping`). There
texts meet by the rarest of their shingles, since two that are like enough share one of these; what a group of near copies
has in common is frequent and brings nothing together, so texts that are a little too far apart don't give all their pairs.
The bounds are exact: no pair under a common key is left unlinked for the size of its group.
"""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quillspark.llm.common import as_bytes, by_slice, partitions, written

WIDTH, SIMILARITY, SEED = 5, 0.8, 42
WORDS, TABLES, BITS = 4, 160, 24
#: Masks of the first round.
FIRST = 16
#: Masks whose keys are dealt out at a time, so that the exchange takes little disk.
ALONG = 36
#: Nodes to which a broadcast is bound: texts that few pairs need are then found without an exchange of all texts.
FEW = 1 << 19
#: Keys that one task sorts and goes through.
ROWS_EACH = 4_000_000
SMALL = 16
#: Texts meet in classes of size, each so many times as large as the one before.
CLASS = 1.05
#: Of the first 64 bits, so many may differ between candidates: 3.6 standard deviations above the mean at SIMILARITY.
FAR = 20
BLOCK = 1 << 14
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def _masks() -> np.ndarray:
    rng, out = random.Random(SEED), np.zeros((TABLES, WORDS), np.uint64)
    for row in out:
        for bit in rng.sample(range(64 * WORDS), BITS):
            row[bit >> 6] |= np.uint64(1 << (bit & 63))
    return out


MASKS = _masks()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, a text without words has none."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= WIDTH:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(stops[: len(words) - WIDTH] + 1).tolist()]
    return np.unique(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops[WIDTH - 1 :].tolist(), strict=True)], np.uint64))


def wide(hashes: np.ndarray) -> np.ndarray:
    """WORDS numbers of 64 bits."""
    counts = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        for k in range(WORDS):
            bits = np.unpackbits(mixed(part + np.uint64((k + 1) * int(_C1) & (1 << 64) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[k] += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > len(hashes), axis=1, bitorder="little").view("<u8").ravel()


def _keyed(nodes: DataFrame, masks: np.ndarray, first: int = 0) -> DataFrame:
    """(key, node, sig, n, part) for each mask, numbered from first; part is the node's component."""
    many = len(masks)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                node, n, component, *sigs = (part.column(i).to_numpy() for i in range(3 + WORDS))
                sigs = np.array(sigs).view(np.uint64)
                keys = np.zeros((many, len(node)), np.uint64)
                for t, mask in enumerate(masks):
                    for k in range(WORDS):
                        keys[t] = mixed(keys[t] + (sigs[k] & mask[k]) * _ODD[k] + np.uint64(first + t + 1))
                repeat = lambda x: pa.array(np.tile(x, many))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), repeat(node), repeat(sigs[0].view(np.int64)), repeat(n.astype(np.int32)), repeat(component)], ["key", "node", "sig", "n", "part"])

    return nodes.select("node", "n", "part", *(f"w{k}" for k in range(WORDS))).mapInArrow(run, "key long, node long, sig long, n int, part long")


def _alike(sa, na, sb, nb) -> np.ndarray:
    return (np.bitwise_count(sa ^ sb) <= FAR) & (np.minimum(na, nb) >= SIMILARITY * np.maximum(na, nb))


def _crowded(keys: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The rows of keys with more than SMALL rows, of more than one component."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(starts, len(keys)))
    mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
    return np.flatnonzero(np.repeat((counts > SMALL) & mixed, counts))


def _pairs(keys: np.ndarray, nodes: np.ndarray, sigs: np.ndarray, n: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Pairs of nodes of different components under one key: in groups of up to SMALL all that may be alike, in larger ones
    (_crowded) those with a leader. Rows are sorted by (key, node)."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(starts, len(keys)))
    size = np.repeat(counts, counts)
    out = [np.zeros((0, 2), np.int64)]
    rows = np.flatnonzero((size > 1) & (size <= SMALL))
    for shift in range(1, SMALL):
        a, b = rows[:-shift], rows[shift:]
        same = keys[a] == keys[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        near = _alike(sigs[a], n[a], sigs[b], n[b]) & (part[a] != part[b])
        out.append(np.stack([nodes[a[near]], nodes[b[near]]], axis=1))
    for at, many in zip(starts[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True):
        left = np.arange(at, at + many)
        while len(left) > 1 and (part[left] != part[left[0]]).any():
            first, left = left[0], left[1:]
            near = _alike(sigs[first], n[first], sigs[left], n[left])
            found = left[near & (part[left] != part[first])]
            out.append(np.stack([np.full(len(found), nodes[first]), nodes[found]], axis=1))
            left = left[~near]
    return np.unique(np.concatenate(out), axis=0)


def candidates(nodes: DataFrame, masks: np.ndarray = MASKS) -> DataFrame:
    """(a, b, again): pairs a < b of nodes of different components that may be near copies, and, where again, (key, node)
    for the rows of keys that `overlapping` has to go through. nodes: (node, n, part, w0 to w3), a row for each node, written.
    Keys are gone through in order, so a task holds a batch and one key's rows; the result is written, for ALONG masks at a time."""

    def run(batches):
        row = lambda a, b, again: pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b)), pa.array(np.full(len(a), again))], ["a", "b", "again"])
        for keys, node, sigs, n, part in by_key(batches):
            found = _pairs(keys, node, sigs.view(np.uint64), n, part)
            if len(found):
                yield row(found[:, 0], found[:, 1], False)
            more = _crowded(keys, part)
            if len(more):
                yield row(keys[more], node[more], True)

    spark, many, out = nodes.sparkSession, nodes.count(), []
    for at in range(0, len(masks), ALONG):
        some = masks[at : at + ALONG]
        parts = max(partitions(spark), many * len(some) // ROWS_EACH)
        keyed = _keyed(nodes, some, at).repartition(parts, "key").sortWithinPartitions("key", "node")
        out.append(written(keyed.mapInArrow(run, "a long, b long, again boolean").distinct(), "candidates"))
    return reduce(DataFrame.union, out)


def _across(rows: DataFrame, keys: list[str], more: list[str], alike: str) -> DataFrame:
    """(a, b), a < b: the pairs of nodes of different components, with equal keys, for which `alike` holds. rows: keys, node,
    part and the columns `more`; alike speaks of a row's columns and, with _x behind their names, of another row's that is
    outside the largest component of its keys; main is that component. The other row is of any component, so that members
    of the largest one don't meet each other. A join, which Spark splits where a key is large."""
    sizes = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("many"))
    main = sizes.groupBy(*keys).agg(F.max(F.struct("many", "part")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1").selectExpr(*keys, "most.part AS main")
    left = rows.join(main, keys).where("part <> main").select(*keys, "main", *(F.col(c).alias(f"{c}_x") for c in ("node", "part", *more)))
    pairs = left.join(rows, keys).where(f"part <> part_x AND {alike}")
    return pairs.select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b")).distinct()


def remaining(again: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of nodes of different components under one key that may be near copies. again: (key, node).
    nodes: (node, n, part, w0). As many as the square of a group's size: the plain form of overlapping, which needs no texts."""
    rows = written(again.join(nodes.select("node", "n", "part", F.col("w0").alias("sig")), "node"), "crowded")
    return _across(rows, ["key"], ["n", "sig"], f"(part = main OR node > node_x) AND bit_count(sig ^ sig_x) <= {FAR} AND least(n, n_x) >= {SIMILARITY}D * greatest(n, n_x)")


def _reach(n: str, other: str) -> str:
    """SQL for the number of rarest shingles of a text of n among which is one that it shares with a like text of `other`:
    all but one less than they must share. A rounding error makes it larger, which loses nothing."""
    return f"{n} - ceil({SIMILARITY / (1 + SIMILARITY)!r}D * ({n} + {other}) - 1e-6D) + 1"


def overlapping(again: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs of nodes of different components, among them all that are near copies and under one key of
    again(key, node). nodes: (node, n, part). texts: (node, text), rows of one node have one text.

    Shingles are ordered from the rarest, in one order for all texts. If two texts are like enough, the first shingle that
    they share stands so early in both (_reach) that enough may follow. The shorter text is found by what it has up to
    there for a text of its own size or more, in its class of size; the longer one looks it up in each class that it may
    be in, by what it has up to there for that class."""
    rows = again.join(nodes.select("node", "part"), "node")
    crowded = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    need = written(rows.join(crowded, "key", "left_semi").select("node", "part").distinct(), "crowded")
    held = _sets(need.select("node"), texts).join(need, "node").select("node", "part", F.size("held").alias("n"), F.explode("held").alias("shingle"))
    found = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("many"), (F.min("part") != F.max("part")).alias("across"))
    at = F.row_number().over(Window.partitionBy("node").orderBy("many", "shingle"))
    least = f"ceil({SIMILARITY}D * n - 1e-6D)"
    early = held.join(found, "shingle").withColumn("at", at).where(f"across AND at <= {_reach('n', least)}")
    size = lambda n: f"CAST(floor(ln({n}) / ln({CLASS}D)) AS INT)"
    of_class = f"greatest({least}, CAST(floor(pow({CLASS}D, class) * (1 - 1e-9D)) AS BIGINT))"
    short = early.where(f"at <= {_reach('n', 'n')}").select("*", F.expr(size("n")).alias("class"), F.lit(True).alias("short"))
    long = early.select("*", F.explode(F.expr(f"sequence({size(least)}, {size('n')})")).alias("class"), F.lit(False).alias("short")).where(f"at <= {_reach('n', of_class)}")
    met = written(short.union(long).select("shingle", "class", "short", "node", "part", "n", "at"), "early")
    sides = "short <> short_x AND (part = main OR short_x) AND IF(short, n <= n_x, n_x <= n)"
    return _across(met, ["shingle", "class"], ["short", "n", "at"], f"{sides} AND at <= {_reach('n', 'n_x')} AND at_x <= {_reach('n_x', 'n')}")


def gathered(batches, rows: int = 1 << 17):
    """The columns of some batches at a time, together of `rows` rows or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield [np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(batch.num_columns)]
            held, n = [], 0
    if n:
        yield [np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(held[0].num_columns)]


def by_key(batches):
    """The columns of batches sorted by the first one, cut between keys: the last key's rows wait for what comes next."""
    held = None
    for now in gathered(batches):
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        at = int(np.searchsorted(now[0], now[0][-1]))
        if at:
            yield [x[:at] for x in now]
        held = [x[at:] for x in now]
    if held is not None:
        yield held


def _sets(need: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, held): the shingles of each node of need, which is written. texts: (node, text), rows of one node have one text."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(raw).view(np.int64) for raw in as_bytes(batch.column(1))], pa.list_(pa.int64()))], ["node", "held"])

    one = texts.join(F.broadcast(need) if need.count() <= FEW else need, "node", "left_semi").dropDuplicates(["node"])
    return written(one.select("node", "text").mapInArrow(by_slice(cut), "node long, held array<long>"), "shingles")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose shingles are like enough. texts: (node, text), rows of one node have one text."""
    sets = _sets(written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "need"), texts)
    both = pairs.join(sets.selectExpr("node AS a", "held AS held_a"), "a").join(sets.selectExpr("node AS b", "held AS held_b"), "b")

    def run(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(shared >= SIMILARITY * (len(x) + len(y) - shared) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return both.select("a", "b", "held_a", "held_b").mapInArrow(run, "a long, b long")
