"""Packing: shortest-pack-first over the length histogram.

Each document's token ids and an end id are cut into pieces of at most `size`. Lengths are placed longest first, each
into the packing patterns with most room left; only counts of patterns change, so the plan costs the same for any
number of documents. Pieces then find their place by rank among the pieces of their length.

Defined cases: a null or empty text is the end id alone; <|endoftext|> in a text is one token, as in the file; repeated rows are packed once each; ties in rank are broken by
all of a piece's columns; a null doc_id is an id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import by_slice, written

SIZE, END = 2048, 1
#: The special token of byte_bpe_50k.json.
MARKER, MARKER_ID = "<|endoftext|>", 50256
#: Pieces that share a bucket for ranking.
BUCKET_ROWS = 50_000


class Tokens:
    """Ids of the byte-level BPE. tiktoken runs the vocabulary of byte_bpe_50k.json (the same ranks, ids and pattern, some
    five times as fast); texts that it can't take go through tokenizers with the file itself. Special strings in a text
    are ordinary text here."""

    def __init__(self, json_path: str | None = None, ranks_path: str | None = None) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        self.json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = None

    def __call__(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as fault:  # noqa: BLE001  a Rust panic is no Exception, and its class can't be imported
            if type(fault).__name__ != "PanicException":
                raise
            return self.slow(text)

    def slow(self, text: str) -> list[int]:
        from tokenizers import Tokenizer

        if self.whole is None:
            self.whole = Tokenizer.from_file(self.json_path)
            self.whole.encode_special_tokens = True
        return self.whole.encode(text, add_special_tokens=False).ids


class FileTokens(Tokens):
    """Ids as the file's own settings give them: its one special string is a token of its own, before anything else is cut."""

    def __call__(self, text: str) -> list[int]:
        if MARKER not in text:
            return super().__call__(text)
        first, *others = text.split(MARKER)
        ids = list(super().__call__(first))
        for part in others:
            ids.append(MARKER_ID)
            ids.extend(super().__call__(part))
        return ids


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END, tokens=FileTokens) -> DataFrame:
    """Pieces of each document: start, length, ids_crc32 (of little-endian unsigned 32-bit ids), doc_tokens."""
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches):
        encode = tokens()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), end], "<u4")
                n = len(ids)
                rows.extend((i, a, min(size, n - a), zlib.crc32(ids[a : a + size].tobytes()), n) for a in range(0, n, size))
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

        return by_slice(work, text_col)(batches)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(count, lengths longest first) of packs that hold every length as often as the histogram says."""
    open_packs: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = size
        while left > 0:
            while room >= length and not open_packs[room]:
                room -= 1
            if room < length:
                open_packs[size - length].append((left, [length]))
                break
            count, pack = open_packs[room].pop()
            used = min(count, left)
            if count > used:
                open_packs[room].append((count - used, pack))
            open_packs[room - length].append((used, [*pack, length]))
            left -= used
    return [x for room in sorted(open_packs) for x in open_packs[room]]


def slots(plan: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For ranks of each length: arrays sorted by (length, first rank) with the pattern's first sequence, offset and how
    often the pattern holds the length."""
    rows, taken, sequence = [], defaultdict(int), 0
    for count, pack in plan:
        offset = 0
        for length in sorted(set(pack), reverse=True):
            m = pack.count(length)
            rows.append((length, taken[length], sequence, offset, m))
            taken[length] += count * m
            offset += m * length
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "offset", "times"), table.T, strict=True))


def placed(ranked: DataFrame, id_col: str, where: dict[str, np.ndarray]) -> DataFrame:
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    base = np.int64(1) << 40  # above any rank within a length
    keys = where["length"] * base + where["rank"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "rank"))
            at = np.searchsorted(keys, length * base + rank, "right") - 1
            instance, again = np.divmod(rank - where["rank"][at], where["times"][at])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(where["sequence"][at] + instance), pa.array(where["offset"][at] + again * length)], names)

    kind = ranked.schema[id_col].dataType.simpleString()
    return ranked.select(*names[:5], "rank").mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END, tokens=FileTokens) -> DataFrame:
    """Pieces with sequence_id and offset. Texts are tokenised once and never shuffled; the histogram (at most `size`
    lengths) is all that reaches the driver; ranks come from counts by bucket, so a frequent length is shared by many tasks."""
    cut = written(pieces(docs, id_col, text_col, size, end, tokens), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = patterns(histogram, size)
    buckets = max(16, sum(histogram.values()) // BUCKET_ROWS)
    named = cut.withColumn("bucket", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = (
        named.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(id_col, "start", "ids_crc32", "doc_tokens"))
    ranked = named.withColumn("within", within).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within") - 1)
    return placed(ranked, id_col, slots(plan))
