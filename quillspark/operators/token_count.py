"""Token counts by a byte-pair vocabulary.

A text is cut into words by the vocabulary's pattern, in the JVM. Byte pairs are merged by rank for each distinct word, once
for the whole table, and the counts are joined back to the words of each text and summed: a frequent word costs no more
than a rare one. Ranks are read as a table (lines of a token in base 64 and its rank, the form that public vocabularies
have) and sent to the workers; their number is checked.

Defined cases: null and empty texts have 0 tokens; rows of equal keys are rows each; words of any length are merged whole, in
time that grows with n log n; bytes that the vocabulary lacks count as one token each; special strings are ordinary text.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.tables import written

#: Fixed value: how the public byte-level vocabularies cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens of a vocabulary at most.
MOST_RANKS = 1_000_000


def merged(word: bytes, ranks: dict[bytes, int]) -> int:
    """How many tokens are left when of all neighbouring pairs the one of least rank, of equal ones the first, is merged
    until no pair is in the vocabulary."""
    if word in ranks:
        return 1
    n = len(word)
    end, before, left = list(range(1, n + 1)), list(range(-1, n - 1)), n  # a part is known by its start
    pairs = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(pairs)
    while pairs:
        _, i, stop = heappop(pairs)
        if end[i] < 0 or end[i] >= n or end[end[i]] != stop:
            continue  # one of its parts has been merged since
        gone = end[i]
        end[i], end[gone] = stop, -1
        left -= 1
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heappush(pairs, (r, i, end[stop]))
        if before[i] >= 0 and (r := ranks.get(word[before[i] : stop])) is not None:
            heappush(pairs, (r, before[i], stop))
    return left


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A vocabulary of at most MOST_RANKS tokens."""
    parts = F.split("value", " ")
    rows = spark.read.text(path).where("value <> ''").select(F.get(parts, F.lit(0)).alias("token"), F.get(parts, F.lit(1)).cast("int").alias("rank")).limit(MOST_RANKS + 1).collect()
    if len(rows) > MOST_RANKS:
        raise ValueError(f"{path} has more than {MOST_RANKS} tokens")
    return {base64.b64decode(r["token"]): r["rank"] for r in rows}


def word_tokens(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(word, tokens) of distinct words."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            yield pa.RecordBatch.from_arrays([column, pa.array([merged(w, shared.value) for w in column.cast(pa.binary()).to_pylist()], pa.int32())], ["word", "tokens"])

    return words.select("word").mapInArrow(run, "word string, tokens int")


def token_counts(rows: DataFrame, key: str, content: str, ranks_path: str, pattern: str = PATTERN) -> DataFrame:
    """(key, n_tokens) of each row."""
    words = F.regexp_extract_all(content, F.lit(f"(?U){pattern}"), F.lit(0))
    distinct = rows.select(F.explode(words).alias("word")).distinct()
    known = written(word_tokens(distinct, read_ranks(rows.sparkSession, ranks_path)), "word-tokens")
    numbered = rows.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), words.alias("_words"))
    each = numbered.select("_key", "_row", F.explode_outer("_words").alias("word"))
    found = each.join(known, "word", "left").groupBy("_row", "_key").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n_tokens"))
    return found.select(F.col("_key").alias(key), "n_tokens")
