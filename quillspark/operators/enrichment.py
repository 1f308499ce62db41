"""Categories, summaries and vectors of blocks, through strategies that can be replaced."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.functions.vectors import cosine_similarity

#: Category of what nothing else fits.
OTHER = 0


def by_keywords(content: Column, keywords: dict[int, list[str]]) -> Column:
    """Sorted ids of the categories of which a word stands in the text; [OTHER] if none does."""
    low = F.lower(F.coalesce(content, F.lit("")))
    hits = (F.when(reduce(or_, (low.contains(w) for w in words)), F.lit(i)) for i, words in sorted(keywords.items()))
    return normalised(F.array_compact(F.array(*hits)))


def has_category(content: Column, keywords: dict[int, list[str]], wanted: list[int]) -> Column:
    """Whether by_keywords() would find one of the wanted categories; the text is lower-cased once."""
    words = [w for i in wanted for w in keywords[i]]
    return F.exists(F.array(F.lower(F.coalesce(content, F.lit("")))), lambda low: reduce(or_, (low.contains(w) for w in words)))


def normalised(ids: Column, known: list[int] | None = None) -> Column:
    """ids without those that no category has, [OTHER] for null and empty."""
    kept = ids if known is None else F.filter(ids, lambda x: x.isin(known))
    return F.coalesce(F.nullif(kept, F.array().cast("array<int>")), F.array(F.lit(OTHER)))


def names_of(ids: Column, names: dict[int, str]) -> Column:
    """Names of the ids, in their order; unknown ids are dropped."""
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.filter(F.transform(ids, lambda i: known[i]), lambda x: x.isNotNull())


def classify(rows: DataFrame, key: str, block: str, ordinal: str, content: str, strategy: Callable[[Column], Column], names: dict[int, str]) -> DataFrame:
    """rows with the categories of their whole block (texts in order, joined)."""
    joined = rows.groupBy(key, block).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(ordinal, content))), lambda s: s[content]), "\n\n").alias("_text"))
    ids = joined.select(key, block, normalised(strategy(F.col("_text")), list(names)).alias("classification_ids"))
    return rows.join(ids.withColumn("classification_names", names_of(F.col("classification_ids"), names)), [key, block], "left")


def classify_in_order(rows: DataFrame, key: str, block: str, content: str, strategy: Callable[[Column, Column], Column], known: list[int], n: int = 2) -> DataFrame:
    """(key, block, classification_ids): the strategy sees a text and the categories of up to n blocks before it, oldest
    first. A fold over a key's blocks in the JVM; the blocks of a key are held as one row."""
    kind = rows.schema[block].dataType.simpleString()
    held = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(block, content))).alias("_held"))

    def step(done: Column, x: Column) -> Column:
        before = F.transform(F.filter(done, lambda _, i: i >= F.size(done) - n), lambda d: d["ids"])
        return F.concat(done, F.array(F.struct(x[block].alias("block"), normalised(strategy(x[content], before), known).alias("ids"))))

    start = F.array().cast(f"array<struct<block:{kind},ids:array<int>>>")
    found = held.select(key, F.explode(F.aggregate("_held", start, step)).alias("_found"))
    return found.select(key, F.col("_found.block").alias(block), F.col("_found.ids").alias("classification_ids"))


def lead_summary(content: Column, n: int = 200) -> Column:
    """Extractive: the first sentence, or the first n characters."""
    sentence = text.none_if_blank(F.regexp_extract(content, r"(?s)^(.{1,%d}?[.!?])(\s|$)" % n, 1))
    return F.coalesce(sentence, text.preview(content, n))


def summarise(blocks: DataFrame, key: str, block: str, content: str, strategy: Callable[[Column, Column], Column] = lambda c, _: lead_summary(c), n: int = 2) -> DataFrame:
    """block_summary by a strategy that sees the text and up to n previews (300 characters) before it; null stays null."""
    w = Window.partitionBy(key).orderBy(block).rowsBetween(-n, -1)
    before = F.collect_list(text.preview(F.col(content), 300)).over(w)
    return blocks.withColumn("block_summary", strategy(F.col(content), before))


def template_summary(speaker: Column, content: Column, n: int = 100) -> Column:
    return F.concat(F.coalesce(speaker, F.lit("Unknown Speaker")), F.lit(": "), text.preview(content, n))


def hash_embedder(width: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Deterministic unit vectors from hashed words; for tests and as a stand-in for a service."""

    def embed(texts: list[str]) -> np.ndarray:
        number: dict[str, int] = {}  # each distinct word is hashed once
        found = [[number.setdefault(w, len(number)) for w in content.lower().split()] for content in texts]
        hashes = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in number], np.uint64)
        slot, sign = (hashes % np.uint64(width)).astype(np.int64), np.where(hashes >> np.uint64(63), 1.0, -1.0)
        out = np.zeros((len(texts), width), np.float32)
        for row, words in enumerate(found):
            out[row] = np.bincount(slot[words], sign[words], width)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)

    return embed


def embed(rows: DataFrame, key: str, content: str, strategy: Callable[[list[str]], np.ndarray], batch: int = 50) -> DataFrame:
    """(key, embedding): the strategy gets up to `batch` texts at a time; a batch that fails, and a null text, is null."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                have = part[part[content].notna()]
                try:
                    found = dict(zip(have.index, strategy(have[content].tolist()), strict=True)) if len(have) else {}
                except (ValueError, RuntimeError, OSError):
                    found = {}
                yield pd.DataFrame({key: part[key], "embedding": [found.get(i) for i in part.index]})

    return rows.select(key, content).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def nearest(vectors: DataFrame, key: str, vector: str, query: list[float], n: int = 50, digits: int = 6) -> DataFrame:
    """The n most similar by cosine, ties by key: an exact scan that ends in a bounded top-n."""
    q = F.array(*(F.lit(float(x)) for x in query))
    score = F.round(cosine_similarity(F.col(vector), q), digits)
    return vectors.withColumn("similarity", score).orderBy(F.col("similarity").desc_nulls_last(), key).limit(n)


def check_vectors(rows: DataFrame, vector: str, width: int) -> DataFrame:
    """Rows whose vector is missing or not of the width."""
    return rows.where(F.col(vector).isNull() | (F.size(vector) != width))
