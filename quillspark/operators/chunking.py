"""Token-bounded chunks of ordered pieces of text, and a splitter for single long texts."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quillspark.functions import text

#: A block up to so many tokens stays whole; target of a chunk; a tail below that joins the one before.
WHOLE, TARGET, TAIL = 1000, 500, 300


def _starts(tokens: Column, header_tokens: Column, target: int) -> Column:
    """Where chunks begin (from 1): a piece starts a new one if it would take a chunk that holds one beyond the target. A
    fold over the block's own array, which grows by chunks, not by pieces."""
    start = F.struct(F.array(F.lit(1)).alias("starts"), F.lit(0).alias("at"), header_tokens.cast("int").alias("now"), F.lit(0).alias("held"))

    def step(s: Column, t: Column) -> Column:
        full = (s["now"] + t > target) & (s["held"] > 0)
        at = s["at"] + 1
        return F.struct(F.when(full, F.array_append(s["starts"], at)).otherwise(s["starts"]).alias("starts"), at.alias("at"), F.when(full, header_tokens + t).otherwise(s["now"] + t).cast("int").alias("now"), F.when(full, 1).otherwise(s["held"] + 1).alias("held"))

    return F.aggregate(tokens, start, step, lambda s: s["starts"])


def chunks(blocks: DataFrame, keys: list[str], header: Column, pieces: str, glue: str = "\n\n", whole: int = WHOLE, target: int = TARGET, tail: int | None = TAIL) -> DataFrame:
    """blocks with an ordered array of texts -> keys, chunk_id, total_chunks, chunk_tokens, chunk_content, first_piece,
    last_piece, block_level_chunk. A block within `whole` tokens is one chunk. tail: a last chunk below so many tokens
    joins the one before; None leaves it. A single piece beyond the target is never cut. Blank pieces are dropped first."""
    filled = blocks.withColumn("_ps", F.filter(pieces, lambda p: F.coalesce(F.trim(p) != "", F.lit(False)))).where("size(_ps) > 0").withColumn("_head", header)
    formatted = lambda ps: F.rtrim(F.concat(F.col("_head"), F.array_join(ps, glue)))
    sized = filled.withColumn("_all", text.token_estimate(formatted(F.col("_ps")))).withColumn("_toks", F.transform("_ps", text.token_estimate))
    planned = sized.withColumn("_starts", F.when(F.col("_all") <= whole, F.array(F.lit(1))).otherwise(_starts(F.col("_toks"), text.token_estimate(F.col("_head")), target)))
    if tail is not None:
        last = F.element_at("_starts", -1)
        ends = F.slice("_ps", last, F.size("_ps") - last + 1)
        short = (F.size("_starts") > 1) & (text.token_estimate(formatted(ends)) < tail)
        planned = planned.withColumn("_starts", F.when(short, F.slice("_starts", 1, F.size("_starts") - 1)).otherwise(F.col("_starts")))
    # every row has a start; the outer form keeps the optimiser from a filter `size(_starts) > 0` with the fold written out in it
    cut = planned.select(*keys, "_head", "_ps", "_starts", F.size("_starts").alias("total_chunks"), (F.col("_all") <= whole).alias("block_level_chunk"), F.posexplode_outer("_starts").alias("_at", "_first"))
    behind = F.coalesce(F.get("_starts", F.col("_at") + 1), F.size("_ps") + 1)
    content = formatted(F.slice("_ps", F.col("_first"), behind - F.col("_first")))
    return cut.select(*keys, (F.col("_at") + 1).alias("chunk_id"), "total_chunks", content.alias("chunk_content"), F.col("_first").alias("first_piece"), (behind - 1).alias("last_piece"), "block_level_chunk").withColumn("chunk_tokens", text.token_estimate(F.col("chunk_content")))


def speaker_header(speaker: Column) -> Column:
    return F.concat(F.lit("["), speaker, F.lit("]\n\n"))


def group_header(group: Column) -> Column:
    return F.concat(F.lit("[Q&A Group "), group.cast("string"), F.lit("]\n\n"))


def estimate(content: str) -> int:
    """token_estimate() of one text."""
    found = content.split()
    return int((len(" ".join(found)) / 3.5 * 0.5 + len(content) / 4 * 0.3 + len(found) * 1.3 * 0.2) * 1.1) if content else 0


_END = re.compile(r"[.!?]\s+")


def boundary(content: str, at: int, reach: int = 50, first: int = 0) -> int:
    """Where to cut near `at`: the end of a sentence within reach (not before `first`), the nearest one, of two the earlier;
    else behind the next space; else there."""
    low = max(first, at - reach)
    ends = [low + m.end() for m in _END.finditer(content[low : at + reach])]
    if ends:
        return min(ends, key=lambda e: (abs(e - at), e))
    space = content.find(" ", at)
    return space + 1 if space >= 0 else at


def split_text(content: str, most: int = TARGET, least: int = TAIL) -> Iterator[tuple[str, int]]:
    """(text, tokens) of about `most` tokens, cut at sentences where they are near. A part beyond 1.2 times `most` is cut
    10 % shorter again; a last part below `least` joins the one before with a space. What is left is measured by running
    counts of words, so the work grows with the length."""
    content, out = content.strip(), []
    words = [(m.start(), m.end()) for m in re.finditer(r"\S+", content)]
    starts = [a for a, _ in words]
    before = [0, *accumulate(b - a for a, b in words)]  # characters in the words before each

    def left(at: int) -> int:
        """estimate(content[at:]), which begins with a word or within one."""
        k = bisect_left(starts, at)
        part = words[k - 1][1] - at if k and words[k - 1][1] > at else 0
        n = len(words) - k + (part > 0)
        return int(((before[-1] - before[k] + part + n - 1) / 3.5 * 0.5 + (len(content) - at) / 4 * 0.3 + n * 1.3 * 0.2) * 1.1)

    at = 0
    while at < len(content):
        n = left(at)
        if n <= most:
            out.append(content[at:])
            break
        size = max(1, int(most * (len(content) - at) / n))
        cut = min(len(content), boundary(content, at + size, first=at))
        while estimate(content[at:cut]) > 1.2 * most and size > 1:
            size = max(1, int(size * 0.9))
            shorter = min(len(content), boundary(content, at + size, first=at))
            cut = shorter if shorter < cut else at + size
        out.append(content[at:cut].strip())
        at = cut
        while at < len(content) and content[at].isspace():
            at += 1
    out = [x for x in out if x]
    if len(out) > 1 and estimate(out[-1]) < least:
        out[-2:] = [f"{out[-2]} {out[-1]}"]
    return ((x, estimate(x)) for x in out)


def split_texts(rows: DataFrame, key: str, content: str, most: int = TARGET, least: int = TAIL) -> DataFrame:
    """(key, part, part_text, part_tokens) by split_text; no parts for null and blank texts."""
    kind = ArrayType(StructType([StructField("part_text", StringType()), StructField("part_tokens", IntegerType())]))

    @F.pandas_udf(kind)
    def cut(column: pd.Series) -> pd.Series:
        return column.map(lambda x: [{"part_text": a, "part_tokens": b} for a, b in split_text(x or "", most, least)])

    parts = rows.select(key, F.posexplode(cut(content)).alias("_at", "_part"))
    return parts.select(key, (F.col("_at") + 1).alias("part"), "_part.part_text", "_part.part_tokens")
