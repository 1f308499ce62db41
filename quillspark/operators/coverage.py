"""Coverage of an archive: pivots, roll-ups, word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text


def pivot(rows: DataFrame, keys: list[str], column: str, values: list[str]) -> DataFrame:
    """Counts per key, a column for each of the values (given, so that no pass is spent on finding them)."""
    return rows.groupBy(*keys).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


def rollup(rows: DataFrame, category: str, ticker: str, earnings: str, ignored: str) -> DataFrame:
    """Sums by category and ticker, by category, and overall; level is 0, 1 and 3."""
    sums = [F.sum(earnings).alias("earnings"), F.sum(ignored).alias("ignored"), F.sum(F.col(earnings) + F.col(ignored)).alias("total")]
    return rows.rollup(category, ticker).agg(*sums, F.grouping_id().cast("int").alias("level"))


def uncovered(all_keys: DataFrame, *covered: DataFrame, key: str) -> DataFrame:
    """Keys that none of the others has."""
    for c in covered:
        all_keys = all_keys.join(c, key, "left_anti")
    return all_keys


def word_rollup(blocks: DataFrame, key: str, role: str, content: str, asked: str) -> DataFrame:
    n = text.word_count(F.col(content))
    return blocks.groupBy(key).agg(F.sum(n).alias("total_words"), F.sum(F.when(F.col(role) == asked, n).otherwise(0)).alias("asked_words"), F.max(n).alias("longest"))


def bar_widths(blocks: DataFrame, content: str, full: int = 800) -> DataFrame:
    """words of each block and its bar, scaled by the longest of all. The maximum is an aggregate of one row, so that no
    window over the whole table is needed: a scalar subquery."""
    counted = blocks.withColumn("words", text.word_count(F.col(content)))
    top = counted.agg(F.max("words")).scalar()
    return counted.withColumn("width", F.round(F.col("words") * float(full) / F.nullif(top, F.lit(0)), 2))


def first_rows(rows: DataFrame, key: str, ordinal: str, n: int) -> DataFrame:
    """All rows of the first n keys, by the least ordinal of each."""
    heads = rows.groupBy(key).agg(F.min(ordinal).alias("_o")).orderBy("_o", key).limit(n).select(key)
    return rows.join(F.broadcast(heads), key, "left_semi")


def share_of_max(rows: DataFrame, value: str, group: str) -> DataFrame:
    return rows.withColumn("share", F.col(value) / F.max(value).over(Window.partitionBy(group)))
