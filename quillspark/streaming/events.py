"""Micro-batch forms of the event operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def landing(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a landing folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def window_counts(events: DataFrame, ts: str, kind: str, width: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts by time window and kind; a tumbling window unless there is a slide."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(span.alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("first"), F.col("w.end").alias("last"), kind, "n")


def session_counts(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("first"), F.col("w.end").alias("last"), key, "n")


def deduplicated(events: DataFrame, ts: str, key: str, late: str = "2 days") -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def upsert(write: Callable[[DataFrame], None], read: Callable[[], DataFrame], combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the table becomes combine(table, batch). combine decides by content (best version), never by time
    of arrival, so batches may come late, twice or in another order."""

    def run(batch: DataFrame, number: int) -> None:
        write(combine(read(), batch))

    return run


def running_groups(blocks: DataFrame, key: str, block: str, is_start: str) -> DataFrame:
    """Group numbers of blocks across micro-batches: the state of a key is its last number."""
    out = StructType().add(key, blocks.schema[key].dataType).add(block, "long").add("qa_group_id", "integer")

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(block)
        last = state.get[0] if state.exists else 0
        number = (rows[is_start].astype(int).cumsum() + last).clip(lower=1)
        state.update((int(number.iloc[-1]),))
        yield pd.DataFrame({key: keys[0], block: rows[block].astype("int64"), "qa_group_id": number.astype("int32")})

    return blocks.groupBy(key).applyInPandasWithState(step, out, StructType().add("number", "integer"), "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now into a memory table of bounded aggregates, and returns that table."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def run_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Runs an append stream over what is there now into Parquet files in a shared folder, and returns what they hold: rows
    of any number never pass the driver."""
    stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
