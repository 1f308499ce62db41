"""The best version of each family as a stream: what a nightly comparison of archive and master finds, kept up to date.

A family's state is its best row and, where timers run, the names that it has replaced since the family was last quiet. A batch in which a
better version arrives gives two rows: the old one is to be removed, the new one to be processed. Versions are compared by
content, never by time of arrival, so batches may come late, twice or in another order: what has been processed and not
removed is always the best of all that has come. If `quiet` seconds are given, a timer ends a family's list of replaced names
once nothing better has come for so long, and tells so; the best row is kept, for late versions. Timers go by the clock, so
they are for queries that run on: Spark gives a query with such timers batches without end, also one that is to stop at
what is available, unless spark.sql.streaming.noDataMicroBatches.enabled is off.

Defined cases: rows of a null family are a family; null ranks and versions lie below all others, null times below all times;
equal rows, and rows that are no better, change nothing; ties go to the smaller ordinal.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Spark's state store for state of this kind.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIELDS = ("name", "rank", "version", "changed", "ordinal")


def _place(row: tuple) -> tuple:
    """Greatest is best: (rank, version, time, ordinal) as archive.current_order has them."""
    _, rank, version, changed, ordinal = row
    known = lambda x: (x is not None, x) if x is not None else (False,)
    return (known(rank), known(version), known(changed), (1, 0) if ordinal is None else (0, -ordinal))


class BestVersion(StatefulProcessor):
    def __init__(self, state: StructType, family: str, quiet_ms: int | None) -> None:
        self.state, self.family, self.quiet_ms = state, family, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.state)
        self.replaced = handle.getMapState("replaced", "name string", "times int")

    def row(self, key: tuple, action: str, best: tuple, replaced: int) -> Row:
        return Row(**{self.family: key[0], "action": action, **dict(zip(FIELDS, best, strict=True)), "replaced": replaced})

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        old = tuple(self.best.get()) if self.best.exists() else None
        new = old
        for row in rows:
            one = tuple(row[f] for f in FIELDS)
            if new is None or _place(one) > _place(new):
                new = one
        if new == old:
            return
        if old is not None and self.quiet_ms is not None:
            name = (old[0] or "",)
            times = self.replaced.getValue(name)[0] if self.replaced.containsKey(name) else 0
            self.replaced.updateValue(name, (times + 1,))
        if old is not None:
            yield self.row(key, "remove", old, 0)
        self.best.update(new)
        if self.quiet_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)
        yield self.row(key, "process", new, 0)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        times = sum(value[0] for value in self.replaced.values()) if self.replaced.exists() else 0
        self.replaced.clear()
        if self.best.exists():
            yield self.row(key, "settled", tuple(self.best.get()), times)

    def close(self) -> None:
        pass


def best_versions(stream: DataFrame, family: str, quiet: float | None = None) -> DataFrame:
    """(family, action, name, rank, version, changed, ordinal, replaced) of a stream with those columns: action is process,
    remove, or settled (with how often the family's best was replaced before it became quiet)."""
    fields = [StructField(f, stream.schema[f].dataType) for f in FIELDS]
    out = StructType([StructField(family, stream.schema[family].dataType), StructField("action", StringType()), *fields, StructField("replaced", IntegerType())])
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return stream.select(family, *FIELDS).groupBy(family).transformWithState(BestVersion(StructType(fields), family, None if quiet is None else int(quiet * 1000)), out, "append", "None" if quiet is None else "ProcessingTime")


def standing(log: DataFrame, family: str) -> DataFrame:
    """What has been processed and not removed: one row for each family, whatever the order of the log."""
    weight = F.when(F.col("action") == "process", 1).when(F.col("action") == "remove", -1).otherwise(0)
    return log.groupBy(family, *FIELDS).agg(F.sum(weight).alias("_held")).where("_held > 0").drop("_held")
