"""A data source, batch and streaming, over a paged service. The service is an importable function, so workers can call it:
fetch(first: str, last: str, offset: int, limit: int, **filters) -> list of dicts of the schema's columns.

    register(spark)
    spark.read.format("event_service").schema(...).option("fetch", "package.module:function")
        .option("start", "2024-01-01").option("end", "2024-12-31").option("days", "90").load()
    spark.readStream.format("event_service") ... with the same options

Options that begin with `with.` go to each call of the service by the rest of their names. As a stream its offsets are
days: a batch holds the days since the last one, up to `end` or, without one, up to yesterday (UTC), so that each day is
complete when it is read; a query that is started again goes on behind the last day that its checkpoint has.

Each closed range of up to `days` days is a partition (days=1: a call per day); pages are read to their end. A range that
fails is tried again by Spark as a task, not skipped. Equality filters on `pushed` columns go to the service."""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition


@dataclass
class Range(InputPartition):
    first: str
    last: str


def closed_ranges(start: date, end: date, days: int) -> list[Range]:
    out = []
    while start <= end:
        last = min(end, start + timedelta(days=days - 1))
        out.append(Range(start.isoformat(), last.isoformat()))
        start = last + timedelta(days=1)
    return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]) -> None:
        self.options, self.names, self.filters = options, names, {}
        self.pushable = {x for x in options.get("pushed", "").split(",") if x}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in self.pushable:
                self.filters[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self) -> list[Range]:
        o = self.options
        return closed_ranges(date.fromisoformat(o["start"]), date.fromisoformat(o["end"]), int(o.get("days", 90)))

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from pages(self.options, self.names, partition, self.filters)


def pages(options: dict, names: list[str], part: Range, filters: dict) -> Iterator[tuple]:
    """The rows of a range of days, page after page."""
    module, _, name = options["fetch"].partition(":")
    fetch = getattr(importlib.import_module(module), name)
    more = {k.removeprefix("with."): v for k, v in options.items() if k.startswith("with.")} | filters
    limit, offset = int(options.get("limit", 1000)), 0
    while page := fetch(part.first, part.last, offset, limit, **more):
        yield from (tuple(row.get(n) for n in names) for row in page)
        if len(page) < limit:
            break
        offset += limit


class _StreamReader(DataSourceStreamReader):
    """Offsets are {"day": first day that has not been read}."""

    def __init__(self, options: dict, names: list[str]) -> None:
        self.options, self.names = options, names

    def initialOffset(self) -> dict:  # noqa: N802
        return {"day": self.options["start"]}

    def latestOffset(self) -> dict:  # noqa: N802
        last = date.fromisoformat(self.options["end"]) if "end" in self.options else datetime.now(UTC).date() - timedelta(days=1)
        return {"day": max(last + timedelta(days=1), date.fromisoformat(self.options["start"])).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        last = date.fromisoformat(end["day"]) - timedelta(days=1)
        return closed_ranges(date.fromisoformat(start["day"]), last, int(self.options.get("days", 1)))

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from pages(self.options, self.names, partition, {})

    def commit(self, end: dict) -> None:
        """The checkpoint holds what has been read; the service keeps nothing for us."""


class EventService(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_service"

    def schema(self) -> str:
        return self.options.get("schema", "event_id string, ticker string, event_type string, event_date_time string")

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options), schema.fieldNames())

    def streamReader(self, schema) -> _StreamReader:  # noqa: N802
        return _StreamReader(dict(self.options), schema.fieldNames())


def register(spark) -> None:
    """Makes the source known to a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EventService)
