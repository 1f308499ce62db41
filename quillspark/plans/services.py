"""Queries over a paged service, scanned and streamed, and over streams of versions. The service stands before the orders table,
which Spark sorts for it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import functions as F

from quillspark.plans.archives import BEST_SQL, ORDER, VERSIONS_SQL, versions
from quillspark.plans.book import Book, read
from quillspark.sources import api
from quillspark.streaming import events as streams
from quillspark.streaming import versions as version_streams
from quillspark.tables import new_path

book = Book()


#: What a worker has begun to read: a question, how many of its rows have been given, and the rows that follow.
_begun: list[tuple] = []


def _found(table: str, first: str, last: str, status: str | None) -> Iterator[dict]:
    """The rows of some days, in the order of the store, a batch at a time."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(table if "://" in table or table.startswith("file:") else f"file://{table}")
    files = sorted(x.path for x in system.get_file_info(fs.FileSelector(folder)) if x.base_name.startswith("part-"))
    wanted = (ds.field("day") >= first) & (ds.field("day") <= last)
    if status is not None:
        wanted &= ds.field("status") == status
    for batch in ds.dataset(files, filesystem=system, format="parquet").to_batches(filter=wanted, batch_readahead=1, fragment_readahead=1, use_threads=False) if files else ():
        yield from batch.to_pylist()


def orders(first: str, last: str, offset: int, limit: int, table: str, status: str | None = None) -> list[dict]:
    """A page of the orders of some days, as a service would give it: by date and key. Who asks for one page after another
    goes on where the last one ended; any other page is found anew."""
    asked = (table, first, last, status)
    if _begun and _begun[0][:2] == (asked, offset):
        rows = _begun.pop()[2]
    else:
        _begun.clear()
        rows = islice(_found(*asked), offset, None)
    page = list(islice(rows, limit))
    if len(page) == limit:
        _begun.append((asked, offset + limit, rows))
    return page


def _store(spark, sf_dir: str) -> str:
    """The service's table: orders sorted by day and key over its files, so that a range of days is in few of them."""
    path = new_path(spark, "orders")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderstatus").alias("status"), "o_orderdate")
    rows.orderBy("o_orderdate", "o_orderkey").drop("o_orderdate").write.parquet(path)
    return path


def _service(reader, store: str, days: int, end: str):
    options = {"fetch": "quillspark.plans.services:orders", "start": "1995-01-01", "end": end, "days": str(days), "limit": "5000", "with.table": store}
    return reader.format("event_service").schema("o_orderkey long, day string, status string").options(**options, pushed="status").load()


@book.add("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus AS status FROM orders")
def service_scan(spark, sf_dir):
    """All orders by closed ranges of 90 days, a task each, page by page."""
    api.register(spark)
    return _service(spark.read, _store(spark, sf_dir), 90, "2001-12-31")


@book.add("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderstatus = 'F'")
def service_filtered(spark, sf_dir):
    """A filter that the service applies."""
    api.register(spark)
    return _service(spark.read, _store(spark, sf_dir), 365, "2001-12-31").where("status = 'F'").select("o_orderkey", "day")


@book.add("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus AS status FROM orders")
def service_stream(spark, sf_dir):
    """The same as a stream that is stopped in 1998 and started again."""
    api.register(spark)
    folder, store = new_path(spark, "service"), _store(spark, sf_dir)
    streams.run_to_files(_service(spark.readStream, store, 180, "1998-06-30"), folder)
    return streams.run_to_files(_service(spark.readStream, store, 180, "2001-12-31"), folder)


@book.add(f"SELECT family, name, rank FROM (SELECT *, {BEST_SQL} AS nth FROM {VERSIONS_SQL}) WHERE nth = 1")
def stream_best_version(spark, sf_dir):
    """The best versions, as the queues of a stream of four micro-batches leave them."""
    rows = versions(spark, sf_dir).select("family", *ORDER, "name")
    landed, folder = new_path(spark, "landed"), new_path(spark, "versions")
    rows.repartition(4, "ordinal").write.parquet(landed)
    stream = version_streams.best_versions(streams.landing(spark, landed, rows.schema, 1), "family")
    return version_streams.standing(streams.run_to_files(stream, folder), "family").select("family", "name", "rank")
