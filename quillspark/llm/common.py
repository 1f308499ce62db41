"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master only, a new local folder."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share: intermediate tables are written there")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


#: Folders of intermediate tables that this process has written and not removed.
_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, known to clear()."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: it cuts the lineage and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made() -> list[str]:
    """The folders written so far, oldest first."""
    return list(_made)


def clear(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Removes intermediate tables (all: paths None). Only for results that have been written or collected: a result that
    is still to be computed reads them."""
    for path in made() if paths is None else paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove(path)


def clear_unread(df: DataFrame, older: list[str]) -> DataFrame:
    """df; the folders made since `older` was taken that df doesn't read are removed. What they served has been written."""
    read = {path.rsplit("/", 2)[-2] for path in df.inputFiles()}
    clear(df.sparkSession, [path for path in made() if path not in older and path.rsplit("/", 1)[-1] not in read])
    return df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column of df."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about `most` bytes of the column, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        first = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < len(sizes):
            yield batch.slice(first)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, a null as an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def by_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text", most: int = SLICE_BYTES) -> Callable:
    """For mapInArrow: work on one slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, most):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return run


def kept_rows(docs: DataFrame, decide: Callable[[pa.RecordBatch], list[bool]], text_col: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """The rows of docs for which decide(batch) holds, with all their columns: a narrow map."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(decide(batch), pa.bool_()))

    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema.fields])
    return docs.mapInArrow(by_slice(work, text_col, most), schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
