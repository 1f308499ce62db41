"""A sink that publishes one closed file: a JSON array, or texts between a head and a tail (a calendar).

    register(spark)
    rows.write.format("whole_file").option("path", ".../all.json").mode("overwrite").save()
    texts.write.format("whole_file").option("layout", "text").option("head", ...).option("tail", ...) ...

Tasks write their parts to a folder beside the file. The commit joins them, in the order of partitions, into a new file and
puts it in the place of the old one in one step; only then is the old one gone. A job that fails leaves the old file as it
was. Parts of attempts that failed, or that another attempt repeated, are never joined: a part counts if its attempt is the
one that the commit names. One file has one writer: its blocks pass the driver one after another (BLOCK bytes at a time).

Defined cases: no rows give an empty array, or head and tail alone; in JSON a null is null, dates and times are ISO texts,
numbers that JSON has no form for are null; for texts, null ones are left out. Mode append is refused.
"""

from __future__ import annotations

import datetime
import decimal
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

BLOCK = 8 << 20
#: What stands before, between and behind the elements.
LAYOUTS = {"json": ("[\n", ",\n", "\n]\n"), "text": ("", "\n", "\n")}


@dataclass
class Part(WriterCommitMessage):
    number: int
    path: str
    rows: int


def plain(value):
    """A value as JSON has it."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return value.hex()
    return None if isinstance(value, float) and not math.isfinite(value) else value


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, names: list[str], overwrite: bool) -> None:
        if not overwrite:
            raise ValueError("a whole file is replaced, not appended to: write with mode overwrite")
        layout = options.get("layout", "json")
        self.head, self.between, self.tail = (options.get(k, v) for k, v in zip(("head", "between", "tail"), LAYOUTS[layout], strict=True))
        self.layout, self.names = layout, names
        self.path = options["path"]
        self.staging = f"{self.path}.parts-{uuid.uuid4().hex}"
        if layout == "text" and len(names) != 1:
            raise ValueError("texts are a single column")

    @staticmethod
    def at(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

    def write(self, iterator: Iterator[Row]) -> Part:
        task = TaskContext.get()
        number, attempt = (task.partitionId(), task.taskAttemptId()) if task else (0, 0)
        system, folder = self.at(self.staging)
        system.create_dir(folder, recursive=True)
        name, rows = f"part-{number:08d}-{attempt}", 0
        with system.open_output_stream(f"{folder}/{name}") as out:
            for row in iterator:
                element = row[0] if self.layout == "text" else json.dumps({n: plain(row[i]) for i, n in enumerate(self.names)}, ensure_ascii=False)
                if element is not None:
                    out.write(((self.between if rows else "") + element).encode())
                    rows += 1
        return Part(number, name, rows)

    def commit(self, messages: list[Part | None]) -> None:
        system, folder = self.at(self.staging)
        _, target = self.at(self.path)
        system.create_dir(folder, recursive=True)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number)
        with system.open_output_stream(f"{target}.new") as out:
            out.write(self.head.encode())
            for i, part in enumerate(parts):
                out.write((self.between if i else "").encode())
                with system.open_input_stream(f"{folder}/{part.path}") as held:
                    while block := held.read(BLOCK):
                        out.write(block)
            out.write(self.tail.encode())
        system.move(f"{target}.new", target)
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        """Removes the parts; the file stays as it is."""
        from pyarrow import fs

        system, folder = self.at(self.staging)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class WholeFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "whole_file"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), schema.fieldNames(), overwrite)


def json_elements(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The elements of an array that this sink wrote with the layout's own marks. Each is a line, so many tasks read a file,
    none of them whole: Spark's own reader of an array holds all its elements in one task."""
    lines = spark.read.text(path, lineSep="\n").where(F.col("value").startswith("{"))
    return lines.select(F.from_json(F.rtrim("value", F.lit(",")), schema).alias("element")).select("element.*")


def register(spark) -> None:
    spark.dataSource.register(WholeFile)
