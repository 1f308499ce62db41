"""Readers: archives of files, documents in XML, JSON and CSV, small dimension files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.functions import text
from quillspark.operators import archive, documents


def archive_files(spark: SparkSession, root: str, pattern: str = "*.xml", content: bool = False, skip: tuple[str, ...] = ("InvalidTranscripts",)) -> DataFrame:
    """(full_path, filename, modified, size[, content]) of all files below root, by Spark's own listing; without content
    only the listing is read. Folders named in `skip` are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    path = F.col("path")
    for name in skip:
        found = found.where(~path.contains(f"/{name}/"))
    cols = [path.alias("full_path"), text.basename(path).alias("filename"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")]
    return found.select(*cols, *(["content"] if content else []))


def archive_inventory(files: DataFrame, exact: bool = True, root: str = "Data") -> tuple[DataFrame, DataFrame]:
    """(rows with the parts of name and path, rows whose name can't be read)."""
    named = files.withColumn("name_parts", archive.named_parts(F.col("filename"), exact)).withColumn("path_parts", archive.path_parts(F.col("full_path"), root))
    return named.where("name_parts IS NOT NULL"), named.where("name_parts IS NULL").drop("name_parts", "path_parts")


def coverage_files(files: DataFrame) -> DataFrame:
    """(year, quarter, ticker) from folders `YYYY/Qn/kind/TICKER_Company`; others are left out."""
    found = F.regexp_extract("full_path", r"/(\d{4})/(Q[^/]*)/[^/]+/([A-Z0-9.\-]+)_[^/]*/[^/]+$", 0)
    part = lambda i: F.regexp_extract("full_path", r"/(\d{4})/(Q[^/]*)/[^/]+/([A-Z0-9.\-]+)_[^/]*/[^/]+$", i)
    return files.where(found != "").select("full_path", part(1).alias("year"), part(2).alias("quarter"), part(3).alias("ticker"))


def transcripts(files: DataFrame) -> DataFrame:
    """files(content) with the parsed document, its title and whether the title is that of a call."""
    parsed = documents.parsed(files)
    title = F.trim(F.col("doc.meta.title"))
    return parsed.withColumn("title", title).withColumn("is_earnings_call", text.title_is_call(title))


def closed_array(raw: Column) -> Column:
    """A JSON array's text, closed where writing broke off behind an element."""
    bare = F.rtrim(raw)
    return F.when(bare.endswith("]"), bare).otherwise(F.concat(F.regexp_replace(bare, r",\s*$", ""), F.lit("]")))


def json_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of whole-file JSON: an array, possibly not closed, or an object with `records`."""
    raw = spark.read.text(path, wholetext=True)
    kind = schema if isinstance(schema, str) else schema.simpleString().removeprefix("struct<").removesuffix(">")
    rows = F.from_json(closed_array(F.col("value")), f"array<struct<{kind}>>")
    held = F.from_json("value", f"records array<struct<{kind}>>")["records"]
    return raw.select(F.inline(F.when(F.ltrim("value").startswith("{"), held).otherwise(rows)))


def csv_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, quoted line ends and doubled quotes; the schema is given, never inferred. Blanks at the ends of
    texts stay; nothing between two commas is null, a pair of quotes an empty text. Spark reads both as its nullValue where
    that is empty, so it is a text that stands nowhere."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', nullValue=uuid.uuid4().hex, **blanks)


def dimension(spark: SparkSession, path: str, schema: str, section: str | None = None, fallback: dict | None = None) -> DataFrame:
    """A small YAML mapping (key -> fields) or list as a table; where the file is missing the fallback's section counts."""
    import yaml

    try:
        with open(path, encoding="utf-8") as f:
            held = yaml.safe_load(f)
    except FileNotFoundError:
        held = fallback or {}
    if section and isinstance(held, dict) and section in held:
        held = held[section]
    names = StructType.fromDDL(schema).fieldNames()
    rows = [{names[0]: k, **v} for k, v in held.items()] if isinstance(held, dict) else held
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def registry(categories: DataFrame, key: str = "id", ordinal: str | None = None) -> DataFrame:
    """One row of each key; the last by ordinal wins."""
    return documents.first_of_each(categories, key, [F.col(ordinal or key).desc()])


def excel_table(spark: SparkSession, path: str, sheet: str, schema: str) -> DataFrame:
    """A small spreadsheet as text columns (ids keep their digits), blanks trimmed. pandas reads it on the driver."""
    import pandas as pd

    names = StructType.fromDDL(schema).fieldNames()
    frame = pd.read_excel(path, sheet_name=sheet, dtype=str)
    rows = [tuple(None if pd.isna(v) else str(v).strip() for v in r) for r in frame.reindex(columns=names).itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


def requirements(spark: SparkSession, path: str) -> DataFrame:
    """(name, version) of `name==version # note` lines."""
    line = F.trim(F.regexp_replace("value", r"#.*$", ""))
    return spark.read.text(path).select(line.alias("l")).where("l LIKE '%==%'").select(F.trim(F.split("l", "==")[0]).alias("name"), F.trim(F.split("l", "==")[1]).alias("version"))


def queue(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A queue written by sinks.queues; an empty table where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)
