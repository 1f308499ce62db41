"""Writers and checks of what was written. Spark's committers publish whole outputs, so there is no rename to do by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: Texts are written as they are: blanks at their ends stay, an empty text is a pair of quotes and a null is nothing.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""', "nullValue": ""}


def csv_encoded(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """rows with the columns in order, nested ones as JSON."""
    nested = (ArrayType, MapType, StructType)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(*(F.to_json(c).alias(c) if isinstance(kinds[c], nested) else F.col(c) for c in columns or rows.columns))


def replace_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Replaces the CSV; an empty table is an error, and leaves what was there."""
    if rows.isEmpty():
        raise ValueError("there is nothing to write")
    csv_encoded(rows, columns).write.mode("overwrite").options(**CSV).csv(path)


def append_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    csv_encoded(rows, columns).write.mode("append").options(**CSV).csv(path)


def append_json(rows: DataFrame, path: str) -> None:
    """JSON lines: appending needs no closing bracket."""
    rows.write.mode("append").json(path)


def queues(process: DataFrame, remove: DataFrame, process_path: str, remove_path: str) -> None:
    """Two queues; what isn't a call doesn't get into the first."""
    process.where(F.coalesce("is_earnings_call", F.lit(False))).write.mode("overwrite").json(process_path)
    remove.write.mode("overwrite").json(remove_path)


def split(rows: DataFrame, flag: str, good_path: str, bad_path: str) -> None:
    """Good and bad rows apart; a side without rows writes no table."""
    for side, path in ((rows.where(F.col(flag)), good_path), (rows.where(~F.coalesce(F.col(flag), F.lit(False))), bad_path)):
        if not side.isEmpty():
            side.write.mode("overwrite").parquet(path)


def replace_keys(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces the partitions of the keys that rows has, and no others."""
    rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def sidecar(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key how many rows it has and a digest of them that doesn't depend on their order."""
    digest = F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(20,0)"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest"))


def consolidated(parts: DataFrame, expected: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, keys): the rows of all parts that agree with what sidecar() said when they were written, and the keys of
    those that don't or are missing. Parts that no sidecar knows are left out."""
    sound = sidecar(parts, keys).join(expected, [*keys, "rows", "digest"], "left_semi").select(*keys)
    return parts.join(sound, keys, "left_semi"), expected.select(*keys).join(sound, keys, "left_anti")


def clustered(rows: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    """A table partitioned for pruning and sorted within files, so that Parquet's minima and maxima stand in for an index."""
    rows.repartition(*by).sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).parquet(path)


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def integrity(rows: DataFrame, required: list[str], vector: str | None = None, width: int | None = None) -> DataFrame:
    """One row: rows, rows that lack a required value, rows with a vector that is missing or of another width."""
    lacking = F.count_if(F.greatest(*(F.col(c).isNull().cast("int") for c in required), F.lit(0)) == 1)
    off = F.count_if(F.col(vector).isNull() | (F.size(vector) != width)) if vector else F.lit(0).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("rows"), lacking.alias("lacking"), off.alias("bad_vectors"))


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many: what a uniqueness constraint would refuse."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, if no key has two; an error with some of the keys otherwise."""
    if found := repeated_keys(rows, keys).limit(5).collect():
        raise ValueError(f"keys {keys} are not unique, for one {found[0].asDict()}")
    return rows


def quarantined(rows: DataFrame, broken: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that are sound, and those that aren't with the time they were set aside."""
    bad = F.coalesce(broken, F.lit(True))
    return rows.where(~bad), rows.where(bad).withColumn("set_aside_at", F.current_timestamp())


def status_totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def merged_manifest(manifest: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The manifest with the updates of some ids merged in: a field that an update has (not null) takes the place of the
    old one, new ids are added, others stay."""
    old, new = manifest.select(key, *(F.col(c).alias(f"_old_{c}") for c in manifest.columns if c != key)), updates
    both = old.join(new, key, "full_outer")
    return both.select(key, *(F.coalesce(*([F.col(c)] if c in updates.columns else []), F.col(f"_old_{c}")).alias(c) for c in manifest.columns if c != key))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """One row: all ids, those completed, those failed."""
    return manifest.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"))


def error_logs(errors: DataFrame, kind: str, *fields: str) -> DataFrame:
    """error_type, the fields, and how many errors of that class there are; errors of no class are left out."""
    known = errors.where(F.col(kind).isNotNull())
    return known.join(known.groupBy(kind).agg(F.count(F.lit(1)).alias("total_errors")), kind).select(F.col(kind).alias("error_type"), *fields, "total_errors")


def save_error_logs(errors: DataFrame, kind: str, path: str) -> None:
    """A folder for each class of error, none for classes without any."""
    errors.where(F.col(kind).isNotNull()).withColumn("error_type", F.col(kind)).write.mode("overwrite").partitionBy("error_type").json(path)


def run_totals(usage: DataFrame, run: str, order: str, *amounts: str) -> DataFrame:
    """usage with the running total of each amount within its run, in order: what a run has cost so far."""
    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return usage.withColumns({f"{a}_so_far": F.coalesce(F.sum(a).over(w), F.lit(0)) for a in amounts})


def appended(ignored: DataFrame, row: dict, reason: str) -> DataFrame:
    """The ignore list with a row more, dated today."""
    more = ignored.sparkSession.createDataFrame([{**{c: None for c in ignored.columns}, **row, "reason": reason}], ignored.schema)
    return ignored.unionByName(more.withColumn("date_added", F.current_date().cast("string")))


def observed(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """rows, and metrics that are taken while rows are written: a run's log without a second pass."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items())), seen


def failures(results: DataFrame, key: str, error: str) -> DataFrame:
    """Keys that failed, why and when."""
    return results.where(F.col(error).isNotNull()).select(key, F.col(error).alias("error"), F.current_timestamp().alias("failed_at"))
