"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, on a local master only, a new local folder that goes with the process."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share: intermediate tables are written there")
        folder = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        named = sc.getCheckpointDir()
    return named.rstrip("/")


_made: list[str] = []


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A new folder in the shared one, known to clear()."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows written once as Parquet in the shared folder and read back: it cuts the lineage and outlives executors."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def made() -> list[str]:
    """Folders written and not removed, oldest first."""
    return list(_made)


def clear(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Removes intermediate tables (all, if no paths are given). Only for results that have been written or collected."""
    for path in made() if paths is None else paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove(path)
