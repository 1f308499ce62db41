from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillspark.operators import clustering

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def admitted(path: str, **ranges) -> tuple[int, int, int, int]:
    """(files, groups) that hold rows within the ranges by their statistics, and (files, groups) in all."""
    files = groups = all_files = all_groups = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        hit = 0
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}
            hit += all(stats[c].min <= high and stats[c].max >= low for c, (low, high) in ranges.items())
        files, groups = files + (hit > 0), groups + hit
        all_files, all_groups = all_files + 1, all_groups + meta.num_row_groups
    return files, groups, all_files, all_groups


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_filters_on_any_column_read_few_files(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey", "l_quantity", "l_partkey", "l_orderkey", "l_linenumber")
    path = str(tmp_path / "z")
    clustering.write_clustered(lines, ["l_suppkey", "l_quantity", "l_partkey"], path, 64, bloom=("l_orderkey",), group_bytes=1 << 14)
    held = spark.read.parquet(path)
    assert held.exceptAll(lines).count() == 0 and held.count() == lines.count()
    files, groups, all_files, all_groups = admitted(path, l_suppkey=(7, 7))
    assert files <= 0.5 * all_files and groups <= 0.5 * all_groups and all_files >= 48
    files, groups, *_ = admitted(path, l_quantity=(10, 11))
    assert files <= 0.6 * all_files and groups <= 0.6 * all_groups
    files, groups, *_ = admitted(path, l_suppkey=(3, 3), l_quantity=(2, 2))
    assert files <= 0.25 * all_files and groups <= 0.25 * all_groups
    meta = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata
    assert meta.num_rows < lines.count() / 16
    plan = held.where("l_suppkey = 3 AND l_quantity < 4")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,3)" in plan and "LessThan(l_quantity" in plan


def test_a_bloom_filter_skips_groups_without_the_key(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.xxhash64("id").alias("key"), (F.col("id") % 7).alias("v"))
    with_, without = str(tmp_path / "b"), str(tmp_path / "n")
    clustering.write_clustered(rows, ["k", "v"], with_, 8, bloom=("key",))
    clustering.write_clustered(rows, ["k", "v"], without, 8)
    key = rows.where("k = 77").head()["key"]

    def scanned(path: str) -> int:
        found = spark.read.parquet(path).where(F.col("key") == key)
        assert [r["k"] for r in found.collect()] == [77]
        found._jdf.queryExecution().toRdd().count()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return scan.metrics().apply("numOutputRows").value()

    assert scanned(with_) < scanned(without) / 3


def test_nulls_texts_ties_and_empty_tables(spark, tmp_path):
    rows = [(None, None, 1), ("a", 2.5, 2), ("a", 2.5, 2), ("b" * 200, None, 3), (None, 1.0, None)] + [("hot", float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, x double, _z_rank int")
    out = clustering.read_clustered(df, ["name", "x"], str(tmp_path / "t"), 4)
    assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert clustering.read_clustered(df.limit(0), ["name", "x"], str(tmp_path / "e"), 4).count() == 0
    z = df.select(clustering.z_order(df, ["name", "x"]).alias("z"), "name", "x").collect()
    assert all(r["z"] >= 0 for r in z) and len({r["z"] for r in z}) > 30
    with pytest.raises(ValueError, match="columns"):
        clustering.z_order(df, [])


def test_interleaved_bits(spark):
    row = spark.range(1).select(clustering.interleaved([F.lit(0b101), F.lit(0b010)], 3).alias("z")).head()
    assert row["z"] == 0b100110
    ranks = spark.range(10).select(clustering.rank(F.col("id"), [1, 3, 3], "bigint", 2).alias("r")).collect()
    assert [r["r"] for r in ranks] == [0, 1, 1, 3, 3, 3, 3, 3, 3, 3]
