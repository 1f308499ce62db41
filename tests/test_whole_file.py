from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillspark.sources import whole_file as m


@pytest.fixture(autouse=True)
def _registered(spark):
    m.register(spark)


def save(df, path, **options):
    df.write.format("whole_file").options(**options).option("path", str(path)).mode("overwrite").save()


def test_closed_array_in_order(spark, tmp_path):
    path = tmp_path / "deep" / "all.json"
    df = spark.range(1000, numPartitions=7).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('é "\n'), "id")).alias("t"), F.array("id").alias("a"), F.struct(F.lit(1.5).alias("x")).alias("s"), F.lit(float("nan")).alias("nan"), F.lit(dt.date(2024, 2, 29)).alias("d"))
    save(df, path)
    held = json.loads(path.read_text())
    assert [r["id"] for r in held] == list(range(1000))
    assert held[3] == {"id": 3, "t": None, "a": [3], "s": {"x": 1.5}, "nan": None, "d": "2024-02-29"} and held[4]["t"] == 'é "\n4'
    assert [p.name for p in path.parent.iterdir()] == ["all.json"]
    save(df.where("id < 0"), path)
    assert json.loads(path.read_text()) == []


def test_a_failed_job_leaves_the_old_file(spark, tmp_path):
    path = tmp_path / "all.json"
    save(spark.range(3), path)
    old = path.read_text()
    with pytest.raises(Exception):  # noqa: B017
        save(spark.range(100, numPartitions=4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id")), path)
    assert path.read_text() == old and [p.name for p in tmp_path.iterdir()] == ["all.json"]


def test_a_repeated_attempt_counts_once(tmp_path, monkeypatch):
    writer = m._Writer({"path": str(tmp_path / "x.json")}, ["n"], True)

    class Task:
        attempt = 0

        def partitionId(self):  # noqa: N802
            return 0

        def taskAttemptId(self):  # noqa: N802
            Task.attempt += 1
            return Task.attempt

    monkeypatch.setattr(m, "TaskContext", type("C", (), {"get": staticmethod(Task)}))

    def breaking():
        yield Row(n=1)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(breaking())
    good = writer.write(iter([Row(n=1), Row(n=2)]))
    writer.write(iter([Row(n=1), Row(n=2)]))  # a speculative copy
    writer.commit([None, good])
    assert json.loads((tmp_path / "x.json").read_text()) == [{"n": 1}, {"n": 2}] and len(list(tmp_path.iterdir())) == 1


def test_texts_with_head_and_tail(spark, tmp_path):
    path = tmp_path / "c.ics"
    df = spark.createDataFrame([("a",), (None,), ("b",)], "value string").coalesce(1)
    save(df, path, layout="text", head="HEAD\n", tail="\nTAIL\n")
    assert path.read_text() == "HEAD\na\nb\nTAIL\n"
    with pytest.raises(Exception):  # noqa: B017
        save(spark.range(2).select("id", "id"), path, layout="text")
    with pytest.raises(Exception):  # noqa: B017
        df.write.format("whole_file").option("path", str(path)).mode("append").save()
    assert path.read_text() == "HEAD\na\nb\nTAIL\n"


def test_elements_are_read_by_many_tasks(spark, tmp_path):
    odd = ["", None, "a,", "},", "]", "[", "{", " \r\n", "\u2028x\x85", '"', "\\", "é" * 3000, "\x00"]
    rows = spark.createDataFrame([(i, odd[i % len(odd)], [i, None], dt.date(2024, 2, 29)) for i in range(130)], "i long, t string, a array<long>, d date").repartition(5)
    save(rows, tmp_path / "all.json")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        back = m.json_elements(spark, str(tmp_path / "all.json"), rows.schema)
        assert back.rdd.getNumPartitions() > 4
        assert sorted(back.collect()) == sorted(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    save(rows.limit(0), tmp_path / "none.json")
    assert m.json_elements(spark, str(tmp_path / "none.json"), rows.schema).count() == 0


def test_query_reads_its_array_in_parts(spark):
    """As one array of several megabytes, one task would hold all its elements."""
    from quillspark.plans import stores

    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert stores.json_array_sink(spark, "/root/testdata/sf0.01").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
