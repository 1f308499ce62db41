from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.operators import archive


@pytest.mark.parametrize(("name", "exact", "family", "version"), [("a/b/RY_Q1_2024_Raw_11_7.xml", True, "RY_Q1_2024", 7), ("RY_Q1_2024_Raw_11_abc.xml", True, "RY_Q1_2024", 0), ("RY_Q1_2024_Raw_11.xml", True, None, None), ("RY_Q1_2024_Raw_11_7_x.xml", True, None, None), ("RY_Q1_2024_Raw_11_7_x.xml", False, "RY_Q1_2024", 7), ("_Q1_2024_Raw_11_7.xml", True, None, None), (None, True, None, None)])
def test_names(spark, name, exact, family, version):
    p = archive.named_parts(F.col("n"), exact)
    row = spark.createDataFrame([(name,)], "n string").select(p["family"], F.when(p.isNotNull(), archive.version_number(p["version_id"]))).first()
    assert tuple(row) == (family, version)


def test_path_parts(spark):
    rows = [("x/Data/2024/Q1/Raw/RY_Bank/f.xml",), ("x/2024/Q1/f.xml",), ("Data/2024",), (None,)]
    got = [r[0] and tuple(r[0]) for r in spark.createDataFrame(rows, "p string").select(archive.path_parts(F.col("p"))).collect()]
    assert got == [("2024", "Q1", "Raw"), None, None, None]


ORDER = ("rank", "version", "changed", "ordinal")


def inventory(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "name string, changed string, ordinal int")
    p = archive.named_parts(F.col("name"), False)
    return df.select("name", "changed", "ordinal", p["family"].alias("family"), archive.kind_rank(p["kind"]).alias("rank"), archive.version_number(p["version_id"]).alias("version"))


def test_best_version(spark):
    rows = [("A_Q1_2024_Raw_1_9.xml", "5"), ("A_Q1_2024_Corrected_1_2.xml", "1"), ("A_Q1_2024_Corrected_2_3.xml", "1"), ("B_Q1_2024_Other_1_x.xml", None), ("C_Q1_2024_Raw_1_1.xml", "3"), ("C_Q1_2024_Raw_2_1.xml", "3")]
    v = inventory(spark, rows)
    best = {r["family"]: r["name"] for r in archive.best(v, "family", archive.current_order(*ORDER)).collect()}
    assert best == {"A_Q1_2024": rows[2][0], "B_Q1_2024": rows[3][0], "C_Q1_2024": rows[4][0]}
    legacy = {r["family"]: r["name"] for r in archive.best(v, "family", archive.legacy_order(*ORDER)).collect()}
    assert legacy["A_Q1_2024"] == rows[0][0]


def differ(spark, a, m):
    process, remove = archive.difference(inventory(spark, a), inventory(spark, m), "family", "name", "changed", archive.current_order(*ORDER))
    return sorted(r["name"] for r in process.collect()), sorted(r["name"] for r in remove.collect())


def test_difference(spark):
    n = lambda t, v=1, k="Raw": f"{t}_Q1_2024_{k}_1_{v}.xml"
    a = [(n("EQ"), "1"), (n("TIME"), "2"), (n("UP", 1), "1"), (n("UP", 2), "1"), (n("NEW"), "1"), (n("NULL"), None)]
    m = [(n("EQ"), "1"), (n("TIME"), "1"), (n("UP", 1), "1"), (n("GONE", 1), "1"), (n("GONE", 2), "1"), (n("NULL"), None)]
    assert differ(spark, a, m) == (sorted([n("TIME"), n("UP", 2), n("NEW")]), sorted([n("TIME"), n("UP", 1), n("GONE", 1), n("GONE", 2)]))
    assert differ(spark, a, a) == ([], [])
    process, remove = differ(spark, a, m[:0] or [(n("ZZ"), "1")])
    assert len(process) == 5 and remove == [n("ZZ")]


def test_sync_status(spark):
    schema = "event_id string, kind string, ticker string, version_id string"
    found = spark.createDataFrame([("1", "Raw", "A", "5"), ("1", "Corrected", "A", "5"), ("2", "Raw", "A", "5"), ("3", "Raw", "A", "6"), ("4", "Raw", "A", "9")], schema)
    have = spark.createDataFrame([("1", "Raw", "A", "5", 1), ("1", "Raw", "A", "4", 2), ("3", "Raw", "A", "5", 3)], f"{schema}, ordinal int")
    ignored = spark.createDataFrame([(" 4", "9 ")], "event_id string, version_id string")
    got = {(r["event_id"], r["kind"]): (r["status"], r["replaces"]) for r in archive.sync_status(archive.without_ignored(found, ignored, ["event_id", "version_id"]), have, "ordinal").collect()}
    assert got == {("1", "Raw"): ("unchanged", None), ("1", "Corrected"): ("new_kind", None), ("2", "Raw"): ("new_event", None), ("3", "Raw"): ("version_update", "5")}


def test_merge_is_idempotent(spark):
    master = spark.createDataFrame([("a.xml", 1), ("b.xml", 1)], "name string, n int")
    gone = spark.createDataFrame([("x/y/a.xml",), ("c.xml",)], "path string")
    new = spark.createDataFrame([("c.xml", 2)], "name string, n int")
    once = archive.merged(master, gone, new, "name")
    twice = archive.merged(once, gone, new, "name")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("b.xml", 1), ("c.xml", 2)]
    assert archive.merged(master, gone, new.limit(0), "name").count() == 1


def test_resume(spark):
    work = spark.createDataFrame([(i,) for i in range(5)], "k int")
    done = spark.createDataFrame([(0, "completed", True), (1, "completed", False), (2, "failed", None), (3, "in_progress", None)], "k int, status string, verified boolean")
    assert [r["action"] for r in archive.resume(work, done, "k").orderBy("k").collect()] == ["skip", "run", "skip", "run", "run"]
    assert archive.resume(work, done, "k", again=True).where("k = 2").first()["action"] == "run"
