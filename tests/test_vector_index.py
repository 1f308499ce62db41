from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import enrichment
from quillspark.operators import vector_index as m


def clustered(rng, n, middles=30, width=16, spread=0.6):
    at = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(middles)]
    return [[a + rng.gauss(0, spread) for a in rng.choice(at)] for _ in range(n)]


def brute(rows, queries, n):
    sound = lambda v: v is not None and len(v) == len(queries[0][1]) and all(a is not None and math.isfinite(a) for a in v) and any(v)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if sound(v)}
    out = set()
    for q, v in queries:
        near = sorted(((-round(float(unit[i] @ np.array(v)) / float(np.linalg.norm(v)), 6), i) for i in unit))[:n]
        out |= {(q, i) for _, i in near}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return list(enumerate(clustered(rng, 3000)))


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    df = spark.createDataFrame([(*r, r[0] % 7) for r in rows], "id long, v array<double>, label long").repartition(4)
    return m.build(df, "id", "v", str(tmp_path_factory.mktemp("index")), 16, keep=("label",))


def test_all_lists_give_the_exact_result(spark, rows, index):
    queries = spark.createDataFrame(rows[:40], "id long, v array<double>")
    got = index.search(queries, "id", "v", 10, len(index.centroids), keep=("label",)).collect()
    assert {(r["query"], r["key"]) for r in got} == brute(rows, rows[:40], 10)
    assert all(r["label"] == r["key"] % 7 for r in got) and sorted({r["rank"] for r in got}) == list(range(1, 11))
    one = enrichment.nearest(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", rows[5][1], 10).collect()
    assert [r["id"] for r in one] == [r["key"] for r in sorted((r for r in got if r["query"] == 5), key=lambda r: r["rank"])]


def test_recall_with_its_own_probes(spark, rows, index):
    rng = random.Random(9)
    queries = spark.createDataFrame([(10_000 + i, [a + rng.gauss(0, 0.3) for a in rng.choice(rows)[1]]) for i in range(60)], "id long, v array<double>")
    assert 20 < len(index.centroids) and index.probes < 0.7 * len(index.centroids)
    got = index.recall(queries, "id", "v").first()
    assert got["queries"] == 60 and got["neighbours"] == 600 and got["found"] >= 570


def test_recall_on_all_embeddings(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = m.build(rows, "vec_id", "embedding", str(tmp_path), 64)
    got = index.recall(rows.where("vec_id % 50 = 0"), "vec_id", "embedding").first()
    assert got["neighbours"] == 10 * got["queries"] > 0 and got["found"] >= 0.95 * got["neighbours"]


def test_reads_only_the_lists_that_it_probes(spark, rows, index):
    query = spark.createDataFrame(rows[:1], "id long, v array<double>")
    found = index.search(query, "id", "v", 5, 2)
    assert found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lists_that_it_does_not_probe_may_be_broken(spark, rows, tmp_path):
    df = spark.createDataFrame(rows[:500], "id long, v array<double>")
    index = m.build(df, "id", "v", str(tmp_path), 16, lists=8)
    query = df.where("id = 3")
    want = index.search(query, "id", "v", 5, 2).collect()
    probed = query.select(m.nearest_lists(F.col("v"), index.centroids, 2).alias("l")).first()["l"]
    for folder in (tmp_path / "lists").iterdir():
        if folder.is_dir() and int(folder.name.split("=")[1]) not in probed:
            for file in folder.glob("*.parquet"):
                (folder / f".{file.name}.crc").unlink(missing_ok=True)
                file.write_bytes(b"broken")
    assert index.search(query, "id", "v", 5, 2).collect() == want
    with pytest.raises(Exception):  # noqa: B017
        index.search(query, "id", "v", 5, 8).collect()


def test_opened_again(spark, rows, index):
    again = m.open_index(spark, index.path)
    assert again.probes == index.probes and np.array_equal(again.centroids, index.centroids)
    queries = spark.createDataFrame(rows[:3], "id long, v array<double>")
    assert sorted(again.search(queries, "id", "v", 3).collect()) == sorted(index.search(queries, "id", "v", 3).collect())


def test_vectors_without_direction_and_copies(spark, tmp_path):
    rng = random.Random(1)
    good = [1.0, 2.0, 3.0, 4.0]
    odd = [None, [], [0.0] * 4, [1.0] * 3, [None, 1.0, 1.0, 1.0], [float("nan"), 1.0, 1.0, 1.0], [float("inf"), 1.0, 1.0, 1.0]]
    rows = [(i, good) for i in range(300)] + [(300 + i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(50)] + [(900 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = m.build(df, "id", "v", str(tmp_path), 4)
    got = index.search(spark.createDataFrame([(1, good), (2, None), (3, [0.0] * 4), (4, [1.0])], "q long, v array<double>"), "q", "v", 5, len(index.centroids)).collect()
    assert sorted((r["query"], r["key"], r["rank"]) for r in got) == [(1, i, i + 1) for i in range(5)]
    assert index.table().count() == 350
    empty = m.build(df.where("false"), "id", "v", str(tmp_path / "empty"), 4)
    assert empty.search(df.where("id = 1"), "id", "v").count() == 0


def test_float_vectors(spark, tmp_path):
    df = spark.range(40).select("id", F.array(*(F.sin(F.col("id") * (k + 1)).cast("float") for k in range(8))).alias("v"))
    index = m.build(df, "id", "v", str(tmp_path), 8, lists=3)
    assert index.search(df.where("id = 7"), "id", "v", 1).first()["key"] == 7


def test_rounds_as_spark_does(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) for _ in range(2000)] + [k / 10**7 for k in range(-2005, 2006, 5)] + [0.1234565, 0.9999995, -0.0000005, 1.0, 0.0]
    want = [r[1] for r in spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", F.round("x", 6)).orderBy("i").collect()]
    assert m.rounded(np.array(values), 6).tolist() == want


def test_pairs_meet_as_blocks(spark, tmp_path, monkeypatch):
    """Similarity isn't computed for each joined row, blocks of any size give the same, and ties go to the smaller key."""
    rng = random.Random(6)
    vectors = clustered(rng, 400, 8, 6)
    rows = [(i, [float(int(a * 4)) or 1.0 for a in vectors[i % 250]]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    index = m.build(df, "id", "v", str(tmp_path), 6, lists=9)
    found = index.search(df.where("id % 5 = 0"), "id", "v", 7, 9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join [lane" in plan and "NestedLoop" not in plan
    exact = found.orderBy("query", "rank").collect()
    assert {(r["query"], r["key"]) for r in exact} == brute(rows, [r for r in rows if r[0] % 5 == 0], 7)
    for r, s in zip(exact, exact[1:]):
        assert r["query"] != s["query"] or (-r["similarity"], r["key"]) < (-s["similarity"], s["key"])
    near = index.search(df.where("id % 5 = 0"), "id", "v", 7, 3).collect()
    lists = dict(df.select("id", F.get(m.nearest_lists(F.col("v"), index.centroids, 1), F.lit(0))).collect())
    probed = dict(df.select("id", m.nearest_lists(F.col("v"), index.centroids, 3)).collect())
    for q, v in rows[::5]:
        assert {r["key"] for r in near if r["query"] == q} == {k for _, k in brute([r for r in rows if lists[r[0]] in probed[q]], [(q, v)], 7)}
    monkeypatch.setattr(m, "ASKED_ROWS", 5)
    monkeypatch.setattr(m, "HELD_ROWS", 11)
    monkeypatch.setattr(m, "GROUPS", 2)
    assert index.search(df.where("id % 5 = 0"), "id", "v", 7, 9).orderBy("query", "rank").collect() == exact
    assert sorted(index.search(df.where("id % 5 = 0"), "id", "v", 7, 3).collect()) == sorted(near)
