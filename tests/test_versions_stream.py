from __future__ import annotations

import random

import pytest

from quillspark.operators import archive
from quillspark.streaming import events, versions

SCHEMA = "family string, name string, rank int, version int, changed string, ordinal long"


def made(rng, n):
    pick = lambda *xs: rng.choice(xs)
    return [(pick("a", "b", "c", None), f"n{rng.randint(0, 12)}", pick(None, 1, 2), pick(None, 1, 2, 3), pick(None, "2024-01-01", "2024-02-01"), i) for i in range(n)]


def net(log, family="family"):
    return sorted(map(tuple, versions.standing(log, family).select("family", "name", "rank", "version", "changed", "ordinal").collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_any_split_into_batches_gives_the_best_versions(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = made(rng, 60)
    rows += rng.sample(rows, 10)  # what comes twice
    rng.shuffle(rows)
    want = archive.best(spark.createDataFrame(rows, SCHEMA), "family", archive.current_order("rank", "version", "changed", "ordinal"))
    want = sorted(map(tuple, want.select("family", "name", "rank", "version", "changed", "ordinal").collect()), key=repr)
    cuts = sorted(rng.sample(range(1, len(rows)), 3))
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    log = events.run_to_files(versions.best_versions(stream, "family"), str(tmp_path / "out"))
    assert net(log) == want
    assert log.where("action = 'process'").count() - log.where("action = 'remove'").count() == len(want)


def test_started_again_and_quiet_families(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else batches go on while timers may come

    def land(k, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        return events.run_to_files(versions.best_versions(stream, "family", quiet=0.0), str(tmp_path / "out"))

    land(0, [("a", "one", 1, 1, None, 1)])
    assert net(run()) == [("a", "one", 1, 1, None, 1)]
    land(1, [("a", "two", 2, 1, None, 2), ("b", "other", 1, 1, None, 3)])
    land(2, [("a", "one", 1, 1, None, 1)])  # late: no better
    log = run()
    assert net(log) == [("a", "two", 2, 1, None, 2), ("b", "other", 1, 1, None, 3)]
    assert ("remove", "one") in {(r["action"], r["name"]) for r in log.collect()}
    land(3, [("c", "x", 1, 1, None, 9)])
    land(4, [("c", "x", 1, 1, None, 9)])
    settled = {(r["family"], r["name"]): r["replaced"] for r in run().where("action = 'settled'").orderBy("ordinal").collect()}
    assert settled["a", "two"] == 1 and settled["b", "other"] == 0
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
