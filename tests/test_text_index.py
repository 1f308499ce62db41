from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import text_index as m

WORDS = ["the", "licence", "under", "mit", "new", "york", "é", "42", "a"]


def brute(docs, asked):
    out = set()
    for q, (kind, ws) in asked.items():
        for i, t in docs:
            ts = re.findall("[a-z0-9]+", (t or "").lower())
            hit = {"all": bool(ws) and set(ws) <= set(ts), "any": bool(set(ws) & set(ts)), "phrase": bool(ws) and any(ts[k : k + len(ws)] == ws for k in range(len(ts)))}[kind]
            if hit and i is not None:
                out.add((q, i))
    return sorted(out)


def found(spark, path, asked):
    return sorted(tuple(r) for r in m.search(spark, path, m.queries_of(spark, asked)).collect())


ASKED = {
    "all": ("all", ["the", "mit"]), "three": ("all", ["new", "york", "42"]), "any": ("any", ["york", "nosuch"]), "phrase": ("phrase", ["new", "york"]),
    "twice": ("phrase", ["new", "york", "new", "york"]), "same": ("phrase", ["the", "the"]), "repeat": ("all", ["the", "the"]), "none": ("all", ["the", "nosuch"]), "empty": ("all", []), "one": ("phrase", ["licence"]),
}


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_scan(spark, tmp_path, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(-20_000, 20_000), 300)
    docs = [(i, rng.choice([None, "", "Only THE one", " ".join(rng.choices(WORDS, k=rng.randint(1, 25)))])) for i in ids] + [(None, "new york")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "id long, text string, bucket int, term string").repartition(3)
    m.build(df, "id", text.ordered_terms(F.col("text")), str(tmp_path), buckets=5)
    assert found(spark, str(tmp_path), ASKED) == brute(docs, ASKED)


def test_appended_rows_and_long_texts(spark, tmp_path):
    docs = [(1, "the " * 50_000 + "new york"), (2, "york new"), (5000, "new york the mit"), (5001, "new new york")]
    for k, part in enumerate((docs[:2], docs[2:])):
        m.build(spark.createDataFrame(part, "id long, text string"), "id", text.ordered_terms(F.col("text")), str(tmp_path), append=k > 0)
    assert found(spark, str(tmp_path), ASKED) == brute(docs, ASKED)
    m.build(spark.createDataFrame([(2, "mit the")], "id long, text string"), "id", text.ordered_terms(F.col("text")), str(tmp_path), append=True)
    assert ("all", 2) in found(spark, str(tmp_path), ASKED)  # one document of two rows


def test_reads_only_the_buckets_of_its_terms(spark, tmp_path):
    df = spark.range(2000).select("id", F.array(F.concat(F.lit("w"), F.col("id") % 300), F.lit("common")).alias("ts"))
    m.build(df, "id", F.col("ts"), str(tmp_path), buckets=16)
    held = m.postings(spark, str(tmp_path), ["w7", "common"])
    assert {r["term"] for r in held.collect()} == {"w7", "common"} and held.where("term = 'common'").agg(F.max(F.size("offsets"))).first()[0] <= 1 << m.BLOCK_BITS
    wanted = {r["bucket"] for r in held.select("bucket").distinct().collect()}
    assert len(wanted) <= 2
    broken = [f for folder in (tmp_path / "postings").iterdir() if folder.is_dir() and int(folder.name.split("=")[1]) not in wanted for f in folder.glob("*.parquet")]
    assert len(broken) > 8
    for file in broken:  # what it doesn't need it doesn't open
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"broken")
    result = m.search(spark, str(tmp_path), m.queries_of(spark, {"q": ("all", ["w7", "common"])}))
    assert sorted(r["id"] for r in result.collect()) == list(range(7, 2000, 300))
    assert m.search(spark, str(tmp_path), m.queries_of(spark, {"q": ("all", [])})).count() == 0


def test_empty_table(spark, tmp_path):
    m.build(spark.createDataFrame([], "id long, ts array<string>"), "id", F.col("ts"), str(tmp_path))
    assert found(spark, str(tmp_path), ASKED) == []
