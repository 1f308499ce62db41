from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import documents
from quillspark.operators import name_match as m


def brute(texts, names):
    out = {}
    for i, t in texts:
        hits = [(o, n) for o, n in names if n and t and o is not None and (n.lower() in t.lower() or t.lower() in n.lower())]
        out[i] = min(hits) if hits else None
    return out


def found(spark, texts, names):
    t = spark.createDataFrame([(*x, "c") for x in texts], "id long, text string, low string").repartition(3)
    n = spark.createDataFrame([(*x, 1) for x in names], "ordinal long, name string, id int").repartition(2)
    got = m.first_match(t, "text", n, "name", "ordinal").collect()
    assert len(got) == len(texts) and all(r["low"] == "c" for r in got)
    return {r["id"]: r["matched"] and tuple(r["matched"]) for r in got}


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_nested_loop(spark, seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abÉéß日😀.% _") for _ in range(rng.randint(0, k)))
    texts = [(i, rng.choice([None, word(30), word(4)])) for i in range(120)]
    names = [(rng.choice([None, i, i, i % 5]), rng.choice([None, word(2), word(3), word(9)])) for i in range(60)]
    assert found(spark, texts, names) == brute(texts, names)


def test_nothing_to_match(spark):
    assert found(spark, [(1, "abc")], []) == {1: None}
    assert found(spark, [], [(1, "abc")]) == {}
    assert found(spark, [(1, ""), (2, None)], [(1, ""), (2, None)]) == {1: None, 2: None}


def test_a_hundred_thousand_names_and_repeated_texts(spark):
    names = spark.range(100_000).select(F.col("id").alias("ordinal"), F.concat(F.lit("Bank "), F.hex(F.xxhash64("id"))).alias("name"))
    texts = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "a common text of no bank").otherwise(F.concat(F.lit("Call of BANK "), F.hex(F.xxhash64(F.col("id") * 7)), F.lit(" Group"))).alias("text"))
    got = m.first_match(texts, "text", names, "name", "ordinal")
    wrong = got.where("NOT (matched.ordinal <=> CASE WHEN id % 3 = 0 OR id * 7 >= 100000 THEN NULL ELSE id * 7 END)")
    assert wrong.count() == 0 and got.where("matched IS NOT NULL").count() == len([i for i in range(20_000) if i % 3 and i * 7 < 100_000])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan


def test_primary_company(spark):
    xml = lambda *names: f"<transcript xmlns='x'><meta><companies>{''.join(f'<company>{n}</company>' for n in names)}</companies></meta></transcript>"
    docs = documents.parsed(spark.createDataFrame([(1, xml("Royal Bank Group", "Other")), (2, xml()), (3, "broken"), (4, xml("Nobody")), (5, xml("royal"))], "id int, content string"))
    institutions = spark.createDataFrame([(2, "RY", "Royal Bank"), (1, "TD", "Toronto"), (3, "RX", "Royal Bank Group of Two")], "ordinal int, ticker string, name string")
    got = {r["id"]: (r["primary_company"], r["primary_ticker"]) for r in m.primary_company(docs, institutions, "ticker", "name", "ordinal").collect()}
    assert got == {1: ("Royal Bank Group", "RY"), 2: ("Unknown Company", None), 3: ("Unknown Company", None), 4: ("Nobody", None), 5: ("royal", "RY")}
