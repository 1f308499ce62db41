from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.operators import documents
from quillspark.sources import readers

HEAD = '<transcript{ns}><meta><title>Q1 2024 Earnings Call</title><participants><participant id="1" title="CFO" affiliation="Bank">Ann</participant><participant id="2" title="Bob">Bob</participant></participants></meta>'
BODY = """<body><section name="MD"><speaker id="1" type=""><plist><p> First
"quoted" </p><p> </p><p>Second</p></plist></speaker><speaker id="1" type=""><plist><p>Again</p></plist></speaker></section>
<section name="Empty"><speaker id="1"><plist><p>  </p></plist></speaker></section>
<section name="Q&amp;A"><speaker id="2" type="q"><p>Why?</p></speaker><speaker id="9" type="a"><plist><p>So.</p></plist></speaker></section></body></transcript>"""


@pytest.mark.parametrize("ns", ["", ' xmlns="urn:x"'])
def test_paragraphs(spark, ns):
    files = spark.createDataFrame([("k", HEAD.format(ns=ns) + BODY), ("bad", "<oops"), ("none", None), ("bare", "<transcript></transcript>")], "key string, content string")
    rows = documents.paragraphs(documents.parsed(files), "key").orderBy("paragraph_id").collect()
    assert [tuple(r) for r in rows] == [
        ("k", "Q1 2024 Earnings Call", 1, "MD", 1, 1, None, "Ann, CFO, Bank", 'First "quoted"'), ("k", "Q1 2024 Earnings Call", 1, "MD", 2, 1, None, "Ann, CFO, Bank", "Second"),
        ("k", "Q1 2024 Earnings Call", 1, "MD", 3, 2, None, "Ann, CFO, Bank", "Again"), ("k", "Q1 2024 Earnings Call", 2, "Q&A", 4, 3, "question", "Bob", "Why?"),
        ("k", "Q1 2024 Earnings Call", 2, "Q&A", 5, 4, "answer", "Unknown Speaker", "So."),
    ]
    titled = readers.transcripts(files)
    assert {(r["key"], r["is_earnings_call"]) for r in titled.collect()} == {("k", True), ("bad", False), ("none", False), ("bare", False)}


def test_structure(spark):
    rows = [("ok", "A"), ("ok", "B"), ("ok", " A "), ("less", "A"), ("more", "A"), ("more", "B"), ("more", "C"), ("case", "a"), ("case", "B"), ("blank", " "), ("blank", None)]
    v = documents.structure(spark.createDataFrame(rows, "k string, s string"), "k", "s", ["A", "B"])
    got = {r["k"]: (r["is_valid"], r["validation_errors"]) for r in v.collect()}
    assert got == {
        "ok": (True, []), "less": (False, ["expected 2 sections, found 1", "missing: B"]), "more": (False, ["expected 2 sections, found 3", "unexpected: C"]),
        "case": (False, ["missing: A", "unexpected: a"]), "blank": (False, ["expected 2 sections, found 0", "missing: A", "missing: B"]),
    }
    good, bad = documents.valid_rows(spark.createDataFrame(rows, "k string, s string"), v, "k")
    assert good.count() == 3 and bad.count() == 8


def test_duplicates_and_samples(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "a")], "i int, t string")
    assert [tuple(r) for r in documents.duplicates(rows, "t", "i").collect()] == [("a", 4, 1)]
    assert sorted(r["i"] for r in documents.samples(rows, "t", [F.col("i")]).collect()) == [1, 2, 3, 4]
    assert sorted(r["i"] for r in documents.first_of_each(rows, "t", [F.col("i")]).collect()) == [1, 3]
    assert {tuple(r) for r in documents.version_histogram(rows, "t").collect()} == {(4, 1), (1, 1)}
