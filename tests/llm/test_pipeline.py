from __future__ import annotations

import os
import re

import pytest

import corpus_pipeline
from quillspark.llm import common, language_id, registry, substring_dedup
from quillspark.llm.common import table, written
from tests.llm.test_packing import check
from tests.llm.test_simhash import WORD, least_reachable
from tests.llm.test_simhash import brute as brute_fingerprint
from tests.llm.test_substring_dedup import brute

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    by_id = lambda d: {r["doc_id"]: r for r in d.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), "test")
        kept.append((docs, out))
        assert name == "packing" or out.columns == columns
        docs = out
    (d0, d1), (_, d2), (_, d3), (_, d4), (_, d5) = kept
    from quillspark.llm import quality_rules

    assert set(by_id(d1)) == {r["doc_id"] for r in quality_rules.quality_rules(d0).where("kept").collect()} and d1.count() < d0.count()
    assert set(by_id(d2)) == {r["doc_id"] for r in language_id.language_id(d1).where("kept").collect()}
    # near copies: op5's links, and 5-word shingles of similarity 0.8 or more, by brute force
    texts = {r["doc_id"]: r["text"] for r in d2.collect()}
    ids, fps, sets = sorted(texts), {}, {}
    for i in ids:
        words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), texts[i]))
        sets[i] = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
        fps[i] = brute_fingerprint(texts[i])
    like = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    pairs = [(a, b) for k, b in enumerate(ids) for a in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 2 or min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and like(sets[a], sets[b])]
    root = least_reachable(ids, pairs)
    assert set(by_id(d3)) == set(root.values())
    rows = [(r["doc_id"], r["text"]) for r in d3.collect()]
    gone = brute(rows)
    import numpy as np

    for i, r in by_id(d4).items():
        was = by_id(d3)[i]["text"].encode() if len(rows) < 3 else dict(rows)[i].encode()
        assert r["text"] == np.frombuffer(was, np.uint8)[~gone[i, was]].tobytes().decode("utf-8", "ignore") and r["n_chars"] == len(r["text"])
    from quillspark.llm import packing

    check(d5.collect(), packing.Tokens(), {i: [r["text"]] for i, r in by_id(d4).items()})


def test_run_gives_what_the_stages_give(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert common.made()[-1].rsplit("/", 1)[1].startswith("stage-packing") and not any("/stage-rules" in p or "/blocks-" in p for p in common.made()[-3:])


def test_edge_cases(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows, ties, clashing names; and an empty table."""
    docs = table(spark, SF, "documents").limit(40).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], k, "x") for k, r in enumerate(docs)]
    long = max(docs, key=lambda r: len(r["text"]))
    rows += [(None, None, None, None, None, None, None), (900, "", "en", "s", 0, 1, "y"), (None, long["text"] + " And one more.", None, None, None, 2, "z"), rows[3], rows[3]]
    rows += [(901, rows[5][1], "en", "s", 1, 3, "w")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id int, _block string"
    spark.createDataFrame(rows, schema).selectExpr("*", "1 AS slot", "2 AS fp", "3 AS nth", "4 AS key", "5 AS block", "6 AS bucket").write.parquet(str(tmp_path / "documents.parquet"))
    now = table(spark, str(tmp_path), "documents")
    names = now.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, str(tmp_path)), "test")
        assert now.columns == names
        kept = [(r["doc_id"], r["_id"], r["slot"], r["fp"], r["nth"], r["key"], r["block"], r["bucket"]) for r in now.collect()]
        assert all(r[2:] == (1, 2, 3, 4, 5, 6) for r in kept) and len(kept) > 20
    assert 900 not in {r[0] for r in kept} and 901 not in {r[0] for r in kept} and len({r[0] for r in kept}) == len(kept)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= len(kept)
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_registered_queries():
    names = set(registry.QUERIES)
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(registry.SQL) <= names and substring_dedup.SQL in registry.SQL.values()
