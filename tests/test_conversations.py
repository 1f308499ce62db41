from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import chunking, enrichment, pairing


def blocks(n, starts=()):
    return [{"block": i + 1, "is_start": i + 1 in starts} for i in range(n)]


def spans(found):
    return [(g.qa_group_id, g.start_block_id, g.end_block_id, g.method) for g in found]


def test_state_machine_by_rule():
    found = pairing.group_blocks(blocks(9, {1, 4, 6}), pairing.asker_rule(), lambda _: True, window=2)
    assert spans(found) == [(1, 1, 3, "validated"), (2, 4, 5, "validated"), (3, 6, 9, "final")]
    assert spans(pairing.group_blocks(blocks(1), pairing.asker_rule(), lambda _: True)) == [(1, 1, 1, "final")]
    assert pairing.group_blocks([], pairing.asker_rule(), lambda _: True) == []


def test_state_machine_forces_groups():
    skips = pairing.group_blocks(blocks(40), lambda _: 0, lambda _: True, window=3)
    assert skips[0].method == "forced_skip_limit" and (skips[0].start_block_id, skips[0].end_block_id) == (1, 15) and skips[0].confidence == 0.7
    held = pairing.group_blocks(blocks(120), lambda _: None, lambda _: True, window=25)
    assert held[0].method == "memory_limit" and held[0].end_block_id == 50
    rejected = pairing.group_blocks(blocks(6), lambda v: 2, lambda _: False, window=2)
    assert rejected[0].method == "unvalidated" and rejected[0].confidence == 0.5


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 70), st.randoms(use_true_random=False), st.integers(1, 12))
def test_groups_cover_all_blocks_in_order(n, rng, window):
    decide = lambda view: rng.choice([None, 0, rng.randint(1, len(view))])
    found = pairing.group_blocks(blocks(n), decide, lambda _: rng.random() < 0.6, window)
    assert [b for g in found for b in range(g.start_block_id, g.end_block_id + 1)] == list(range(1, n + 1))
    assert [g.qa_group_id for g in found] == list(range(1, len(found) + 1))


def test_rule_equals_state_machine(spark):
    rows = [(k, b, (b * k) % 3 == 1 or b == 1) for k in range(1, 9) for b in range(1, 14)]
    df = spark.createDataFrame(rows, "k long, block long, is_start boolean")
    by_rule = {(r["k"], r["block"]): r["qa_group_id"] for r in pairing.by_rule(df, "k", "block", F.col("is_start")).collect()}
    groups = pairing.state_machine(df, "k", "block", pairing.asker_rule(), window=4)
    by_machine = {(r["k"], r["block"]): r["qa_group_id"] for r in pairing.assigned(df, groups, "k", "block", F.lit(True)).collect()}
    assert by_rule == by_machine


def test_gaps_runs_and_breaks(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, None), ("a", 3, 1), ("a", 6, 3), ("a", 7, 3), ("b", 4, None)], "k string, block int, g int")
    assert {tuple(r)[:2] + (r["position"],) for r in pairing.gap_positions(df, "k", "block", "g").collect()} == {("a", 2, "middle"), ("b", 4, "first")}
    assert [(r["block"], r["previous"]) for r in pairing.order_breaks(df, "k", "block", "g").collect()] == [(6, 1)]
    assert sorted((r["k"], r["first_block"], r["last_block"], r["blocks"]) for r in pairing.runs(df, "k", "block", ["g"]).collect()) == [("a", 1, 1, 1), ("a", 2, 2, 1), ("a", 3, 3, 1), ("a", 6, 7, 2), ("b", 4, 4, 1)]
    assert [tuple(r) for r in pairing.first_missing(df, "k", "block").collect()] == [("a", 4)]
    assert sorted(tuple(r) for r in pairing.all_missing(df, "k", "block").collect()) == [("a", 4), ("a", 5)]
    assert {(r["k"], r["block"]): r["block_position"] for r in pairing.positions(df, "k", "block").collect()}["b", 4] == "opening"


def plain_chunks(header, pieces, whole, target, tail, glue="\n\n"):
    pieces = [p for p in pieces if p and p.strip(" ")]
    text = lambda ps: (header + glue.join(ps)).rstrip(" ")
    tok = chunking.estimate
    if not pieces:
        return []
    if tok(text(pieces)) <= whole:
        return [text(pieces)]
    out, now, size = [], [], tok(header)
    for p in pieces:
        if now and size + tok(p) > target:
            out.append(now)
            now, size = [p], tok(header) + tok(p)
        else:
            now.append(p)
            size += tok(p)
    if tail is not None and out and tok(text(now)) < tail:
        out[-1] += now
    else:
        out.append(now)
    return [text(x) for x in out]


@pytest.mark.parametrize("tail", [30, None])
def test_chunks_are_those_of_a_plain_fold(spark, tail):
    rng = np.random.RandomState(1)
    word = lambda n: " ".join("w" * rng.randint(1, 9) for _ in range(n))
    rows = [(i, f"S{i}", [word(rng.randint(0, 60)) for _ in range(rng.randint(0, 9))] + ([" ", None] if i % 4 == 0 else [])) for i in range(40)] + [(90, "S", [word(400)]), (91, "S", [])]
    df = spark.createDataFrame(rows, "id int, speaker string, ps array<string>")
    got: dict[int, list] = {}
    for r in chunking.chunks(df, ["id"], chunking.speaker_header(F.col("speaker")), "ps", whole=100, target=50, tail=tail).orderBy("id", "chunk_id").collect():
        got.setdefault(r["id"], []).append(r)
    for i, speaker, ps in rows:
        want = plain_chunks(f"[{speaker}]\n\n", ps, 100, 50, tail)
        assert [r["chunk_content"] for r in got.get(i, [])] == want
        assert [r["chunk_id"] for r in got.get(i, [])] == list(range(1, len(want) + 1)) and all(r["total_chunks"] == len(want) and r["chunk_tokens"] == chunking.estimate(r["chunk_content"]) for r in got.get(i, []))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab .!?\n"), max_size=900))
def test_splitter_keeps_every_word(content):
    parts = list(chunking.split_text(content, 30, 10))
    assert "".join("".join(p.split()) for p, _ in parts) == "".join(content.split())
    assert all(n == chunking.estimate(p) for p, n in parts)
    assert all(n <= 1.2 * 30 for _, n in parts[:-1][: max(0, len(parts) - 2)])


def test_boundary():
    assert chunking.boundary("One. Two. Three", 6, 50) == 5
    assert chunking.boundary("aaaa bbbb cccc", 6, 3) == 10 and chunking.boundary("aaaaaaaa", 3) == 3


def test_categories_and_vectors(spark):
    rows = spark.createDataFrame([(1, 1, 1, "the bank"), (1, 1, 2, "a loan"), (1, 2, 3, "nothing"), (1, 2, 4, None)], "k int, b int, o int, t string")
    got = enrichment.classify(rows, "k", "b", "o", "t", lambda c: enrichment.by_keywords(c, {1: ["bank"], 2: ["loan"], 9: ["the"]}), {0: "Other", 1: "Bank", 2: "Loan"}).collect()
    assert {(r["o"], tuple(r["classification_ids"]), tuple(r["classification_names"])) for r in got} == {(1, (1, 2), ("Bank", "Loan")), (2, (1, 2), ("Bank", "Loan")), (3, (0,), ("Other",)), (4, (0,), ("Other",))}
    embed = enrichment.hash_embedder(8)
    found = {r["o"]: r["embedding"] for r in enrichment.embed(rows, "o", "t", embed, 2).collect()}
    assert found[4] is None and np.allclose(found[1], embed(["the bank"])[0])

    def fails(texts):
        raise RuntimeError("service")

    assert {r["embedding"] for r in enrichment.embed(rows, "o", "t", fails).collect()} == {None}
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0])], "i int, v array<float>")
    assert [(r["i"], r["similarity"]) for r in enrichment.nearest(vectors, "i", "v", [1.0, 0.0], 3).collect()] == [(1, 1.0), (3, 1.0), (2, 0.0)]
    assert {r["i"] for r in enrichment.check_vectors(vectors, "v", 2).collect()} == {5, 6}
    summary = enrichment.summarise(rows, "k", "o", "t").orderBy("o").collect()
    assert summary[0]["block_summary"] == "the bank" and summary[3]["block_summary"] is None


def test_chunk_plan_folds_once(spark):
    df = spark.createDataFrame([(1, "A", ["one", "two"])], "id int, speaker string, ps array<string>")
    plan = chunking.chunks(df, ["id"], chunking.speaker_header(F.col("speaker")), "ps")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
