from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillspark.llm import packing as m


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_file(whole):
    fast = m.Tokens()
    rng = random.Random(0)
    parts = ["the", " river", "\n\n", "  ", "é", "日本", "😀", "123", "'s", "!?", "\t", "\0", " ", "<|endoftext|>", "ǅ", "ſ", " ", "x" * 40]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        want = whole.encode(t, add_special_tokens=False).ids
        assert fast(t) == want == fast.slow(t)


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_every_length(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 2048): rng.randint(1, 5000) for _ in range(rng.randint(1, 800))}
    plan = m.patterns(histogram)
    held = defaultdict(int)
    for n, pack in plan:
        assert sum(pack) <= m.SIZE and pack == sorted(pack, reverse=True) and n > 0
        for x in pack:
            held[x] += n
    assert held == histogram
    used, packs = sum(k * v for k, v in histogram.items()), sum(n for n, _ in plan)
    if len(histogram) > 300:
        assert used / (packs * m.SIZE) > 0.93


def check(rows, ids_of, docs):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= m.SIZE
    for key, texts in docs.items():
        want = []
        for t in texts:
            ids = np.array([*ids_of(t or ""), m.END], "<u4")
            want += [(a, min(m.SIZE, len(ids) - a), zlib.crc32(ids[a : a + m.SIZE].tobytes()), len(ids)) for a in range(0, len(ids), m.SIZE)]
        assert sorted(want) == sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[key])
    assert len(by_doc) == len(docs)


def test_pieces_lie_gapless(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["river", "stone", "é", "of"]) for _ in range(rng.choice([0, 1, 5, 300, 2047, 2048, 6000])))) for i in range(60)]
    rows += [(100, None), (None, "no id"), (7, rows[7][1])] + [(i, "same") for i in range(200, 260)]
    docs = defaultdict(list)
    for k, t in rows:
        docs[k].append(t)
    got = m.pack(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int")).collect()
    check(got, m.Tokens(), docs)
    assert m.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_marker_is_one_token_as_in_the_file(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids_of = lambda t: plain.encode(t, add_special_tokens=False).ids
    rng = random.Random(3)
    parts = ["the", " river", "\n\n", "  ", "é", "123", "'s", "<|", "|>", "<", " ", "endoftext", m.MARKER, m.MARKER]
    texts = ["a <|endoftext|> b", m.MARKER, m.MARKER * 3, ""] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    fast = m.FileTokens()
    assert ids_of(texts[0]) == [64, 220, 50256, 275]
    for t in texts:
        assert fast(t) == ids_of(t)
    docs = dict(enumerate(texts))
    check(m.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect(), ids_of, {k: [t] for k, t in docs.items()})
