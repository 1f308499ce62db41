from __future__ import annotations

import base64
import random

import pytest

from quillspark.operators import token_count as m

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_words_are_merged_by_rank(encoding):
    whole, ranks = encoding
    rng = random.Random(1)
    words = ["a" * 500, "=" * 3000, "", "é" * 99] + ["".join(rng.choice("abetnsio éß日😀=-") for _ in range(rng.randint(1, 40))).replace(" ", "") for _ in range(500)]
    for w in words:
        if w.isalpha() or set(w) == {"="}:  # one word by the pattern
            assert m.merged(w.encode(), ranks) == len(whole.encode_ordinary(w)), w


def test_counts_are_those_of_the_vocabulary(spark, encoding):
    whole, _ = encoding
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in m.token_counts(docs, "doc_id", "text", PATH).collect()}
    assert got == {k: len(whole.encode_ordinary(t or "")) for k, t in texts.items()}


def test_odd_texts(spark, encoding):
    whole, _ = encoding
    parts = ["the", " river", "\n\n", "  ", "é", "日本", "😀", "123", "'s", "'RE", "!?", "\t", "\x0b", "\x1c", "\x85", " ", "　", " ", "<|endoftext|>", "ǅ", "²", "x" * 40]
    rng = random.Random(2)
    texts = [None, "", " ", "the " * 40_000] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i % 200, t, "w") for i, t in enumerate(texts)], "id int, text string, word string").repartition(3)
    got = sorted((r["id"], r["n_tokens"]) for r in m.token_counts(df, "id", "text", PATH).collect())
    assert got == sorted((i % 200, len(whole.encode_ordinary(t or ""))) for i, t in enumerate(texts))
    assert m.token_counts(df.where("false"), "id", "text", PATH).count() == 0


def test_vocabulary_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "MOST_RANKS", 2)
    (tmp_path / "v").write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(3)))
    with pytest.raises(ValueError):
        m.read_ranks(spark, str(tmp_path / "v"))
