from __future__ import annotations

import random

import pytest
from hypothesis import assume, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import chunking, pairing, table_functions


class Scripted:
    """Decisions by the window's first block, its length and how often it was asked: the same for equal windows."""

    def __init__(self, seed: int, undecided: float, skipped: float):
        self.seed, self.undecided, self.skipped, self.asked, self.widest = seed, undecided, skipped, 0, 0

    def __call__(self, view):
        self.asked += 1
        self.widest = max(self.widest, len(view))
        rng = random.Random(f"{self.seed} {view[0]['block']} {len(view)}")
        x = rng.random()
        return None if x < self.undecided else 0 if x < self.undecided + self.skipped else rng.randint(1, len(view))


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 160), st.integers(1, 12), st.integers(0, 1 << 30), st.sampled_from([(0.2, 0.1), (0.9, 0.0), (1.0, 0.0), (0.0, 1.0), (0.5, 0.45), (0.0, 0.0)]), st.floats(0, 1))
def test_blocks_one_by_one_give_the_same_groups(n, window, seed, shares, rejected):
    verdict = lambda part: random.Random(f"{seed} {part[0]['block']} {len(part)}").random() >= rejected
    blocks = [{"block": i} for i in range(n)]
    plain = Scripted(seed, *shares)
    want = pairing.group_blocks(blocks, plain, verdict, window)
    assume(plain.asked < 3 * n or n == 0)  # the limit of rounds, which needs the number of blocks
    step = Scripted(seed, *shares)
    grouper = pairing.Grouper(step, verdict, window)
    got = [g for b in blocks for g in grouper.feed(b)] + grouper.finish()
    assert got == want and step.widest < pairing.MOST_BLOCKS + 2 * window  # one more step behind a rejected end


def test_a_long_key_is_never_held():
    most = 0
    grouper = pairing.Grouper(lambda view: None)
    made = 0
    for i in range(100_000):
        made += len(grouper.feed({"block": i}))
        most = max(most, len(grouper.held))
    assert made == 2000 and most < 60
    chunker, out = table_functions.ChunkPieces(), 0
    for i in range(20_000):
        row = {"k": 1, "at": i, "piece": f"some words of piece {i}", "head": None}
        out += len(list(chunker.eval(row, "k", "at", "piece", "head", 50, 10)))
        assert chunker.before is None or len(chunker.before.pieces) + len(chunker.now.pieces) < 40
    out += len(list(chunker.terminate()))
    assert out > 2000


def test_split_equals_the_plain_splitter(spark):
    table_functions.register(spark)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta.", "gamma", "delta! ", "\n"]) for _ in range(rng.randint(0, 900))) for _ in range(30)] + ["", "  ", None, "x" * 9000]
    rows = spark.createDataFrame([(i, t, "part") for i, t in enumerate(texts)], "doc_id long, text string, part string")
    rows.createOrReplaceTempView("tf_docs")
    got = spark.sql("SELECT * FROM split_parts(TABLE(tf_docs), 'doc_id', 'text', 200, 100)")
    want = [(i, k, *p) for i, t in enumerate(texts) for k, p in enumerate(chunking.split_text(t or "", 200, 100), 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 60
    assert sorted(map(tuple, chunking.split_texts(rows, "doc_id", "text", 200, 100).collect())) == sorted(want)


def test_chunks_equal_the_fold_in_the_engine(spark):
    table_functions.register(spark)
    rng = random.Random(6)
    data = [(None if i == 7 else i, [rng.choice(["", "  ", None, "word " * rng.randint(1, 60)]) for _ in range(rng.randint(0, 40))]) for i in range(40)]
    blocks = spark.createDataFrame(data, "id long, ps array<string>")
    head = F.lit("[Head]\n\n")
    want = chunking.chunks(blocks, ["id"], head, "ps", whole=-1, target=80, tail=40).select("id", "chunk_id", "chunk_content", "first_piece", "last_piece", "chunk_tokens")
    blocks.select("id", head.alias("head"), F.posexplode("ps").alias("at", "piece")).createOrReplaceTempView("tf_pieces")
    got = spark.sql("SELECT * FROM chunk_pieces(TABLE(tf_pieces), 'id', 'at', 'piece', 'head', 80, 40)")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key) and got.count() > 100
    assert spark.sql("SELECT * FROM chunk_pieces(TABLE(SELECT * FROM tf_pieces WHERE false), 'id', 'at', 'piece', 'head', 80, 40)").count() == 0


def test_summaries_see_the_two_before(spark):
    def strategy(content, before):
        if content == "bad":
            raise ValueError(content)
        return f"{content}<{'|'.join(x[0] for x in before)}>"

    table_functions.register(spark, strategy=strategy)
    rows = [("k", i, t) for i, t in enumerate(["a", "b", None, "bad", "c", "", "d"])] + [("l", 3, "z"), (None, 1, "n"), (None, 2, "m")]
    spark.createDataFrame(rows, "k string, o int, t string").createOrReplaceTempView("tf_rows")
    found = {(r["k"], r["o"]): r["block_summary"] for r in spark.sql("SELECT * FROM summaries_in_order(TABLE(tf_rows), 'k', 'o', 't')").collect()}
    assert [found["k", i] for i in range(7)] == ["a<>", "b<a>", None, None, "c<a|b>", "<b|c>", "d<c|<>"]
    assert found["l", 3] == "z<>" and (found[None, 1], found[None, 2]) == ("n<>", "m<n>")


def test_groups_by_sql_equal_the_grouped_form(spark):
    table_functions.register(spark, window=4)
    rows = [(k, i, i % (k + 2) == 1) for k in range(4) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, block long, is_start boolean")
    df.createOrReplaceTempView("tf_blocks")
    got = spark.sql("SELECT * FROM block_groups(TABLE(tf_blocks), 'k', 'block')").collect()
    want = pairing.state_machine(df, "k", "block", pairing.asker_rule(), window=4).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_wrong_column_is_an_error(spark):
    table_functions.register(spark)
    spark.createDataFrame([(1, "a")], "k long, t string").createOrReplaceTempView("tf_wrong")
    with pytest.raises(Exception, match="names of its columns"):
        spark.sql("SELECT * FROM split_parts(TABLE(tf_wrong), 'k', 'nothing', 5, 3)").collect()
