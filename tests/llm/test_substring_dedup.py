from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quillspark.llm import substring_dedup as m
from quillspark.llm.suffix_sort import sort_suffixes


def brute(rows: list[tuple], length: int = m.LENGTH) -> dict:
    """Removed bytes of each (id, text)."""
    least: dict[bytes, int] = {}
    rows = [(m.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in rows:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            least[s] = min(i, least.get(s, i))
    out = {}
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < i:
                gone[p : p + length] = True
        out[i, t] = gone
    return out


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "é", "th", "日", "o", " "]) for _ in range(rng.randint(1, 4)))
    para = lambda n: " ".join(word() for _ in range(n))
    shared = [para(rng.randint(8, 60)) for _ in range(6)] + ["x" * 200, "ab" * 90]
    rows = []
    for i in range(60):
        parts = [para(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), para(rng.randint(0, 4))]
        rows.append((i * 7 % 60, "\n".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(8)]
    near = rows[3][1] + para(80)
    rows += [(200 + i, near[: 40 * i] + "#" + near[40 * i + 1 :]) for i in range(8)]
    return [*rows, (None, near), (300, None), (301, ""), (302, "short"), (303, near), (303, near), (304, shared[0] * 3)]


@pytest.mark.parametrize(("seed", "many", "chunk"), [(1, 4096, 1 << 19), (2, 2, 1 << 19), (3, 0, 700)])
def test_removed_bytes_are_those_of_brute_force(spark, monkeypatch, seed, many, chunk):
    monkeypatch.setattr(m, "MANY", many)
    monkeypatch.setattr(m, "CHUNK", chunk)
    import pyarrow as pa

    rows = corpus(seed)
    want = brute(rows)
    # the rounds as functions, over blocks in this process: settings for tests hold here, not in Spark's workers
    rounds = m.Rounds(3, "doc_id", "text", m.LENGTH)
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]})
    number = np.array([0 if i is None else i * 31 % 4 for i, _ in rows])
    blocks = [table.filter(pa.array(number == b)).append_column("block", pa.array([b] * int((number == b).sum()), pa.int32())) for b in range(4)]
    replies = pa.Table.from_batches([], m._REPLY)
    mine = lambda b: replies.filter(pa.array([x == b.column("block")[0].as_py() for x in replies.column("block").to_pylist()], pa.bool_()))
    for send, reply in ((lambda b: rounds.send_leaders(b), rounds.reply_leaders), (lambda b: rounds.send_windows(b, mine(b)), rounds.reply_windows)):
        sent = pa.Table.from_batches([x for b in blocks for x in send(b).to_batches()], m._SENT).sort_by([("part", "ascending"), ("block", "ascending"), ("kind", "ascending")]).to_batches(max_chunksize=3)
        replies = pa.concat_tables([replies, pa.Table.from_batches(list(m._reduce(reply)(iter(sent))), m._REPLY)])
    for b in blocks:
        block = rounds.block(b)
        for i, text, gone in zip(block.ids.tolist(), block.texts, rounds.removed(block, m._replies(mine(b))), strict=True):
            assert (gone == want[i, text]).all(), (i, text)


def test_query_and_texts(spark):
    rows = corpus(5)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_removed int, part string")
    want = brute(rows)
    got = m.spans(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        i = m.NO_ID if r["doc_id"] is None else r["doc_id"]
        t = next((t or "").encode() for k, t in rows if k == r["doc_id"])
        gone = want[i, t]
        edges = np.diff(np.concatenate(([0], gone.astype(np.int8))))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(t), gone.sum(), (edges == 1).sum())
        assert r["kept_sha256"] == hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()
    cut = m.deduplicate(docs)
    assert cut.columns == docs.columns
    for r in cut.collect():
        i = m.NO_ID if r["doc_id"] is None else r["doc_id"]
        t = next(t for k, t in rows if k == r["doc_id"])
        assert r["text"] is None if t is None else r["text"] == np.frombuffer(t.encode(), np.uint8)[~want[i, t.encode()]].tobytes().decode("utf-8", "ignore")
        assert (r["n_removed"], r["part"]) == (1, "x")
    assert m.spans(docs.limit(0)).count() == 0
    assert m.spans(docs.where("text IS NULL")).count() == 1


def test_suffixes_are_sorted():
    rng = np.random.RandomState(0)
    for letters, n in ((2, 400), (3, 900), (250, 500)):
        raw = rng.randint(0, letters, n).astype(np.uint8).tobytes()
        raw = raw + raw[: n // 2] + bytes(40) + raw[10 : n // 3]
        starts = rng.permutation(len(raw) - 50 + 1)
        order, same = sort_suffixes(np.frombuffer(raw + bytes(8), np.uint8), starts, 50)
        found = [raw[s : s + 50] for s in starts[order]]
        assert found == sorted(found) and sorted(order.tolist()) == list(range(len(starts)))
        assert same.tolist() == [i > 0 and found[i] == found[i - 1] for i in range(len(found))]
    order, same = sort_suffixes(np.zeros(8, np.uint8), np.zeros(0, np.int64), 50)
    assert not len(order) and not len(same)


def test_columns_of_any_name_and_no_table_left(spark):
    rows = corpus(9)[:30]
    docs = spark.createDataFrame([(i, t, 7, 8, 9) for i, t in rows], "doc_id long, text string, _block int, block int, part int")
    cut = m.deduplicate(docs)
    assert cut.columns == docs.columns and {(r["_block"], r["block"], r["part"]) for r in cut.collect()} == {(7, 8, 9)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("blocks_")]


def test_parts_of_a_block_are_few_rows(spark):
    """However many parts there are, a block sends no more rows than it has leaders."""
    import pyarrow as pa

    table = pa.table({"doc_id": [1, 2], "text": ["a rather short text of some words " * 3, "another text " * 9], "block": pa.array([0, 0], pa.int32())})
    few, many = (m.Rounds(parts, "doc_id", "text", m.LENGTH).send_leaders(table) for parts in (3, 1 << 20))
    assert many.num_rows <= sum(len(b) // 7 for b in few.column("blob").to_pylist())


def sent_and_removed(rows: list[tuple], turns: int, parts: int = 3):
    """Bytes that are sent in each turn of the second round, and the removed bytes of each (id, text), over four blocks."""
    import pyarrow as pa

    rounds = m.Rounds(parts, "doc_id", "text", m.LENGTH)
    rounds.turns = turns
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]})
    number = np.array([0 if i is None else i % 4 for i, _ in rows])
    blocks = [table.filter(pa.array(number == b)).append_column("block", pa.array([b] * int((number == b).sum()), pa.int32())) for b in range(4)]
    mine = lambda held, b: held.filter(pa.array([x == b.column("block")[0].as_py() for x in held.column("block").to_pylist()], pa.bool_()))
    reply = lambda sent, work: pa.Table.from_batches(list(m._reduce(work)(iter(sent.sort_by([("part", "ascending"), ("block", "ascending"), ("kind", "ascending")]).to_batches()))), m._REPLY)
    first = replies = reply(pa.concat_tables([rounds.send_leaders(b) for b in blocks]), rounds.reply_leaders)
    bytes_of = []
    for turn in range(turns):
        sent = pa.concat_tables([rounds.send_windows(b, mine(first, b), turn) for b in blocks])
        bytes_of.append(sum(len(x) for x in sent.column("blob").to_pylist()))
        replies = pa.concat_tables([replies, reply(sent, rounds.reply_windows)])
    out = {}
    for b in blocks:
        block = rounds.block(b)
        out |= {(i, text): gone for i, text, gone in zip(block.ids.tolist(), block.texts, rounds.removed(block, m._replies(mine(replies, b))), strict=True)}
    return bytes_of, out


@pytest.mark.parametrize(("seed", "many", "turns"), [(11, 4096, 5), (12, 2, 3), (13, 4096, 1)])
def test_turns_remove_the_same_bytes_and_bound_what_is_sent(monkeypatch, seed, many, turns):
    monkeypatch.setattr(m, "MANY", many)
    rows = [(k * 1000 + i, t) for k in range(3) for i, t in corpus(seed) if i is not None]
    want = brute(rows)
    sent, found = sent_and_removed(rows, turns, 50)
    assert found.keys() == want.keys() and all((found[k] == want[k]).all() for k in want)
    if many > 1000 and turns > 1:
        assert max(sent) < sum(sent) / 2


def test_what_is_shared_by_chance_is_not_sent():
    """Documents that share many 16-byte strings, but none of 33: nothing repeats, and nothing is sent after the keys."""
    rng = random.Random(3)
    phrases = ["".join(rng.choice("abcdefgh") for _ in range(26)) for _ in range(12)]
    rows = [(i, "".join(rng.choice(phrases) + f"{i:03}{k:04}" for k in range(60))) for i in range(40)]
    sent, found = sent_and_removed(rows, 1)
    assert sent == [0] and not any(g.any() for g in found.values())


def test_turns_follow_what_is_shared():
    assert (m._turns(0, 0, 48), m._turns(10, 10_000, 48), m._turns(1000, 10_000, 48), m._turns(10**6, 10_000, 48)) == (1, 1, 6, 48)
