from __future__ import annotations

import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import chat as m

TEXTS = st.text(st.sampled_from("<>|[]\\/sINTé日turnysd \n"), max_size=25)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=6))
def test_round_trip(turns):
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    buffer, offsets, starts, stops = m.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    raw = buffer.to_pybytes()
    assert m.read_back(raw) == [(r.encode(), t.encode()) for r, t in turns]
    assert [m.unescape(raw[a:b]).decode() for a, b in zip(starts, stops, strict=True)] == texts
    for a, b in zip(starts, stops, strict=True):
        assert not any(x in raw[a:b] for x in (b"</s>", b"<s>", b"[INST]", b"[/INST]", b"<|"))
    assert offsets[-1] == len(raw)


def test_long_batches_take_little_memory():
    import tracemalloc

    text = "a <turn> of [some] words \\\\ and é " * 4000  # 128 kB
    n = 480
    table = pa.table({"id": [i // 3 for i in range(n)], "role": ["user", "assistant", "user"] * (n // 3), "text": [text] * n})
    tracemalloc.start()
    rows, size = 0, 0
    for part in m._whole(table):
        out = m._formatted(part, "id")
        rows += out.num_rows
        size = max(size, out.nbytes)
        for formatted, starts, stops in zip(*(out.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            assert [m.unescape(formatted.encode()[a:b]).decode() for a, b in zip(starts, stops, strict=True)] == [text]
            break
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == n // 3 and size < 2 * m.SLICE_BYTES and peak < 250 << 20


def test_slices_and_blocks(monkeypatch):
    monkeypatch.setattr(m, "SLICE_BYTES", 30)
    monkeypatch.setattr(m, "BLOCK", 7)
    texts = ["", "<[\\", "x" * 20, "é日<", "", "[[[[[[[[[[[[", "end"]
    ids = [1, 1, 2, None, None, 3, 3]
    parts = m._whole(pa.table({"id": ids, "role": pa.array(["assistant"] * 7), "text": texts}))
    assert len(parts) == 2 and [x for p in parts for x in p.column(2).to_pylist()] == texts
    got = [(r["id"], r) for p in parts for r in m._formatted(p, "id").to_pylist()]
    assert [k for k, _ in got] == [1, 2, None, 3]
    assert [t.decode() for _, r in got for _, t in m.read_back(r["formatted"].encode())] == texts


def test_rows(spark):
    turns = [(1, 1, "assistant", "b"), (1, 0, "user", "a <|end|> \\"), (2, 0, "assistant", None), (2, 1, None, "x"), (3, 0, "user", "only"), (None, 0, "assistant", "n"), (4, None, "user", "first"), (4, 0, "assistant", "é日"), (4, 0, "assistant", "é日"), (4, 9, "assistant", "[/INST]")]
    rows = spark.createDataFrame([(*t, 5) for t in turns], "conv_id long, turn int, role string, text string, n_turns int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # conversations span batches
    got = {r["conv_id"]: r for r in m.digests(m.chat_format(rows)).collect()}
    formatted = {r["conv_id"]: r["formatted"] for r in m.chat_format(rows).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for key, r in got.items():
        mine = sorted(((t, ro or "", tx or "") for c, t, ro, tx in turns if c == key), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        loss = "".join(tx for _, ro, tx in mine if ro == "assistant")
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{ro}\n{tx}\n" for _, ro, tx in mine).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(formatted[key])
    assert m.chat_format(rows.limit(0)).count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "2"
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
