from __future__ import annotations

import hashlib

import numpy as np
import pytest

from quillspark.llm import order_minhash as m


def brute(raw: bytes, sketches=m.SKETCHES, size=m.TUPLE, k=m.K) -> list:
    """Signature entries as tuples of (substring, occurrence), in text order."""
    raw = raw if len(raw) >= k else raw.ljust(k, b"\xff")
    seen: dict[bytes, int] = {}
    items = []
    for i in range(len(raw) - k + 1):
        g = raw[i : i + k]
        items.append((g, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    hashes = m.numbered(raw)
    out = []
    for s in range(sketches):
        keys = [int(h) * int(m._SALTS[s]) % (1 << 64) for h in hashes]
        least = sorted(range(len(keys)), key=lambda i: keys[i])[:size]
        out.append(tuple(items[i] for i in sorted(least)))
    return out


@pytest.mark.parametrize("block", [1 << 15, 7])
def test_entries_agree_where_tuples_do(monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    rng = np.random.RandomState(0)
    texts = [bytes(rng.choice(list(b"abcd "), n).astype(np.uint8)) for n in (0, 3, 8, 9, 40, 200, 200)]
    texts += [texts[5][:150] + texts[6][150:], texts[5][100:] + texts[5][:100], b"ab" * 60, b"ab" * 61]
    for a in texts:
        for b in texts:
            want = np.mean([x == y for x, y in zip(brute(a), brute(b), strict=True)])
            assert m.likeness(m.signature(a), m.signature(b)) == pytest.approx(want)


def test_order_matters():
    rng = np.random.RandomState(4)
    a = bytes(rng.choice(list(b"abcdefgh "), 3000).astype(np.uint8))
    swapped = a[1500:] + a[:1500]  # nearly the same substrings, far by edit distance
    touched = a[:700] + b"X" + a[700:]
    near, far = m.likeness(m.signature(a), m.signature(touched)), m.likeness(m.signature(a), m.signature(swapped))
    assert near > 0.9 and far < 0.75


@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_query_rows(spark, n):
    rng = np.random.RandomState(n)
    rows = [(int(i * 13 % 101 - 20), "".join(rng.choice(list("abé日 "), rng.randint(0, 60)))) for i in range(n)]
    if n > 5:
        rows += [(500, None), (None, "null id"), (7777, "x"), (7777, "y"), (7777, "y")]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, slot string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    want = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        new = text[: len(text) - k] + following[:k]
        a, b, c = (m.signature(x.encode()) for x in (text, new, following))
        want.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), (a == b).mean(), (a == c).mean()))
    got = [tuple(r) for r in m.order_minhash(docs).collect()]
    assert sorted(got, key=repr) == sorted(((*w[:5], float(w[5]), float(w[6])) for w in want), key=repr)


def test_ids_of_other_types_and_a_plan_that_does_not_grow(spark):
    docs = spark.createDataFrame([(f"k{i}", "some text " * i, 1) for i in range(9)], "doc_id string, text string, range int")
    got = {r["doc_id"]: r for r in m.order_minhash(docs).collect()}
    assert len(got) == 9 and got["k3"]["near_next"] == m.likeness(m.signature(b"some text " * 3), m.signature(b"some text " * 2))
    size = []
    for n in ("2", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        size.append(len(m.order_minhash(docs)._jdf.queryExecution().toString()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert abs(size[0] - size[1]) < 0.05 * size[0]
