from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from quillspark.llm import simhash as m
from quillspark.llm.common import written
from quillspark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def least_reachable(keys: list[int], pairs) -> dict[int, int]:
    root = {k: k for k in keys}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {k: top(k) for k in keys}


@pytest.mark.parametrize("text", ["", " \t\n", "One", "A b", "a B c", "x\x85y z é", "w " * 500, "The cat sat on the mat. " * 9 + "È É"])
def test_fingerprints_are_those_of_brute_force(text):
    assert m.fingerprint(text.encode()) == brute(text)


def test_spark_hash_is_the_same(spark):
    row = spark.sql("SELECT xxhash64('the cat sat') AS h").first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"the cat sat", 42)


@pytest.mark.parametrize("small", [32, 2])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, small):
    rng = random.Random(small)
    fps = {rng.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1}
    for centre in list(fps)[:6]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randint(0, 63)
            fps.add(x)
    hot = rng.getrandbits(64)
    fps |= {hot ^ (1 << i) ^ (1 << j) for i in range(32, 64) for j in range(i)}  # all share a segment or all but a bit of it
    fps = sorted(fps)
    rows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    keyed = m._keyed(rows).toPandas()
    monkeypatch.setattr(m, "SMALL", small)
    keys, found = keyed["key"].to_numpy().view(np.uint64), keyed["fp"].to_numpy().view(np.uint64)
    order = np.lexsort((found, keys))
    a, b = m._links(keys[order], found[order])
    assert (np.bitwise_count(a ^ b) <= 2).all()
    arr = np.array(fps, np.uint64)
    pairs = [(int(x), int(y)) for i, x in enumerate(arr) for y in arr[:i][np.bitwise_count(arr[:i] ^ x) <= 2]]
    assert least_reachable(fps, zip(a.tolist(), b.tolist(), strict=True)) == least_reachable(fps, pairs)
    # keys of more than 8 fingerprints are dealt out again by halves of the other segment
    got = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in m.links(rows.coalesce(2), 8).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got) and least_reachable(fps, got) == least_reachable(fps, pairs)


def test_many_fingerprints_that_share_a_half(spark):
    rng = random.Random(4)
    fps = sorted({0x1234ABCD << 32 | rng.getrandbits(32) for _ in range(100_000)})
    rows = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {(r["a"], r["b"]) for r in m.links(rows, 20_000).collect()}
    arr = np.array(fps, np.uint64)
    pairs = []
    for i in range(32):
        for j in range(i + 1):
            other = arr ^ np.uint64(1 << i | 1 << j)
            at = np.minimum(np.searchsorted(arr, other), len(arr) - 1)
            pairs += zip(arr[arr[at] == other].tolist(), other[arr[at] == other].tolist(), strict=True)
    assert all((a ^ b).bit_count() <= 2 for a, b in got) and least_reachable(fps, got) == least_reachable(fps, pairs)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    want = least_reachable(sorted({x for p in pairs for x in p}), pairs)
    assert got == {k: want[k] for k in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_over_few_edges_write_few_files(spark, monkeypatch):
    from quillspark.llm import components as c

    files = []
    monkeypatch.setattr(c, "written", lambda df, name: files.append(len((out := written(df, name)).inputFiles())) or out)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long").repartition(40)
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {r["component"] for r in components(edges).collect()} == {0} and set(files[1:]) == {1} and len(files) > 2
        del files[:]
        monkeypatch.setattr(c, "EDGES_EACH", 20)  # more edges, more tasks
        assert {r["component"] for r in components(edges).collect()} == {0} and max(files[1:]) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def test_query_and_filter(spark):
    base = [f"{w} day by the long river of stones {w} and {w} again it goes on" for w in ("one", "two", "six")]
    rows = [(10, base[0]), (3, base[0].upper()), (7, base[1]), (8, base[1] + " "), (9, base[2]), (11, None), (12, ""), (13, "a"), (9, base[2]), (None, base[1])]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, component string")
    got = m.near_duplicates(docs).collect()
    assert len(got) == len(rows) and all(r["fingerprint"] == f"{brute(next(t for i, t in rows if i == r['doc_id'])):016x}" for r in got)
    by_id = {r["doc_id"]: r["component_id"] for r in got}
    assert by_id == {10: 3, 3: 3, 7: 7, 8: 7, 9: 9, 11: 11, 12: 11, 13: 13, None: 7}
    kept = m.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 9, 11, 13]
    assert m.near_duplicates(docs.limit(0)).count() == 0 and m.keep_first(docs.limit(0)).count() == 0


def test_filter_keeps_one_row_of_each_component_whatever_its_ids(spark):
    text = [f"{w} day by the long river of stones {w} and {w} again it goes on" for w in ("one", "two", "six", "ten", "red")]
    rows = [(3, text[0]), (None, text[0]), (None, text[1]), (None, text[2]), (None, text[2].upper()), (9, text[0] + " "), (9, text[3]), (9, text[3]), (12, text[4]), (12, text[4] + " ")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    got = [(r["doc_id"], " ".join(r["text"].lower().split())) for r in m.keep_first(docs).collect()]
    assert sorted(got, key=lambda r: r[1]) == sorted([(3, text[0]), (None, text[1]), (None, text[2]), (9, text[3]), (12, text[4])], key=lambda r: r[1])


def test_filter_links_texts_of_like_shingles(spark):
    rng = random.Random(8)
    made = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows = []
    for k in range(40):
        words = made(rng.choice([100, 400]))
        rows.append((10 * k, " ".join(words)))
        for i in rng.sample(range(10, len(words) - 10), len(words) // 100):  # each costs five shingles: similarity about 0.9
            words[i] = "changed"
        rows.append((10 * k + 1, " ".join(words)))
        rows.append((10 * k + 2, " ".join(words[: len(words) // 2] + made(len(words) // 2))))  # half alike
    got = {r["doc_id"] for r in m.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, _ in rows if i % 10 != 1} <= got and sum(i % 10 == 1 for i in got) <= 1


def test_large_groups_give_few_pairs():
    from quillspark.llm import near_copies

    many = 500
    args = np.zeros(many, np.int64), np.arange(many), np.full(many, 7, np.uint64), np.full(many, 90)
    assert len(near_copies._pairs(*args, np.arange(many))) == many - 1
    assert len(near_copies._pairs(*args, np.repeat([1, 2], many // 2))) == many // 2
    assert not len(near_copies._pairs(*args, np.zeros(many, np.int64)))


def test_large_groups_lose_no_pair(spark):
    """Followers of a leader may be alike themselves, whatever becomes of their pairs with it."""
    from quillspark.llm import near_copies

    rng = random.Random(12)
    wide = [rng.getrandbits(64) for _ in range(4)]
    rows = []
    for node in range(120):
        w = list(wide)
        for _ in range(rng.randint(0, 8)):
            w[rng.randint(0, 3)] ^= 1 << rng.randint(0, 63)
        rows.append((node, rng.randint(80, 110), node if node < 60 else 60 + node % 2, *(x - (1 << 64) if x >> 63 else x for x in w)))
    nodes = spark.createDataFrame(rows, "node long, n long, part long, w0 long, w1 long, w2 long, w3 long")
    masks = near_copies.MASKS[:40]  # of two calls' worth
    found = near_copies.candidates(nodes, masks)
    led = {(r["a"], r["b"]) for r in found.where("NOT again").collect()}
    rest = {(r["a"], r["b"]) for r in near_copies.remaining(found.where("again").selectExpr("a AS key", "b AS node"), nodes).collect()}
    sigs = np.array([[x & (1 << 64) - 1 for x in r[3:]] for r in rows], np.uint64)
    want = set()
    for a in range(120):
        for b in range(a + 1, 120):
            (_, n, part, w, *_), (_, m_, other, v, *_) = rows[a], rows[b]
            if part != other and min(n, m_) >= 0.8 * max(n, m_) and ((w ^ v) & (1 << 64) - 1).bit_count() <= near_copies.FAR and ((sigs[a] ^ sigs[b]) & masks == 0).all(axis=1).any():
                want.add((a, b))
    assert led <= want and len(led) < len(want) and led | rest == want


def near_copies_of_one_text(rng, many):
    """Texts that are somewhat too far apart to be linked, but for a few."""
    base = [f"w{k}" for k in range(150)]
    for _ in range(many):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([2, 4, 5, 6])):
            words[at] = f"x{rng.randint(0, 10**6)}"
        yield words + ["end"] * rng.randint(0, 1)


def test_near_copies_that_are_too_far_apart_give_few_pairs(spark, monkeypatch):
    """Pairs across components in a large group are found by rare shingles: all that are like enough, and few others."""
    from quillspark.llm import near_copies

    rng = random.Random(3)
    texts = list(near_copies_of_one_text(rng, 200))
    for k in range(0, 40, 2):  # like their own original: a few words more or less, or changed
        words = list(texts[k])
        at = rng.randint(20, 120)
        texts.append(words[: rng.randint(125, 150)] if k % 4 else [*words[:at], "new", *words[at + rng.randint(0, 5) :]])
    texts = [" ".join(t) for t in texts]
    sets = [set(near_copies.shingles(t.encode()).tolist()) for t in texts]
    part = [k if k % 3 else 0 for k in range(len(texts))]  # a large component and single texts
    nodes = spark.createDataFrame([(k, len(x), part[k]) for k, x in enumerate(sets)], "node long, n long, part long")
    again = spark.createDataFrame([(key, k) for k in range(len(texts)) for key in (5, 6)], "key long, node long")
    found = near_copies.overlapping(again, nodes, spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    got = {(r["a"], r["b"]) for r in found.collect()}
    pairs = [(a, b) for b in range(len(texts)) for a in range(b) if part[a] != part[b]]
    want = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert all(part[a] != part[b] for a, b in got) and want <= got and len(want) > 60
    assert len(got) < len(pairs) / 10
    # in the whole filter, too
    counts, verified = [], near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda pairs, texts: counts.append(pairs.count()) or verified(pairs, texts))
    many = [" ".join(t) for t in near_copies_of_one_text(rng, 500)]
    m.keep_first(spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")).count()
    assert len(counts) == 3 and counts[2] < 5 * len(many)


def test_overlapping_without_anything_to_find(spark):
    from quillspark.llm import near_copies

    nodes, texts = spark.createDataFrame([(1, 1, 7), (2, 1, 7)], "node long, n long, part long"), spark.createDataFrame([(1, "a"), (2, "b")], "node long, text string")
    again = spark.createDataFrame([(5, 1), (5, 2)], "key long, node long")
    assert not near_copies.overlapping(again, nodes, texts).count() and not near_copies.overlapping(again.limit(0), nodes, texts).count()
    apart = spark.createDataFrame([(1, 1, 7), (2, 1, 8)], "node long, n long, part long")
    assert not near_copies.overlapping(again, apart, texts).count()
    assert near_copies.overlapping(again, apart, texts.selectExpr("node", "'A b' AS text")).count() == 1


def test_filter_deals_documents_out_once(spark):
    rows = [(k, f"{k} is a text of some words") for k in range(30)]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = m.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    join, window = plan.index("LeftSemi"), plan.index("Window")
    assert join < window and "Exchange" not in plan[join:window]


def test_filter_keeps_columns_of_any_name(spark):
    rows = [(1, "one text of some words", 7, 8), (2, "one text of some words", 9, 10), (None, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, key int").selectExpr("*", "1 AS _none", "2 AS nth", "3 AS _nth", "4 AS fp", "5 AS Hash")
    kept = m.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["_id"], r["key"], r["nth"], r["fp"]) for r in kept.collect()) == [(0, 1, 2, 2, 4), (1, 7, 8, 2, 4)]


def test_filter_leaves_only_tables_that_its_result_reads(spark):
    from quillspark.llm.common import made

    rng = random.Random(8)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(60)) for _ in range(20)]
    docs = written(spark.createDataFrame([(i, base[i % 20] + (" z" if i % 3 == 0 else "")) for i in range(60)], "doc_id long, text string"), "docs")
    older = made()
    kept = m.keep_first(docs)
    read, left = {path.rsplit("/", 2)[-2] for path in kept.inputFiles()}, {path.rsplit("/", 1)[-1] for path in made() if path not in older}
    assert left and left <= read and set(older) <= set(made())
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20))
