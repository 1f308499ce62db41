from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from quillspark.llm import curriculum as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights=m.WEIGHTS, most=m.MOST):
    """Targets by giving out shares again until none is above its cap, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in done]
        share = {s: Fraction(weight[s] * (total - sum(done.values())), sum(weight[x] for x in left)) for s in left}
        above = [s for s in left if share[s] > most * sizes[s]]
        if not above:
            return done | share, weight
        done |= {s: Fraction(most * sizes[s]) for s in above}


def integral(knots, t):
    done = whole = 0.0
    for (a, h), (b, g) in zip(knots, knots[1:], strict=False):
        whole += (b - a) * (h + g) / 2
        x = min(max(t - a, 0), b - a)
        done += x * h + (g - h) / (b - a) * x * x / 2
    return done / whole


def brute(docs):
    size = lambda t: len(WORD.findall(t or ""))
    held = defaultdict(list)
    for doc_id, text, source in docs:
        inner = hashlib.md5((text or "").encode()).hexdigest()
        held[source].append((hashlib.md5(f"{m.SEED}:{'' if doc_id is None else doc_id}:{inner}".encode()).hexdigest(), doc_id, size(text)))
    sizes = {s: sum(x[2] for x in rows) for s, rows in held.items()}
    aim, weight = filled(sizes)
    out = []
    for s, rows in held.items():
        start = 0
        for _, doc_id, n in sorted(rows, key=lambda r: r[0]):
            taken = [max(0, min(n, int(aim[s]) - start - i * sizes[s])) for i in range(m.MOST)]
            out.append((doc_id, n, sizes[s], float(aim[s]), sum(taken), weight[s], [start + i * sizes[s] for i in range(m.MOST) if taken[i]], [x for x in taken if x]))
            start += n
    return out


def documents(rng, n, sources):
    text = lambda: rng.choice([None, "", " \t ", "one", " ".join(rng.choice(["a", "bé", "c d", "e\x0bf"]) for _ in range(rng.randint(1, 60)))])
    return [(i, text(), rng.choice(sources)) for i in range(n)]


def check(spark, docs):
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, source string, size int, draw string").repartition(3)
    mixed = m.mix(df)
    got, want = [r.asDict() for r in mixed.collect()], brute(docs)
    first = lambda x: (repr(x[0]), *x[1:5])
    a = sorted(first((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"])) for r in got)
    assert a == sorted(first((*w[:3], round(w[3], 6), w[4])) for w in want)
    by_source = defaultdict(int)
    for w in want:
        by_source[w[2:4]] += w[4]
    assert all(abs(n - target) <= 1 or n % int(target) == 0 for (_, target), n in by_source.items() if target >= 1)
    at = [r["position"] for r in got if r["position"] is not None]
    assert at == sorted(at) and all(r["position"] is None for r in got[len(at) :]) and all((r["taken"] > 0) == (r["position"] is not None) for r in got)
    # positions are where the integral of the schedule meets the supply
    waits = defaultdict(list)
    for w in want:
        waits[repr(w[0]), w[1], w[2], w[4]].append(w)
    for r in got:
        mine = waits[repr(r["doc_id"]), r["size"], r["source_size"], r["taken"]]
        fit = [w for w in mine if [p["words"] for p in r["passes"]] == w[7] and all(abs(integral(m.SCHEDULES[w[5]], p["position"]) * w[3] - s) < 1e-6 * (1 + w[3]) for p, s in zip(r["passes"], w[6], strict=True))]
        assert fit
    order = m.training_order(mixed).collect()
    assert sum(r["words"] for r in order) == sum(w[4] for w in want) and [r["position"] for r in order] == sorted(r["position"] for r in order)
    return mixed


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "b", "é", "Z", "zz"] + ["hot"] * 6
    docs = documents(rng, 150, sources[: 5 + 4 * seed])
    mixed = check(spark, docs)
    assert "Python" not in mixed._jdf.queryExecution().executedPlan().toString()
    again = m.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, mixed.collect()))


def test_repeated_rows_nulls_and_empty(spark):
    check(spark, [(1, "a b c", "x")] * 30 + [(None, "p q", "x"), (None, "p q", None), (None, None, None), (2, "long " * 5000, "y"), (3, "w", "y")])
    check(spark, [(1, None, "x"), (2, "", None)])
    assert m.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_columns_asked_for_come_along(spark):
    df = spark.createDataFrame([(1, "a b", "x", "kept", 5), (2, "c", "y", "too", 6)], "doc_id long, text string, source string, draw string, tie int")
    got = m.mix(df, keep=("draw", "tie", "text"))
    assert {(r["doc_id"], r["draw"], r["tie"], r["text"], r["size"]) for r in got.collect()} == {(1, "kept", 5, "a b", 2), (2, "too", 6, "c", 1)}


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_filled(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, 10**6]) for i in range(rng.randint(1, 40))}
    rows = spark.createDataFrame([(False, s, n) for s, n in sizes.items()], "no_source boolean, source string, source_size long")
    aim, _ = filled(sizes)
    got = {r["source"]: r["target"] for r in m.targets(rows).collect()}
    assert got.keys() == aim.keys() and all(abs(got[s] - float(aim[s])) <= 1e-9 * float(aim[s]) for s in aim)


def test_schedules_are_checked():
    for bad in (((0.0, 1.0), (0.5, 1.0)), ((0.0, -1.0), (1.0, 3.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, 1.0), (0.0, 1.0), (1.0, 1.0))):
        with pytest.raises(ValueError):
            m.segments(bad)
