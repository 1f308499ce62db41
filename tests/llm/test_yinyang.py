from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from quillspark.llm import yinyang as m


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * float(a)) for a in v]) for i, v in rows if v is not None and len(v) == dim and all(a is not None and math.isfinite(a) for a in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(held[j]) for x in zip(*held[j], strict=True)] if j in held else c for j, c in enumerate(centroids)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, d, c in last if c == j) for j in range(len(centroids))]
    most = lambda v: min(v, m.MOST)
    return sorted(((i, c, most(d), most(inertia[c]), most(sum(inertia)), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, d, c in last), key=repr)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string").repartition(3)
    return sorted((tuple(r) for r in m.yinyang(df, **how).collect()), key=repr)


def vectors(rng, n, spread, around=12, dim=64):
    middles = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(around)]
    return [[a + rng.gauss(0, spread) for a in rng.choice(middles)] for _ in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_lloyd_and_leaves_distances_out(spark, spread):
    rng = random.Random(int(spread * 100))
    rows = list(enumerate(vectors(rng, 400, spread)))
    computed = []
    assert got(spark, rows, report=computed) == brute(rows)
    assert len(computed) == 11 and computed[0] == 400 * 8
    if spread < 1:
        assert sum(computed[1:]) < 0.5 * 10 * 400 * 8


def test_many_groups_and_ties(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(4)]) for i in range(300)]  # many equal distances
    for groups in (1, 3, 20):
        assert got(spark, rows, dim=4, k=20, rounds=6, groups=groups) == brute(rows, 20, 6, 4)


def test_odd_rows(spark):
    rng = random.Random(2)
    good = vectors(rng, 12, 0.5)
    bad = [None, [], good[0][:63], good[0] + [1.0], [None, *good[0][1:]], [float("nan"), *good[0][1:]], [float("inf"), *good[0][1:]]]
    rows = [(i, v) for i, v in enumerate(good + bad)] + [(None, good[3]), (None, good[4]), (5, good[5]), (5, good[6]), (7, good[7])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(i, good[0]) for i in range(40)]) == brute([(i, good[0]) for i in range(40)])  # clusters without vectors
    assert got(spark, rows[:3]) == brute(rows[:3])
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []


def test_components_of_any_size_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1e-3, 1.0, 3e4, 1e12, 3e38]) * rng.uniform(-1, 1) for _ in range(64)]) for i in range(60)] + [(100 + i, [rng.uniform(-3e4, 3e4) for _ in range(64)]) for i in range(40)]
    assert got(spark, rows, rounds=3) == brute(rows, rounds=3)


def test_query_form_of_floats(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(vectors(rng, 50, 0.3))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in m.yinyang(df).collect()), key=repr) == brute(rows)


def test_sums_are_cut_and_put_together():
    for v in (0, 1, -1, 1 << 30, -(1 << 95) + 12345, 10**40):
        assert sum(p << (m.LIMB * place) for place, p in m.limbs(v)) == v
