from __future__ import annotations

import random

import numpy as np

from quillspark.llm import weak_quality as m


def test_estimates_come_near_the_truth():
    rng = np.random.RandomState(3)
    k = len(m.LABELLERS)
    good, right = 0.8, np.stack([np.linspace(0.5, 0.9, k), np.linspace(0.99, 0.9, k)], 1)
    patterns: dict[int, int] = {}
    truth = rng.rand(40000) < good
    for t in truth:
        says = rng.rand(k) < right[:, int(t)]
        vote = np.where(rng.rand(k) < 0.2, m.NONE, np.where(says == t, m.GOOD, m.BAD))
        code = int((vote * 3 ** np.arange(k)[::-1]).sum())
        patterns[code] = patterns.get(code, 0) + 1
    model = m.estimate(patterns)
    assert abs(model.good - good) < 0.03 and np.abs(model.right - right).max() < 0.06
    assert model.of(int(sum(m.GOOD * 3**i for i in range(k)))) > 0.99 and model.of(int(sum(m.BAD * 3**i for i in range(k)))) < 0.01
    assert abs(m.LabelModel(good, right).of(int(sum(m.NONE * 3**i for i in range(k)))) - good) < 1e-9


def texts():
    rng = random.Random(1)
    common = "the of and with for that on was".split()
    made = lambda: "".join(rng.choice(["ri", "ver", "ho", "use", "sto", "ne", "let", "ter", "gre", "en"]) for _ in range(rng.randint(1, 4)))
    sentence = lambda: " ".join(rng.choice(common) if rng.random() < 0.3 else made() for _ in range(9)).capitalize() + "."
    for i in range(300):
        plain = "\n".join(sentence() for _ in range(9))
        bad = [lambda: plain.upper().replace(" ", "!! ").replace("\n", "!! "), lambda: " | ".join(made() for _ in range(80)), lambda: "word " * 80, lambda: "\n".join(["Same line here again"] * 30)]
        yield i, bad[i % 4]() if i % 5 == 0 else plain, i % 5 != 0


def test_scorer_finds_bad_documents(spark):
    rows = list(texts())
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(900, None, 0.5), (901, "", 0.5), (None, "Hello there.", 0.5)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r for r in m.weak_quality(docs).collect()}
    assert len(got) == 303
    assert sum(got[i]["kept"] == good for i, _, good in rows) >= 295
    assert all(got[i]["kept"] for i, _, good in rows if good)
    assert got[900]["kept"] and got[900]["score"] == got[901]["score"] and got[None]["kept"]
    assert m.weak_quality(docs.limit(0)).count() == 0


def test_every_labeller_can_vote_both_ways():
    seen = {name: set() for name in m.LABELLERS}
    for _, t, _ in texts():
        raw = t.encode()
        f = m.facts(raw, raw.lower().split())
        for name, labeller in m.LABELLERS.items():
            seen[name].add(labeller(f))
    assert all({m.BAD, m.GOOD} <= s for s in seen.values()), seen


def test_rows_without_ids_are_sampled_like_others(spark, monkeypatch):
    rows = [(None, f"{t} {i}") for i in range(30) for _, t, _ in list(texts())[:20]] + [(None, "the same text again")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(m, "train", lambda sample, good: seen.append(len(sample)) or m.Scorer(np.zeros(m.BUCKETS), 0.0))
    m.fit(docs, rows=100)
    assert 0 < seen[0] <= 100


def test_posteriors_and_scores_are_those_of_brute_force(spark):
    """Expectation-maximisation and the trained scorer's sums, recomputed plainly from the texts."""
    rows = [(i, t) for i, t, _ in texts()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels, scorer = m.fit(docs)
    names = list(m.LABELLERS)
    votes = [[m.LABELLERS[n](m.facts(t.encode(), t.lower().encode().split())) for n in names] for _, t in rows]
    good, right = 0.8, [[0.4, 0.97] for _ in names]

    def posterior(vote):
        up, down = good, 1 - good
        for v, (bad_right, good_right) in zip(vote, right, strict=True):
            if v != m.NONE:
                up *= good_right if v == m.GOOD else 1 - good_right
                down *= bad_right if v == m.BAD else 1 - bad_right
        return up / (up + down)

    for _ in range(100):
        p = [posterior(v) for v in votes]
        good = min(0.99, max(0.01, sum(p) / len(p)))
        new = []
        for j in range(len(names)):
            cast = [(q, v[j]) for q, v in zip(p, votes, strict=True) if v[j] != m.NONE]
            of = lambda kind: (sum((q if kind else 1 - q) for q, v in cast if v == (m.GOOD if kind else m.BAD)) + 1) / (sum((q if kind else 1 - q) for q, _ in cast) + 2)  # noqa: B023, E731
            new.append([min(0.995, max(0.02, of(k))) for k in (0, 1)])
        moved = max(abs(a - b) for x, y in zip(right, new, strict=True) for a, b in zip(x, y, strict=True))
        right = new
        if moved < 1e-9:
            break
    import re
    import zlib

    half = m.BUCKETS // 2
    for r in m.weak_quality(docs, model=(labels, scorer)).collect():
        text = dict(rows)[r["doc_id"]]
        vote = votes[r["doc_id"]]
        assert r["votes"] == "".join("BG-"[v] for v in vote) and abs(r["posterior"] - posterior(vote)) < 1e-6
        words = text.lower().encode().split()
        z = [m.REPEAT if i and w == words[i - 1] else 1 + zlib.crc32(w) % (half - 1) for i, w in enumerate(words)]
        shape = lambda w: re.sub(r"(.)\1+", r"\1", "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in w))
        z += [half + zlib.crc32(shape(w).encode()) % half for w in text.split()]
        score = 1 / (1 + np.exp(-(scorer.bias + sum(scorer.weights[b] for b in z) / (len(z) + m.LITTLE))))
        assert abs(r["score"] - score) < 1e-9 and r["kept"] == (r["score"] >= m.KEEP_FROM)
