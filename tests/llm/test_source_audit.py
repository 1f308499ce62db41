from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillspark.llm import source_audit as m

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs=3, top=200):
    words, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(text.translate(ASCII))
        groups[lang].add(source)
        words[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        everywhere = Counter()
        for s in sources:
            everywhere.update(words[lang, s])

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // n for t in kept}

        p, q = {s: shares(words[lang, s]) for s in sources}, shares(everywhere)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def got(spark, docs, **how):
    df = spark.createDataFrame([(i, *d, 3, "x") for i, d in enumerate(docs)], "doc_id int, text string, lang string, source string, n int, term string").repartition(3)
    df = m.source_audit(df, **how)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "THE", "É", "é", "İstanbul", "K", "don't", "a-b", "x1y", "日本", "😀", "\u0080", "zz", "[w]", "@", "ſ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    docs = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "", "é"])) for _ in range(150)]
    assert got(spark, docs, top=20) == brute(docs, top=20)


def test_groups_without_terms_and_ties(spark):
    docs = [("one two", "en", "a"), ("one two", "en", "b"), ("one", "en", "c"), (None, "en", "d"), ("12 34", "en", "e"), ("rare", "fr", "a"), ("rare", "fr", "b"), ("", "fr", "c"), ("x", None, None)]
    docs += [("same same", "es", s) for s in "abc"] * 2 + [("tie tea", "it", "a")] * 3 + [("other", "it", "b")] * 3
    assert got(spark, docs) == brute(docs)
    assert got(spark, []) == []
    assert got(spark, [(None, None, None)]) == []


def test_long_text_and_hot_source(spark):
    rng = random.Random(7)
    docs = [("word " * 200_000 + "once", "en", "hot")] + [(" ".join(rng.choices("abcdefghij", k=8)), "en", "hot") for _ in range(100)] + [(" ".join(rng.choices("abcxyz", k=8)), "en", f"s{i % 5}") for i in range(40)]
    assert got(spark, docs) == brute(docs)


def test_shares_are_exact_at_any_size(spark):
    pairs = [(1, 3), (9_223_372_035, 10**10), (9_223_372_036, 10**10), (10**15, 10**15 + 7), (123456789012345678, 9 * 10**18)]
    df = spark.createDataFrame(pairs, "n long, total long").select("n", "total", m.share(F.col("n"), F.col("total")).alias("p"))
    assert all(r["p"] == 1 + 10**9 * r["n"] // r["total"] for r in df.collect())


def test_one_exchange_serves_both_sides(spark):
    docs = spark.createDataFrame([("a b c", "en", s) for s in "abcd"] * 3, "text string, lang string, source string")
    df = m.source_audit(docs)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
