from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import quality_rules as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t: str) -> tuple:
    words = WORD.findall(t)
    at: dict[tuple, list[int]] = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines, copies = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            copies += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), copies, len(covered), n < 10 or 100 * len(covered) > 20 * n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the é", "\n", "x # y", "\t", "\x85", "\x1c", "日本", "a b a b a b", " \n \n", "|<>"]), max_size=30).map(" ".join))
def test_counts_are_those_of_brute_force(t):
    got = m.judge(t.encode(), None, None)
    assert got[:6] == brute(t) and got[6] == (not got[5])


def test_distance_is_that_of_its_definition():
    p, q = np.array([3.0, 1, 0]), np.array([0.2, 0.3, 0.5])
    s = p / p.sum()
    mid = (s + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, mid, strict=True) if x)
    assert abs(m.distance(p, q) - np.sqrt((kl(s) + kl(q)) / 2)) < 1e-12
    assert m.distance(p, s) < 1e-7
    assert abs(m.distance(np.array([1.0, 0]), np.array([0.0, 1.0])) - 1) < 1e-12


def test_rows_and_filter(spark):
    rng = random.Random(1)
    common = "the of and with for that on was".split()
    made = lambda: "".join(rng.choice(["ri", "ver", "ho", "use", "sto", "ne"]) for _ in range(rng.randint(1, 4)))
    sentence = lambda: " ".join(rng.choice(common) if rng.random() < 0.3 else made() for _ in range(9)).capitalize() + "."
    rows = [(i, " ".join(sentence() for _ in range(12)), "en") for i in range(30)]
    junk = " ".join(f"{w}%%%" if k % 2 else f"{w}###$$" for k, w in enumerate(f"q{i}z" for i in range(90)))
    rows += [(50, junk, "en"), (51, None, "en"), (52, "", None), (53, "short", "xx"), (None, rows[0][1], None), (54, "same words again " * 40, "en")]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, kept boolean")
    got = {r["doc_id"]: r for r in m.quality_rules(docs).collect()}
    for i, t, _ in rows:
        r = got[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute(t or "")
    assert not got[50]["base_failed"] and not got[50]["kept"]
    assert sum(got[i]["kept"] for i in range(30)) == 30 and got[None]["kept"]
    kept = m.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}
    assert m.quality_rules(docs.limit(0)).count() == 0


def test_word_rule_rejects_alone(spark):
    rng = random.Random(2)
    common = "the of and with for that on was".split()
    made = lambda: "".join(rng.choice(["ri", "ver", "ho", "use", "sto", "ne"]) for _ in range(rng.randint(1, 4)))
    sentence = lambda share: " ".join(rng.choice(common) if rng.random() < share else made() for _ in range(9)).capitalize() + "."
    rows = [(i, " ".join(sentence(0.24) for _ in range(n)), "en") for i, n in enumerate([8, 12, 20, 50, 2000] * 12)]
    rows += [(100 + n, " ".join(sentence(0) for _ in range(n)), "en") for n in (8, 12, 50, 200)] + [(900, " ".join(sentence(0.04) for _ in range(60)), "en")]
    got = {r["doc_id"]: r for r in m.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, r in got.items():
        assert not r["base_failed"] and (r["class_distance"] or 0) <= m.MAX_CLASS_DISTANCE and r["kept"] == (i < 100)


def test_languages_without_a_reference_are_not_judged_by_histograms(spark):
    rng = random.Random(3)
    english = lambda n: " ".join(rng.choice("the of and with for river house stone morning letter".split()) + str(rng.randint(0, 9)) * (rng.random() < 0.02) for _ in range(n)).capitalize() + "."
    russian = lambda n: " ".join("".join(rng.choice("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё") for _ in range(rng.randint(2, 9))) for _ in range(n)) + "."
    rows = [(i, english(120), "en") for i in range(20)] + [(50, russian(200), None), (51, russian(20), "uk")] + [(60 + i, russian(1500), "ru") for i in range(9)] + [(80, "%$#&| " * 3 + russian(120).replace(" ", " <#$> "), "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["lang"] for r in m.references(docs).collect()) == ["en", "ru"]
    got = {r["doc_id"]: r for r in m.quality_rules(docs).collect()}
    assert got[50]["kept"] and got[51]["kept"] and got[50]["class_distance"] is None and got[51]["word_distance"] is None and got[60]["word_distance"] is not None
    assert all(got[60 + i]["kept"] and got[60 + i]["class_distance"] < 0.2 for i in range(9))
    assert not got[80]["kept"] and got[80]["class_distance"] > m.MAX_CLASS_DISTANCE


def many_languages():
    """300 languages with words of their own, the same letters in all; of each a text of the language of the next one."""
    rng = random.Random(4)
    letters = "abcdefghij"
    rows = []
    for k in range(300):
        common = ["".join(rng.choice(letters) for _ in range(3)) + letters[k % 10] for _ in range(12)]
        rare = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(400)]
        text = lambda: " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(150))  # noqa: B023, E731
        rows += [(10 * k + i, text(), f"l{k}") for i in range(4)] + [(10 * k + 5, text(), f"l{(k + 1) % 300}")]
    return rows


def test_every_language_has_a_reference_of_its_own_words(spark, monkeypatch):
    rows = many_languages()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    refs = {r["lang"]: r["ref"] for r in m.references(docs).collect()}
    assert len(refs) == 300
    for lang in ("l0", "l7", "l299"):
        texts = [t for _, t, k in rows if k == lang]
        words = [w.encode() for t in texts for w in t.split()]
        top = sorted(((-words.count(w), w) for w in set(words)))[: m.COMMON]
        assert [(-n, w) for n, w in top] == list(zip(refs[lang]["counts"], map(bytes, refs[lang]["words"]), strict=True))
        assert refs[lang]["n_words"] == len(words) and sum(refs[lang]["classes"]) == sum(map(len, texts))
    got = {r["doc_id"]: r for r in m.quality_rules(docs).collect()}
    assert all(r["kept"] == (i % 10 < 4) for i, r in got.items())
    monkeypatch.setattr(m, "BROADCAST_LANGS", 10)
    monkeypatch.setattr(m, "HELD_COUNTS", 50)
    assert {r["doc_id"]: r for r in m.quality_rules(docs).collect()} == got


def test_columns_of_any_name(spark):
    rows = [(i, "some words of a text that is long enough to pass every rule here", "en", 1, 2) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, ref int, lang_of int")
    kept = m.keep_good(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows
    assert m.quality_rules(docs, id_col="lang").columns[0] == "lang"
