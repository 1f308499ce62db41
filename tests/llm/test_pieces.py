from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quillspark.llm import language_id, sampled_pieces
from quillspark.llm import lattice as m
from quillspark.llm.lattice import build, exact_parts, forward, log_whole, pieces_of, posteriors, shares

LONG = [" electroencephalographically" * 2, " " + "antidisestablishmentarianism" * 2, "人人生而自由在尊严和权利上一律平等" * 4, " " * 61, "=" * 90, " aaaabbbb" + "ab" * 20 + "é" * 20 + "the" * 11]
ODD = ["", " ", "  two  ", "a▁b ▁", "日本語 😀\U0010ffff", "tab\tline\n\r end", "\0nul\0", "x" * 300, " " * 90, "Ünïcödé, ok?", "word " * 50]


def segmentations(text: bytes, known: dict[bytes, int], weights: np.ndarray):
    if not text:
        yield (), 1.0
    for k in range(1, len(text) + 1):
        i = known.get(text[:k])
        if i is not None:
            for rest, p in segmentations(text[k:], known, weights):
                yield (i, *rest), weights[i] * p


@pytest.fixture(scope="module")
def sampler():
    return sampled_pieces.Sampler()


@pytest.fixture(scope="module")
def known(sampler):
    return {p: i for i, p in enumerate(sampler.pieces.text) if sampler.weights[i] > 0}


def test_decoding_is_lossless(sampler):
    ids = sampler.encode(list(range(len(ODD))), ODD)
    assert [sampler.decode(x.tolist()) for x in ids] == ODD
    assert not len(ids[0])


def test_pieces_depend_on_key_and_text_alone(sampler):
    together = sampler.encode(list(range(len(ODD))), ODD)
    for i, text in enumerate(ODD):
        assert (sampler.encode([i], [text])[0] == together[i]).all()
    long = "the river runs under the bridge again and again " * 20
    a, b = sampler.encode([1, 2], [long, long])
    assert a.tolist() != b.tolist()


@pytest.mark.parametrize("word", ["them", "bridges"])
def test_draws_follow_the_lattice(sampler, known, word):
    want = dict(segmentations(f" {word}".encode(), known, sampler.weights))
    total, n = sum(want.values()), 20000
    got = Counter(tuple(x.tolist()) for x in sampler.encode([sampled_pieces.row_key(i) for i in range(n)], [word] * n))
    assert set(got) <= set(want)
    for s, p in want.items():
        p /= total
        assert abs(got[s] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-9


def plain_sums(text: str, known: dict[bytes, int], weights: np.ndarray, unknown: float):
    """Logs of the sums of all segmentations up to, and from, each code point, in Python's whole precision; and the edges."""
    from fractions import Fraction

    edges = []
    for a in range(len(text)):
        found = [(a, b, known[t], weights[known[t]]) for b in range(a + 1, len(text) + 1) if (t := text[a:b].encode()) in known]
        edges += found if any(b == a + 1 for _, b, *_ in found) else [*found, (a, a + 1, -1, unknown)]
    up, down = [Fraction(0)] * (len(text) + 1), [Fraction(0)] * (len(text) + 1)
    up[0] = down[-1] = Fraction(1)
    for a, b, _, w in sorted(edges, key=lambda e: e[1]):
        up[b] += up[a] * Fraction(w)
    for a, b, _, w in sorted(edges, key=lambda e: -e[0]):
        down[a] += down[b] * Fraction(w)
    return up, down, edges


def log(x) -> float:
    import math

    return math.log(x.numerator) - math.log(x.denominator)


@pytest.mark.parametrize("units", [[" the", " bridge", " añb", " zz"], LONG, [" the", *LONG[:3]]])
def test_sums_over_all_segmentations(known, units):
    pieces = pieces_of()
    weights = np.vstack([np.random.RandomState(0).rand(pieces.size, 2) * [1e-6, 0.5], [[1e-7, 1e-3]]])
    lattice = build(units, pieces)
    w = weights[lattice.piece]
    sums = forward(lattice, w)
    logs, share = log_whole(lattice, sums), shares(lattice, w, sums)
    for k in range(2):
        chance = posteriors(lattice, share[:, k])
        for i, unit in enumerate(units):
            up, down, edges = plain_sums(unit, known, weights[:, k], weights[-1, k])
            assert np.isclose(logs[i, k], log(up[-1]), rtol=1e-9)
            rows = np.flatnonzero((lattice.start >= lattice.first[i]) & (lattice.start < lattice.first[i + 1]))
            place = lambda x, i=i: x - lattice.first[i]
            found = {(int(place(lattice.start[r])), int(place(lattice.stop[r]))): (chance[r], share[r, k]) for r in rows}
            assert set(found) == {(a, b) for a, b, *_ in edges}
            for a, b, _, x in edges:
                from fractions import Fraction

                assert np.isclose(found[a, b][0], float(up[a] * Fraction(x) * down[b] / up[-1])) and np.isclose(found[a, b][1], float(up[a] * Fraction(x) / up[b]))


def test_draws_in_long_units_follow_the_lattice(sampler, known):
    """How often a place inside a long word is a border between pieces."""
    text, n = LONG[0][1:], 4000
    up, down, _ = plain_sums(" " + text, known, sampler.weights, 0)
    want = [float(u * d / up[-1]) for u, d in zip(up, down, strict=True)]
    seen = np.zeros(len(text) + 2)
    for ids in sampler.encode([sampled_pieces.row_key(i) for i in range(n)], [text] * n):
        seen[np.cumsum([len(sampler.pieces.text[i]) for i in ids.tolist()])] += 1
    for got, p in zip(seen[1:].tolist(), want[1:], strict=True):
        assert abs(got / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-9


def test_long_texts_in_parts(sampler, monkeypatch):
    pieces = pieces_of()
    text = "".join(np.random.RandomState(3).choice(["the", "=", "é", "日", "qq", "ing"], 900))
    whole = log_whole(*(lambda x: (x, forward(x, sampler.weights[x.piece][:, None] + 1e-9)))(build([text], pieces)))[0, 0]
    monkeypatch.setattr(m, "MOST", 50)
    parts = exact_parts(text, pieces)
    assert "".join(parts) == text and len(parts) > 5
    lattice = build(parts, pieces)
    assert np.isclose(log_whole(lattice, forward(lattice, sampler.weights[lattice.piece][:, None] + 1e-9)).sum(), whole)
    long = "some words and " * 300 + "=" * 400 + text
    for codes in (1000, 1 << 21):
        monkeypatch.setattr(sampled_pieces, "MOST_CODES", codes)
        ids = sampler.encode([5, 6], [long, "short"])
        assert [sampler.decode(x.tolist()) for x in ids] == [long, "short"]
        assert codes == 1000 or (ids[0] == was).all()
        was = ids[0]


def test_expected_counts(known):
    pieces = pieces_of()
    weights = np.random.RandomState(1).rand(pieces.size + 1, 1)
    got = language_id.expected(["the", "ring"], np.array([2, 3]), pieces, weights)
    want = np.zeros(pieces.size)
    for word, n in (("the", 2), ("ring", 3)):
        found = list(segmentations(f" {word}".encode(), known, weights[:, 0]))
        total = sum(p for _, p in found)
        for s, p in found:
            for i in s:
                want[i] += n * p / total
    assert np.allclose(got, want)


def test_encode_and_decode_tables(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD) if "\0" not in t] + [(90, None, 1), (None, "no key", 1), (None, "no key", 1)], "doc_id long, text string, pieces int")
    encoded = sampled_pieces.encode(docs)
    back = sampled_pieces.decode(encoded)
    want = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == want
    found = {(r["doc_id"], r["decoded_sha256"]) for r in sampled_pieces.digests(docs).collect()}
    assert found == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in want}
    assert encoded.where("doc_id IS NULL").distinct().count() == 1
    assert sampled_pieces.digests(docs.limit(0)).count() == 0


SENTENCES = {
    "en": "the river and the house with a letter for that morning of stone which was on the table they should bring",
    "de": "der fluss und das haus mit einem brief auf den tisch die sich nicht ohne schwester schreiben wollte zwischen",
    "fr": "le fleuve et la maison avec une lettre pour les enfants qui sont dans cette ville toujours heureux jamais",
}


def language_rows():
    rng = np.random.RandomState(2)
    for i in range(240):
        lang = list(SENTENCES)[i % 3]
        yield i, " ".join(rng.choice(SENTENCES[lang].split(), 12)), lang


def test_language_accuracy_and_edges(spark):
    rows = list(language_rows())
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 !?", "en"), (902, "the house", None), (None, "la maison avec les enfants", "en")], "doc_id long, text string, lang string").withColumnRenamed("lang", "lang")
    got = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    held = [i for i, *_ in rows if got[i]["held_out"]]
    assert 30 < len(held) < 90
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows if i in set(held)) >= 0.95 * len(held)
    assert (got[900]["lang_pred"], got[900]["score"], got[901]["lang_pred"]) == ("und", 0.0, "und")
    assert got[902]["lang_pred"] == "en" and got[None]["lang_pred"] == "fr" and not got[None]["held_out"]
    import zlib

    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}
    assert language_id.language_id(docs.limit(0)).count() == 0
    blank = docs.selectExpr("doc_id", "text", "CAST(null AS string) AS lang")
    assert {r["lang_pred"] for r in language_id.language_id(blank).collect()} == {"und"}


def test_held_out_labels_teach_nothing(spark):
    rows = list(language_rows())
    import zlib

    lie = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    model = language_id.fit(spark.createDataFrame(lie, "doc_id long, text string, lang string"))
    assert model.langs == sorted(SENTENCES)


FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa",
    "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待人人有资格享有本宣言所载的一切权利和自由不分种族肤色性别语言宗教",
    "junk": "qwzx kjhg pfvv xxcv bnmz wrtp lkjh gfds mnbv cxzq plmk oijn uhby gvtf crdx zzxq wwkj ppqz",
    "code": "for (int i = 0; i < n; i++) { if (buffer[i] == NULL) return -1; struct node *next = malloc(sizeof(node)); next->left = next->right = NULL; }",
}


def test_unlearned_languages_and_junk_are_not_kept(spark):
    rows = list(language_rows())
    docs = spark.createDataFrame([*rows, *((1000 + i, t, None) for i, t in enumerate(FOREIGN.values()))], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language_id.keep_known(docs).collect()}
    assert not kept & set(range(1000, 1010)) and len(kept) >= 0.99 * len(rows)


def test_scores_are_those_of_brute_force(spark, known):
    """Predictions recomputed from the model's weights, word by word."""
    model = language_id.fit(spark.createDataFrame(list(language_rows()), "doc_id long, text string, lang string"))
    texts = [t for _, t, _ in list(language_rows())[:6]] + [FOREIGN["zh"], "electroencephalographically yours", "12", None]
    langs, scores, _ = language_id.predict(texts, model, pieces_of())
    for text, lang, score in zip(texts, langs, scores, strict=True):
        words = language_id.words_of(text or "")
        if not words:
            assert (lang, score) == ("und", 0.0)
            continue
        logs = np.array([sum(log(plain_sums(" " + w, known, model.weights[:, k], language_id.UNKNOWN)[0][-1]) for w in words) for k in range(len(model.langs))])
        odds = np.exp(logs - logs.max())
        assert lang == model.langs[logs.argmax()] and np.isclose(score, 1 / odds.sum())


def test_more_languages_than_are_scored_at_a_time(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for k in range(230):
        own = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(2, 7))) for _ in range(20)]
        rows += [(100 * k + i, " ".join(rng.choice(own) for _ in range(40)), f"l{k:03}") for i in range(6 + k % 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit(docs)
    assert len(model.langs) == 230 and model.weights.shape[1] == 230 and len(model.gains) == 230
    truth = {i: lang for i, _, lang in rows}
    got = {r["doc_id"]: r for r in language_id.language_id(docs, model=model).collect()}
    unseen = [i for i, r in got.items() if r["held_out"]]
    assert len(unseen) > 200 and sum(got[i]["lang_pred"] == truth[i] for i in unseen) >= 0.97 * len(unseen)
    texts = [t for _, t, _ in rows[:40]]
    before = language_id.predict(texts, model, pieces_of())
    monkeypatch.setattr(language_id, "COLUMNS", 7)
    after = language_id.predict(texts, model, pieces_of())
    assert before[0] == after[0] and before[2] == after[2] and np.allclose(before[1], after[1])
    monkeypatch.setattr(language_id, "HELD_LANGS", 2)
    again = language_id.fit(docs)
    assert np.allclose(again.weights, model.weights) and np.allclose(again.gains, model.gains)


def test_sorting_by_numbers_is_a_stable_argsort():
    from quillspark.llm.lattice import order_of

    rng = np.random.default_rng(6)
    for keys in (np.zeros(0, np.int64), np.array([5], np.int32), rng.integers(0, 9, 1000), rng.integers(0, 9, 1000, np.int32), rng.integers(0, 1 << 62, 1000)):
        assert (order_of(keys) == np.argsort(keys, kind="stable")).all()


def test_rows_decode_together_as_one_by_one():
    import pyarrow as pa

    from quillspark.llm.sampled_pieces import Sampler

    sampler = Sampler()
    texts = ["", "a day", " ▁ é 漢字 \U0001f600", "x" * 3000, ""]
    rows = [x.tolist() for x in sampler.encode([1, 2, 3, 4, 5], texts)]
    batch = pa.array([*rows[:3], None, *rows[3:]], pa.list_(pa.int32()))
    assert list(sampler.decode_all(batch)) == [*texts[:3], "", *texts[3:]] == [*map(sampler.decode, rows[:3]), "", *map(sampler.decode, rows[3:])]
    assert list(sampler.decode_all(batch[2:4])) == [texts[2], ""] and list(sampler.decode_all(batch[:0])) == []
