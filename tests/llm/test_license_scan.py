from __future__ import annotations

import re
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import license_scan as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text: str | None) -> tuple:
    words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    places = [(i, label) for phrase, label in m.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["Under the MIT License", "apache license, version 2.0", "CC BY-NC 4.0", "cc by", "nc", "é", "the", "\n", "--", "LICENSE", "\0", "under the mit"]), max_size=12))
def test_base_is_that_of_brute_force(parts):
    text = " ".join(parts)
    assert m.scan(text.encode(), m.automaton())[:5] == brute(text)


def test_phrases_that_share_words_are_all_found():
    text = "cc by nc cc by nc under the mit license apache license version 2"
    assert m.scan(text.encode(), m.automaton())[:5] == brute(text) == (14, 4, 0, 10, "apache-2,cc-by-nc,mit")


def value(tokens: list[str], pos: int = 0, least: int = 0):
    """Precedence climbing, as an independent parser."""
    if tokens[pos] == "(":
        left, pos = value(tokens, pos + 1)
        pos += 1
    else:
        left, pos = m.known(tokens[pos])[1], pos + 1
    while pos < len(tokens) and tokens[pos] in ("and", "or") and {"or": 1, "and": 2}[tokens[pos]] > least:
        op = tokens[pos]
        right, pos = value(tokens, pos + 1, {"or": 1, "and": 2}[op])
        left = left or right if op == "or" else left and right
    return left, pos


def test_expressions_are_those_of_another_parser():
    for a, b, c, x, y in product(("mit", "gpl-3.0"), ("isc", "mpl-2.0"), ("zlib", "agpl-3.0"), ("and", "or"), ("and", "or")):
        for form in ("{a} {x} {b} {y} {c}", "({a} {x} {b}) {y} {c}", "{a} {x} ({b} {y} {c})"):
            text = form.format(a=a, b=b, c=c, x=x, y=y)
            postfix, n = m.expression(text.lower().encode())
            labels, free = m.evaluate(postfix)
            assert n == 3 and labels == {m.known(k)[0] for k in (a, b, c)}
            assert free == value(text.replace("(", "( ").replace(")", " )").split())[0]


def test_with_and_text_behind_an_expression():
    postfix, n = m.expression(b"gpl-2.0-only with classpath-exception-2.0 or mit and nothing else")
    assert postfix == ["gpl-2.0-only", "classpath-exception-2.0", "with", "mit", "or"] and n == 3 - 1
    assert m.evaluate(postfix) == ({"gpl-2", "mit"}, True)
    assert m.expression(b"(mit") == ([], 0) and m.expression(b"") == ([], 0) and m.expression(b"and mit") == ([], 0)


def test_query_rows(spark):
    rows = [(1, "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nx", "s", 1), (2, None, "s", 1), (None, "Released under the MIT License.", "s", 1), (4, "", None, 1), (4, "", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score int")
    got = {(r["doc_id"], r["n_words"]): r for r in m.license_scan(docs).collect()}
    assert got[1, 9]["labels"] == "apache-2,mit" and got[1, 9]["base_labels"] == "" and got[1, 9]["score"] == 1.0 and got[1, 9]["permissive"]
    assert got[2, 0]["labels"] == "" and got[2, 0]["first_word"] is None and got[2, 0]["score"] == 0
    assert got[None, 5]["labels"] == "mit" and got[None, 5]["first_word"] == got[None, 5]["last_word"] == 1
    assert m.license_scan(docs).count() == 5 and m.license_scan(docs.limit(0)).count() == 0


def test_any_well_formed_identifier_is_read():
    labels = lambda line: m.scan(f"x\nSPDX-License-Identifier: {line}\nmore".encode(), m.automaton())[5]
    assert labels("BSL-1.0 OR MIT") == "bsl-1.0,mit" and labels("CC-BY-3.0") == "cc-by-3.0" and labels("MIT OR Artistic-2.0") == "artistic-2.0,mit"
    assert labels("LicenseRef-own AND WTFPL */") == "licenseref-own,wtfpl" and labels("Made-up-7.1+") == "made-up-7.1" and labels("is a tag") == ""


def test_a_line_that_is_an_expression_may_name_any_licence():
    row = lambda line: m.scan(f"x\nSPDX-License-Identifier: {line}\nmore".encode(), m.automaton())
    labels = lambda line: row(line)[5]
    assert labels("Qhull") == "qhull" and row("Qhull")[6] == 1.0 and row("Qhull")[8] is False
    assert labels("MIT OR Adobe-Glyph") == "adobe-glyph,mit" and row("MIT OR Adobe-Glyph")[8] is True
    assert labels("(MIT AND FSFAP) -->") == "fsfap,mit" and labels("Zlib AND FSFAP */") == "fsfap,zlib"
    assert labels("2024 Acme Corp") == "" and row("2024 Acme Corp")[6] == 0 and labels("2024") == "" and labels("NOASSERTION") == ""
    assert labels("MIT and nothing else") == "mit" and labels("MIT, Qhull") == "mit" and labels("Qhull, see there") == "" and labels("GPL-2.0 with own-exception") == "gpl-2"
    assert labels("mit or (qhull") == "mit" and labels("mit or qhull)") == "mit" and labels("qhull or") == ""


def test_work_grows_with_the_length():
    import time

    began = time.perf_counter()
    line = "SPDX-License-Identifier: " + " or ".join(["mit", "(isc and zlib)"] * 30_000)
    row = m.scan(line.encode(), m.automaton())
    assert row[5] == "isc,mit,zlib" and row[8]
    row = m.scan(("SPDX-License-Identifier: MIT " * 300_000).encode(), m.automaton())
    assert row[5] == "mit" and row[7].count(";") == 299_999
    row = m.scan(("SPDX-License-Identifier: MIT\n" * 300_000).encode(), m.automaton())
    assert row[5] == "mit" and row[7].count(";") == 299_999
    row = m.scan(("spdx license identifier: " + " or ".join(f"x{i}" for i in range(60_000))).encode(), m.automaton())
    assert row[5].count(",") == 59_999
    assert time.perf_counter() - began < 60
