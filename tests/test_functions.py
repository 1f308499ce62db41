from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillspark.config import Settings
from quillspark.functions import text, times, vectors


def one(spark, *columns, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'timestamp' if isinstance(v, dt.datetime) else 'date' if isinstance(v, dt.date) else 'array<double>' if isinstance(v, list) else 'double'}" for k, v in values.items()))
    return tuple(df.select(*columns).first())


TITLES = {
    "Q1 2024 Earnings Call": (True, "Q1", "2024", "Q1"), "q3  2023 earnings call": (True, "Q3", "2023", "Q3"), "Q1 2024 Earnings Call, final": (False, "Q1", "2024", "Q1"),
    "First Quarter 2024 results": (False, "Q1", "2024", "Unknown"), "3Q23 results": (False, "Q3", "2023", "Unknown"), "Q5 2024 Earnings Call": (False, "Unknown", "Unknown", "Unknown"),
    "": (False, "Unknown", "Unknown", "Unknown"), None: (False, "Unknown", "Unknown", "Unknown"), "Fourth Quarter 2022 and 1Q23": (False, "Q4", "2022", "Unknown"),
}


def test_titles(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "t string")
    q, y = text.title_period(F.col("t"))
    for r in df.select("t", text.title_is_call(F.col("t")), q, y, text.title_period(F.col("t"), False)[0]).collect():
        assert tuple(r[1:]) == TITLES[r[0]], r[0]


@pytest.mark.parametrize(("args", "want"), [(("Ann", "CFO", "Bank"), "Ann, CFO, Bank"), (("Ann", "Ann", ""), "Ann"), (("Ann", None, "Ann"), "Ann"), (("Ann", "CFO", "CFO"), "Ann, CFO"), (("", "CFO", "Bank"), "Unknown Speaker"), ((None, None, None), "Unknown Speaker")])
def test_speaker_label(spark, args, want):
    row = spark.createDataFrame([args], "a string, b string, c string").select(text.speaker_label(F.col("a"), F.col("b"), F.col("c"))).first()
    assert row[0] == want


@pytest.mark.parametrize(("t", "tokens", "words"), [("", 0, 0), (None, 0, 0), ("one", int((3 / 3.5 * 0.5 + 3 / 4 * 0.3 + 1.3 * 0.2) * 1.1), 1), ("a  b\n\nc " * 90, None, 270)])
def test_token_estimate(spark, t, tokens, words):
    got = one(spark, text.token_estimate(F.col("t")), text.word_count(F.col("t")), t=t)
    if tokens is None:
        squeezed = " ".join(t.split())
        tokens = int((len(squeezed) / 3.5 * 0.5 + len(t) / 4 * 0.3 + len(t.split()) * 1.3 * 0.2) * 1.1)
    assert got == (tokens, words)


@pytest.mark.parametrize(("path", "safe"), [("a/b.xml", True), ("../a", False), ("/a", False), ("a:b", False), ("a" * 261, False), ("", False), (None, False), ("a\0b", False)])
def test_paths(spark, path, safe):
    assert one(spark, text.is_safe_path(F.col("p")), p=path) == (safe,)


def test_small_text_functions(spark):
    assert one(spark, text.clean(F.col("t")), text.escaped(F.col("t")), text.preview(F.col("t"), 3), t=' \t a "b"\n c \r\n') == ('a "b"  c', 'a \\"b\\"  c', " \t ...")
    assert one(spark, text.html_text(F.col("t")), t="<p>Hi <b>x</b></p><script>bad()</script>\n<style>y</style> end") == ("Hi x end",)
    assert one(spark, text.bare_company(F.col("t")), text.path_safe(F.col("t")), t="Some Bank Group PLC") == ("Some Bank", "Some_Bank_Group_PLC")
    assert one(spark, text.ticker_variants(F.col("t")), t="ry-CA") == (["ry-CA", "ry", "RY-CA", "RY", "RY-US", "RY-GB"],)
    assert one(spark, text.redacted_url(F.col("t")), t="https://me:pw@host/x?token=1") == ("https://***@host/x?***",)
    assert one(spark, text.first_filled(F.col("a"), F.col("b"), F.lit("z")), a="", b=None) == ("z",)
    assert one(spark, text.percent(F.col("a"), F.col("b")), text.percent(F.col("a"), F.lit(0)), a=1.0, b=3.0) == (33.3, 0.0)
    assert one(spark, text.display_label(F.col("t"), {}), t="a_b") == ("a b",)


@pytest.mark.parametrize(("ts", "clock", "day"), [("2024-01-15 23:30", "18:30 EST", "2024-01-15"), ("2024-07-15 02:30", "22:30 EDT", "2024-07-14"), ("2024-03-10 07:30", "03:30 EDT", "2024-03-10"), ("2024-11-03 06:30", "01:30 EST", "2024-11-03")])
def test_local_times(spark, ts, clock, day):
    df = spark.sql(f"SELECT TIMESTAMP '{ts}' AS ts").select(times.clock(F.col("ts")), times.local_date(F.col("ts")).cast("string"))
    assert tuple(df.first()) == (clock, day)


def test_date_ranges(spark):
    got = spark.sql("SELECT DATE '2024-01-01' AS a, DATE '2024-07-01' AS z").select(F.inline(times.ranges(F.col("a"), F.col("z")))).collect()
    assert [(str(r[0]), str(r[1])) for r in got] == [("2024-01-01", "2024-03-30"), ("2024-03-31", "2024-06-28"), ("2024-06-29", "2024-07-01")]
    row = spark.sql("SELECT DATE '2024-02-29' AS d").select(times.window_start(F.col("d")).cast("string"), F.size(times.days_back(F.col("d"), 7)), times.months_about(F.col("d"), 6).cast("string")).first()
    assert tuple(row) == ("2021-02-28", 8, "2024-08-27")


def test_cosine(spark):
    near = lambda a, b: one(spark, vectors.cosine_similarity(F.col("a"), F.col("b")), a=a, b=b)[0]
    assert near([1.0, 0.0], [1.0, 0.0]) == 1 and near([1.0, 0.0], [0.0, 2.0]) == 0 and near([1.0, 1.0], [-1.0, -1.0]) == pytest.approx(-1)
    assert near([0.0, 0.0], [1.0, 1.0]) is None and near([1.0], [1.0, 1.0]) is None


@pytest.mark.parametrize("bad", [{"monitored": []}, {"monitored": ["A"], "start_year": 1990}, {"monitored": ["A"], "chunk_tail": 900}, {"monitored": ["A"], "vector_width": 0}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        Settings(**bad)
    assert Settings(["A"]).chunk_target == 500


def test_share_paths_and_search_terms(spark):
    paths = {"/a/b.xml/": True, "a/b": True, "a//b": False, "a/../b": False, "a/./b": False, "c:/x": False, "/": False, "": False, None: False, "a/" + "x" * 261: False}
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", text.is_safe_share_path(F.col("p")).alias("safe"))
    assert {r["p"]: r["safe"] for r in df.collect()} == paths
    names = {"The Bank Group": ["The Bank"], "St. James's Place PLC": ["St. James's Place", "James"], "UBS AG": ["UBS"], "Inc.": ["Inc."], "": [], "Royal Bank Inc.": ["Royal Bank", "Royal"]}
    got = {r["n"]: r["t"] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", text.search_terms(F.col("n")).alias("t")).collect()}
    assert got == names
