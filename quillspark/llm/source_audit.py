"""Source divergence audit: how far the sources of a language lie apart in the words they use.

Plain relational: regular-expression matches are exploded and counted by (lang, source, term); each language keeps the terms
of at least `min_docs` of its documents; every group (lang, source) is crossed with the kept terms of its language, so that
absent terms count zero; the dense rows are joined with themselves on the kept term (which implies the language), summed by
pair of groups, and ranked by windows.

Kept terms and groups get numbers, so that the dense rows, of which there are groups times terms, are three whole numbers
each. The cross is an equality join on the language and a salt that cuts its terms evenly; the self-join has as many rows
for each term as the language has sources, whatever its frequency: no key is hot. Frequent terms and large sources are
summed before any shuffle.

Defined cases: null text, lang and source count as empty; a document without terms still makes its group occur; a language
without kept terms has pairs of value 0 and no terms; repeated rows are documents each; ties in value are ranked by the
item's UTF-8 bytes; texts of any length are taken whole; an empty table gives an empty result; further columns are ignored.
Counts are exact at any size: products beyond 64 bits are taken as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import partitions, written

#: What a term is made of, the scale of shares, the least documents of a kept term, the last rank of a term.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, MIN_DOCS, TOP = 1_000_000_000, 3, 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The largest count whose product with SCALE is surely a 64-bit number.
_SAFE = (1 << 63) // SCALE - 1
#: TERM once A-Z are gone, as the characters that it has: Java takes a fifth of the time for it.
_LOWERED = r"[a-z\x{80}-\x{10FFFF}]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; lower() does the same, and faster, where there is nothing but ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * count / total), exact."""
    wide = F.call_function("div", count.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)"))
    return F.lit(1) + F.when(count <= _SAFE, F.call_function("div", count * SCALE, total)).otherwise(wide)


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term with n (occurrences) and docs (documents that have it). A document's matches are sorted, so that
    the first of each term is known where they are exploded."""
    found = F.sort_array(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_LOWERED), F.lit(0)))
    marked = F.transform(F.array(found), lambda all_: F.transform(all_, lambda w, i: F.struct(w.alias("term"), F.when((i == 0) | (F.get(all_, i - 1) != w), 1).otherwise(0).alias("first"))))
    return (
        docs.select("lang", "source", F.explode(marked).alias("marked")).select("lang", "source", F.explode("marked").alias("m"))
        .groupBy("lang", "source", F.col("m.term").alias("term")).agg(F.count(F.lit(1)).alias("n"), F.sum("m.first").alias("docs"))
    )


def source_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Parts `pair` (all other sources of the language by divergence) and `term` (the `top` terms that a source uses beyond its language)."""
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counts = written(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    kept = written(kept.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_no")), "kept-terms")
    cells = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "term_no", "n", "lang_n"), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, ["lang"], "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = written(groups.select("lang", "source", "terms", (F.col("total") + F.col("terms")).alias("out_of"), (F.col("lang_total") + F.col("terms")).alias("lang_out_of"), F.monotonically_increasing_id().alias("group_no")), "groups")

    # pairs: groups x kept terms, zeros included, then the self-join by term
    salts = partitions(spark)
    salted = groups.select("lang", "source", "group_no", "out_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    crossed = kept.select("lang", "term_no", F.pmod("term_no", F.lit(salts)).cast("int").alias("salt")).join(salted, ["lang", "salt"])
    dense = crossed.join(cells.select("term_no", "source", "n"), ["term_no", "source"], "left")
    p = share(F.coalesce("n", F.lit(0)) + 1, F.col("out_of"))
    one, other = (dense.select("term_no", F.col("group_no").alias(no), p.alias(name)) for no, name in (("group_no", "p"), ("other_no", "q")))  # alike, so that one exchange serves both
    sums = one.hint("shuffle_hash").join(other, "term_no").filter("group_no <> other_no").groupBy("group_no", "other_no").agg(F.sum(excess(F.col("p"), F.col("q"))).alias("value"))
    names = groups.select("lang", "source", "group_no")
    pairs = sums.join(names, "group_no").join(groups.select(F.col("source").alias("item"), F.col("group_no").alias("other_no")), "other_no").select("lang", "source", "item", "value")
    bare = groups.filter("terms = 0").select("lang", "source")
    pairs = pairs.unionByName(bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item").withColumn("value", F.lit(0).cast("long")))

    # terms: only those that a group has can stand above their language
    own = cells.join(groups.filter("terms > 0").select("lang", "source", "out_of", "lang_out_of"), ["lang", "source"])
    own = own.select("lang", "source", F.col("term").alias("item"), share(F.col("n") + 1, F.col("out_of")).alias("p"), share(F.col("lang_n") + 1, F.col("lang_out_of")).alias("q"))
    own = own.filter("p > q").select("lang", "source", "item", excess(F.col("p"), F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)
    return out(pairs, "pair").unionByName(out(own, "term").filter(F.col("rank") <= top))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents),
m AS (SELECT row_no, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM m GROUP BY lang, term HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM m SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)),
z AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE} * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p, 1 + ({SCALE} * (k.n + 1)) // (l.total + l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM z a JOIN z b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM z WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= {TOP}
"""
