"""Substring joins of texts with tables of names of any size.

A text that holds a name holds each of the name's q-grams, so one of them will do as an equality key: the one that the
fewest texts have. Grams have GRAM characters; names shorter than that are their own gram. Candidates are verified on the
whole strings. Nothing is collected: grams, their counts, keys and candidates are tables, and Spark splits a gram that very
many texts have where it joins (neither side of that join is an aggregate by the gram).

Defined cases: null and empty texts and names match nothing; without regard to case (lower()); equal texts are matched once;
of equal names the smallest ordinal counts; ties in ordinal go to the smaller name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.tables import written

GRAM = 3


def grams(text: Column, size: int) -> Column:
    """Distinct substrings of `size` characters; one pass over the characters."""
    chars = F.split(text, "")
    of = lambda c: F.when(F.size(c) >= size, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(c) - size), lambda i: F.concat(*(F.get(c, i + k) for k in range(size))))))
    return F.coalesce(F.get(F.transform(F.array(chars), of), F.lit(0)), F.array().cast("array<string>"))


def contained(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """needle_id, hay_id of needles (needle_id, needle) that stand in hays (hay_id, hay); ids are unique, strings not empty."""
    sized = needles.withColumn("size", F.least(F.length("needle"), F.lit(GRAM)))
    sizes = sorted(r[0] for r in sized.select("size").distinct().collect())  # GRAM rows
    if not sizes:
        return needles.select("needle_id").join(hays.select("hay_id").where("false"))
    own = F.coalesce(*(F.when(F.col("size") == k, grams(F.col("needle"), k)) for k in sizes))
    own = written(sized.select("needle_id", F.explode(own).alias("gram")), "name-grams")
    theirs = hays.select("hay_id", F.explode(F.concat(*(grams(F.col("hay"), k) for k in sizes))).alias("gram"))
    theirs = written(theirs.join(own.select("gram").distinct(), "gram", "left_semi"), "text-grams")
    often = theirs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    key = own.join(often, "gram", "left").groupBy("needle_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest"))
    key = key.where("rarest.n > 0").select("needle_id", F.col("rarest.gram").alias("gram"))  # a gram that no text has: no hit
    candidates = key.join(theirs, "gram").select("needle_id", "hay_id")
    both = candidates.join(needles.select("needle_id", "needle"), "needle_id").join(hays.select("hay_id", "hay"), "hay_id")
    return both.where(F.col("hay").contains(F.col("needle"))).select("needle_id", "hay_id")


def first_match(texts: DataFrame, text: str, names: DataFrame, name: str, ordinal: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """texts with `matched` (ordinal, name and kept columns of its row): the first name, by ordinal, that stands in the text or in which the text stands,
    without regard to case; null if none does."""
    low = texts.select(F.lower(text).alias("low")).where("length(low) > 0").distinct()
    low = written(low.select("low", F.monotonically_increasing_id().alias("text_id")), "texts")
    known = names.where(F.col(ordinal).isNotNull()).groupBy(F.lower(name).alias("low")).agg(F.min(F.struct(F.col(ordinal).alias("ordinal"), F.col(name).alias("name"), *keep)).alias("first")).where("length(low) > 0")
    known = written(known.select("low", "first", F.monotonically_increasing_id().alias("name_id")), "names")
    of = lambda rows, no, low_, as_no, as_low: rows.select(F.col(no).alias(as_no), F.col(low_).alias(as_low))
    held = contained(of(known, "name_id", "low", "needle_id", "needle"), of(low, "text_id", "low", "hay_id", "hay")).select(F.col("needle_id").alias("name_id"), F.col("hay_id").alias("text_id"))
    holding = contained(of(low, "text_id", "low", "needle_id", "needle"), of(known, "name_id", "low", "hay_id", "hay")).select(F.col("hay_id").alias("name_id"), F.col("needle_id").alias("text_id"))
    first = held.unionByName(holding).join(known.select("name_id", "first"), "name_id").groupBy("text_id").agg(F.min("first").alias("matched"))
    found = low.join(first, "text_id").select(F.col("low").alias("_low"), "matched")
    return texts.withColumn("_low", F.lower(text)).join(found, "_low", "left").drop("_low")


def primary_company(docs: DataFrame, institutions: DataFrame, ticker: str, name: str, ordinal: str) -> DataFrame:
    """Parsed documents (documents.parsed) with primary_company, the first of the document's companies or `Unknown Company`,
    and primary_ticker, that of the first institution whose name matches it."""
    company = F.get(F.col("doc.meta.companies.company"), F.lit(0))
    matched = first_match(docs.withColumn("_company", company), "_company", institutions, name, ordinal, (ticker,))
    return matched.withColumns({"primary_company": F.coalesce("_company", F.lit("Unknown Company")), "primary_ticker": F.col(f"matched.{ticker}")}).drop("_company", "matched")
