"""An inverted index of terms, with places, for texts and for arrays of ids.

A posting row holds one term and one block of ids (BLOCK neighbouring ones): the sorted ids, as offsets into the block, and
for each the places of the term. Rows lie in one folder for each bucket of terms, sorted by term and block within files, so
that a search reads the buckets of its terms only, and of those the row groups that can hold them. A frequent term is many
rows of bounded length.

A search brings the posting rows of its terms together by block (compact arrays are shuffled, never texts), leaves blocks
that lack a term, and merges within the block: ids with all terms, with any, or with terms at consecutive places.

Defined cases: rows with a null id or without terms aren't indexed; ids may be negative; rows of one id are one document
with the terms of all, places counted in each of them; searches without words, or for words that no row has, find nothing (`any`: words that
no row has are ignored); a word that is asked for twice must stand twice in a phrase, and once otherwise; appended rows are
found as if they had been there from the beginning.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids in a block: a power of two.
BLOCK_BITS = 12
BUCKETS = 64
#: Distinct words that a search names in its filters, at most: beyond them the join alone prunes.
MOST_NAMED = 1000
KINDS = ("all", "any", "phrase")
POSTINGS = "term string, block long, offsets array<int>, places array<array<int>>, bucket int"


def bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _by_term(tokens: Column) -> Column:
    """array<struct<term, places>> of one row's tokens: sorted with their places, then cut where the term changes."""
    sorted_ = F.array_sort(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))

    def cut(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["t"] != F.get(s, i - 1)["t"]))
        run = lambda a, b: F.struct(F.get(s, a)["t"].alias("term"), F.transform(F.slice(s, a + 1, b - a), lambda x: x["i"]).alias("places"))
        return F.get(F.transform(F.array(starts), lambda ps: F.transform(ps, lambda a, k: run(a, F.coalesce(F.get(ps, k + 1), F.size(s))))), F.lit(0))

    return F.get(F.transform(F.array(sorted_), cut), F.lit(0))


def build(rows: DataFrame, key: str, tokens: Column, path: str, buckets: int = BUCKETS, append: bool = False) -> None:
    """Writes (or appends) the postings of rows: tokens is an ordered array of strings, null ones are left out."""
    held = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.filter(tokens, lambda t: t.isNotNull()).alias("tokens")).where("size(tokens) > 0")
    each = held.select("id", F.explode(_by_term(F.col("tokens"))).alias("e"))
    entry = F.struct(F.col("id").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("o"), F.col("e.places").alias("p"))
    found = each.groupBy(F.col("e.term").alias("term"), F.shiftright("id", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    postings = found.select("term", "block", F.transform("entries", lambda e: e["o"]).alias("offsets"), F.transform("entries", lambda e: e["p"]).alias("places"), bucket(F.col("term"), buckets).alias("bucket"))
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block").write.mode("append" if append else "overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    if not append:
        rows.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def queries_of(spark: SparkSession, asked: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """(query, kind, words) from {query: (kind, words)}."""
    return spark.createDataFrame([(q, kind, words) for q, (kind, words) in asked.items()], "query string, kind string, words array<string>")


def postings(spark: SparkSession, path: str, words: list[str] | None) -> DataFrame:
    """Posting rows, of some words only if they are given: their buckets are the only folders that are read."""
    held = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    if words is None:
        return held
    if not words:
        return held.where("false")
    buckets = spark.read.parquet(f"{path}/about").first()[0]
    return held.where(reduce(or_, (F.col("bucket") == bucket(F.lit(w), buckets) for w in words)) & F.col("term").isin(words))


def search(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """query, id for queries (query, kind, words): kind is one of KINDS."""
    asked = queries.where(F.col("kind").isin(*KINDS)).withColumn("n", F.size("words")).select("query", "kind", "n", F.posexplode("words").alias("place", "term"))
    named = [r[0] for r in asked.select("term").where("term IS NOT NULL").distinct().limit(MOST_NAMED + 1).collect()]
    held = postings(spark, path, named if len(named) <= MOST_NAMED else None)
    row = F.struct("place", "offsets", "places")
    blocks = asked.join(held, "term").groupBy("query", "kind", "n", "block").agg(F.collect_list(row).alias("held"), F.countDistinct("place").alias("have"))
    blocks = blocks.where("kind = 'any' OR have = n")  # a block that lacks a word has no document with all of them
    pairs = F.flatten(F.transform("held", lambda h: F.transform(h["offsets"], lambda o, i: F.struct(h["place"].alias("place"), o.alias("o"), F.get(h["places"], i).alias("p")))))
    entries = blocks.select("query", "kind", "n", "block", F.inline(pairs))
    # what follows is grouped by the block and more, so that the exchange above serves it
    keys = ["query", "kind", "n", "block", "o"]
    loose = entries.where("kind <> 'phrase'").groupBy(*keys).agg(F.countDistinct("place").alias("have")).where("kind = 'any' OR have = n")
    starts = entries.where("kind = 'phrase'").select(*keys, "place", F.explode("p").alias("at")).withColumn("start", F.col("at") - F.col("place"))
    phrases = starts.groupBy(*keys, "start").agg(F.countDistinct("place").alias("have")).where("have = n").select(*keys).distinct()
    return loose.select(*keys).unionByName(phrases).select("query", (F.shiftleft("block", BLOCK_BITS) + F.col("o")).alias("id"))
