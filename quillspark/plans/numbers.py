"""Queries over vectors, coverage, and the relational tables; streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions import text, vectors
from quillspark.operators import coverage, enrichment
from quillspark.operators.calendar import small
from quillspark.plans.book import Book, read
from quillspark.streaming import events as streams
from quillspark.tables import new_path

book = Book()
_COSINE = "round(list_sum(list_transform(list_zip(a.embedding, q.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(q.embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6)"


def _query_vector(spark, sf_dir) -> list[float]:
    """The one query: the vector of id 0."""
    return read(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").first()[0]


@book.add(f"SELECT a.vec_id, a.label, {_COSINE} AS similarity FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY similarity DESC, vec_id LIMIT 50")
def cosine_topk(spark, sf_dir):
    return enrichment.nearest(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir)).select("vec_id", "label", "similarity")


@book.add(f"SELECT a.vec_id, {_COSINE} AS similarity FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE a.label = 1 ORDER BY similarity DESC, vec_id LIMIT 10")
def cosine_filtered(spark, sf_dir):
    return enrichment.nearest(read(spark, sf_dir, "embeddings").where("label = 1"), "vec_id", "embedding", _query_vector(spark, sf_dir), 10).select("vec_id", "similarity")


@book.add(f"SELECT a.vec_id, round(1 - {_COSINE}, 6) AS distance FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) q")
def cosine_distance(spark, sf_dir):
    q = F.array(*(F.lit(float(x)) for x in _query_vector(spark, sf_dir)))
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(1 - F.round(vectors.cosine_similarity(F.col("embedding"), q), 6), 6).alias("distance"))


@book.add("SELECT vec_id FROM embeddings WHERE vec_id % 11 = 0 OR vec_id % 7 = 0 OR embedding IS NULL OR len(embedding) <> 64")
def vector_check(spark, sf_dir):
    """Over vectors of which some are cut and some are missing."""
    vector = F.when(F.col("vec_id") % 11 != 0, F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding")))
    return enrichment.check_vectors(read(spark, sf_dir, "embeddings").withColumn("embedding", vector), "embedding", 64).select("vec_id")


@book.add()
def hash_embedding(spark, sf_dir):
    """Vectors by a strategy in batches of 50; tested against the strategy itself."""
    return enrichment.embed(read(spark, sf_dir, "documents"), "doc_id", "text", enrichment.hash_embedder())


_COVER = "(SELECT r_name AS category, n_name AS ticker, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS yq, o_orderstatus AS kind FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
QUARTERS = [f"{y}-Q{i}" for y in range(1995, 2002) for i in range(1, 5)]


def _quarter():
    return F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate")).alias("yq")


def _cover(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").join(small(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = read(spark, sf_dir, "customer").join(small(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(F.col("r_name").alias("category"), F.col("n_name").alias("ticker"), _quarter(), F.col("o_orderstatus").alias("kind"))


@book.add(f"SELECT category, ticker, kind, " + ", ".join(f"count(*) FILTER (yq = '{q}') AS \"{q}\"" for q in QUARTERS) + f" FROM {_COVER} GROUP BY category, ticker, kind")
def coverage_pivot(spark, sf_dir):
    """All quarters that the orders have; a quarter without orders in the fixed span counts 0."""
    rows = _cover(spark, sf_dir)
    found = [r["yq"] for r in read(spark, sf_dir, "orders").select(_quarter()).where("yq IS NOT NULL").distinct().collect()]
    return coverage.pivot(rows, ["category", "ticker", "kind"], "yq", sorted({*QUARTERS, *found}))


@book.add(f"""
SELECT category, ticker, CAST(sum(e) AS BIGINT) AS earnings, CAST(sum(i) AS BIGINT) AS ignored, CAST(sum(e + i) AS BIGINT) AS total, CAST(grouping_id(category, ticker) AS INTEGER) AS level
FROM (SELECT category, ticker, CASE WHEN kind = 'F' THEN 1 ELSE 0 END AS e, CASE WHEN kind = 'O' THEN 1 ELSE 0 END AS i FROM {_COVER}) GROUP BY ROLLUP (category, ticker)""")
def coverage_rollup(spark, sf_dir):
    rows = _cover(spark, sf_dir).select("category", "ticker", (F.col("kind") == "F").cast("int").alias("e"), (F.col("kind") == "O").cast("int").alias("i"))
    return coverage.rollup(rows, "category", "ticker", "e", "i")


@book.add(f"SELECT ticker, count(*) AS n FROM {_COVER} WHERE kind = 'P' GROUP BY ticker")
def ignore_counts(spark, sf_dir):
    return _cover(spark, sf_dir).where("kind = 'P'").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def coverage_uncovered(spark, sf_dir):
    key = lambda d: d.select(F.col("o_custkey").alias("c_custkey"))
    orders = read(spark, sf_dir, "orders")
    return coverage.uncovered(read(spark, sf_dir, "customer").select("c_custkey"), key(orders.where("o_orderstatus = 'F'")), key(orders.where("o_orderpriority LIKE '1%'")), key="c_custkey")


@book.add("SELECT l_returnflag, count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (l_linestatus = 'F') / count(*), 1) AS pct FROM lineitem GROUP BY l_returnflag")
def percent_share(spark, sf_dir):
    grouped = read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    return grouped.select("l_returnflag", "n", text.percent(F.col("f"), F.col("n")).alias("pct"))


@book.add("""
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY n_name""")
def star_revenue(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").join(small(read(spark, sf_dir, "region").where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = read(spark, sf_dir, "customer").join(small(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = read(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ '1995-01-01'").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@book.add("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer")
def semi_anti(spark, sf_dir):
    customers, orders = read(spark, sf_dir, "customer").select("c_custkey"), read(spark, sf_dir, "orders")
    on = F.col("c_custkey") == F.col("o_custkey")
    yes, no = customers.join(orders, on, "left_semi"), customers.join(orders, on, "left_anti")
    return yes.withColumn("has_orders", F.lit(True)).unionByName(no.withColumn("has_orders", F.lit(False)))


@book.add("""
SELECT 'union' AS op, k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', k FROM (SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def set_ops(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    rich = read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    tag = lambda d, op: d.select(F.lit(op).alias("op"), "k")
    return tag(a.union(b).distinct(), "union").union(tag(a.intersect(b), "intersect")).union(tag(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).subtract(rich), "except"))


@book.add("SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS lines, CAST(grouping_id(l_returnflag, l_linestatus) AS INTEGER) AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def rollup_cube(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum("l_linenumber").alias("lines"), F.grouping_id().cast("int").alias("level"))


@book.add("SELECT e.event_id, (SELECT max(s.ts) FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'view' AND s.ts <= e.ts) AS last_view FROM events e WHERE event_type = 'purchase'")
def asof_join(spark, sf_dir):
    """The latest view at or before each purchase of a user: both kinds in one ordered window, not a join on inequality."""
    events = read(spark, sf_dir, "events").where("event_type IN ('purchase', 'view')")
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumn("last_view", F.max(F.when(F.col("event_type") == "view", F.col("ts"))).over(w)).where("event_type = 'purchase'").select("event_id", "last_view")


def _stream(spark, sf_dir):
    """The events table as a stream of files."""
    schema = read(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@book.add("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, sf_dir):
    counts = streams.window_counts(_stream(spark, sf_dir), "ts", "event_type", "1 day", late="365 days")
    table = streams.run_available(counts, f"counts_{uuid.uuid4().hex}", new_path(spark, "stream"))
    return table.select(F.date_format("first", "yyyy-MM-dd").alias("day"), "event_type", "n")


@book.add("SELECT user_id % 10 AS bucket, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def stream_dedupe(spark, sf_dir):
    twice = _stream(spark, sf_dir)
    kept = streams.deduplicated(twice.union(twice), "ts", "event_id", "365 days")
    table = streams.run_to_files(kept.select("event_id", "user_id"), new_path(spark, "stream"))
    return table.groupBy((F.col("user_id") % 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
