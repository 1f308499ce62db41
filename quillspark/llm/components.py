"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import clear, made, written

#: Edges that one task of a round writes: a round over few edges is few tasks and files, however many partitions there are.
EDGES_EACH = 100_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    pairs = _both(edges)
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    out = down.join(least, "a")
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a long, b long) -> (node, component): the smallest node reachable, for each node with an edge.

    Each round writes its edges to the shared folder; only a count and a checksum reach the driver. Self loops and
    repeated edges do no harm; without edges the result is empty.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = lambda x: tuple(x.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())
    was, is_now = None, mark(now)
    while is_now != was and is_now[0]:
        before = made()[-1]
        now = written(_small_star(_large_star(now)).coalesce(1 + is_now[0] // EDGES_EACH), "edges")
        was, is_now = is_now, mark(now)
        clear(edges.sparkSession, [before])
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
