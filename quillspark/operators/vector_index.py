"""An inverted-file index of vectors for cosine similarity.

Coarse centroids are fitted by k-means over a sample; each vector is written to the list of its nearest centroid, one folder
a list, so that a search reads the lists it probes and nothing else. Queries and lists meet as blocks, by an equality join,
and are ranked exactly within what they probe; probing all lists is the exact search. Pairs of blocks are compared by a
product of matrices, which leaves out what can't be among the n best; the others' similarities are summed in order, as an
expression over the pair would.

Centroids are the only model that the driver holds: at most MOST_LISTS of them, and CENTROID_BYTES in all. The sample has
about `per_list` rows for each list. How many lists a search probes is set when the index is built: so many that, in the
sample, the goal's share of true neighbours lies in them. Neighbours in a sample are farther away than those among all rows, so the figure is on
the safe side.

Defined cases: null vectors, those of another width, with a null or non-finite component or without a direction aren't
indexed, and as queries find nothing; ties in similarity go to the smaller key; rows of equal keys are rows each; an empty
table gives an index that finds nothing. A list may hold most rows (copies of one vector): it is cut into files when it is
written, and searches read those side by side.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructType

from quillspark.functions.vectors import dot
from quillspark.tables import written

#: Lists at most, bytes of all centroids at most, rows of the sample for each list, queries that set the number of probes.
MOST_LISTS, CENTROID_BYTES, PER_LIST, CALIBRATORS = 16_384, 128 << 20, 128, 64
#: Lists that a search names in its filter, at most: beyond them the join alone prunes.
MOST_NAMED = 4096
#: Lists are dealt by their number into GROUPS, blocks of a group into SLOTS, so that a list of most rows isn't one task.
GROUPS, SLOTS = 4, 16
#: Rows of a block of queries and of a block of vectors; pairs whose exact similarity is computed at a time.
ASKED_ROWS, HELD_ROWS, PAIRS = 1024, 4096, 1 << 16


def has_direction(vector: Column, width: int) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == width) & sound & (dot(vector, vector) > 0), F.lit(False))


def nearest_lists(vector: Column, centroids: np.ndarray, n: int) -> Column:
    """Numbers of the n nearest centroids, nearest first."""
    unit = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-30)
    n = min(n, len(unit))

    @F.pandas_udf("array<int>")
    def ranked(column: pd.Series) -> pd.Series:
        if not len(column):
            return column
        near = np.stack(column.to_numpy()).astype(np.float64) @ unit.T
        if n == 1:
            return pd.Series(list(np.argmax(near, axis=1).astype(np.int32)[:, None]))
        return pd.Series(list(np.argsort(-near, axis=1, kind="stable")[:, :n].astype(np.int32)))

    return ranked(vector)


def _ranked(pairs: DataFrame, n: int) -> DataFrame:
    """The n best of each query. Spark limits each query's rows before they are dealt by query."""
    place = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("similarity"), "_key"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= n)


def _similarity(digits: int) -> Column:
    return F.round(dot(F.col("_vector"), F.col("_asked")) / (F.col("_norm") * F.col("_asked_norm")), digits).alias("similarity")


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column without nulls, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _list_of(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _asked_blocks(width: int, many: int, probed: bool) -> Callable:
    """For mapInArrow over (_query, _asked, _asked_norm, lists): blocks of queries for each group that one of their lists is
    in (all groups, if they probe all lists) and each of its slots. probes: bits of a query and the group's lists."""
    groups = min(GROUPS, many)

    def run(batches):
        for batch in batches:
            vectors, norms = _numbers(batch.column(1), width), batch.column(2).to_numpy()
            asks = np.zeros((batch.num_rows, many), bool)
            if probed:
                asks[np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy()), batch.column(3).flatten().to_numpy()] = True
            for group in range(groups):
                own = asks[:, group::groups]
                rows = np.flatnonzero(own.any(axis=1)) if probed else np.arange(batch.num_rows)
                for at in range(0, len(rows), ASKED_ROWS):
                    some = rows[at : at + ASKED_ROWS]
                    ids = _list_of(batch.column(0).take(pa.array(some)))
                    blobs = [np.ascontiguousarray(x).tobytes() for x in (vectors[some], norms[some], np.packbits(own[some], axis=1))]
                    for slot in range(SLOTS):
                        yield pa.RecordBatch.from_arrays([pa.array([group * SLOTS + slot], pa.int32()), ids, *(pa.array([x], pa.binary()) for x in blobs)], ["lane", "queries", "asked", "asked_norms", "probes"])

    return run


def _held_blocks(width: int, many: int) -> Callable:
    """For mapInArrow over (list, _key, _kept, _vector, _norm): blocks of vectors of a group's lists, in one of its slots each."""
    groups = min(GROUPS, many)

    def run(batches):
        slot = TaskContext.get().partitionId()
        for batch in batches:
            lists, vectors, norms = batch.column(0).to_numpy(), _numbers(batch.column(3), width), batch.column(4).to_numpy()
            order = np.lexsort((lists, lists % groups))
            for rows in np.split(order, np.flatnonzero(np.diff(lists[order] % groups)) + 1):
                for at in range(0, len(rows), HELD_ROWS):
                    some = rows[at : at + HELD_ROWS]
                    slot += 1
                    lane = int(lists[some[0]] % groups) * SLOTS + slot % SLOTS
                    held = [_list_of(batch.column(i).take(pa.array(some))) for i in (1, 2)]
                    blobs = [np.ascontiguousarray(x).tobytes() for x in (lists[some].astype(np.int32), vectors[some], norms[some])]
                    yield pa.RecordBatch.from_arrays([pa.array([lane], pa.int32()), *held, *(pa.array([x], pa.binary()) for x in blobs)], ["lane", "keys", "kept", "lists", "held", "norms"])

    return run


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """As Spark rounds doubles: their shortest decimal form, halves away from zero."""
    scaled = x * 10.0**digits
    out = np.rint(scaled) / 10.0**digits
    for i in np.flatnonzero(np.abs(np.abs(scaled - np.trunc(scaled)) - 0.5) < 1e-6):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


def _found(asked: np.ndarray, asked_norms: np.ndarray, held: np.ndarray, norms: np.ndarray, keys: np.ndarray, n: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, similarity): the n best of each query by rounded similarity and key. Products of matrices differ
    from sums in order by far less than the last digit, so what lies more than that below the n-th best is out."""
    near = (asked / asked_norms[:, None]) @ (held / norms[:, None]).T
    near[np.isnan(near)] = np.inf  # a NaN is above all numbers
    least = np.partition(near, -n, axis=1)[:, -n] if n < near.shape[1] else np.full(len(near), -np.inf)
    a, b = np.nonzero(near >= (least - 1.1 * 10.0**-digits)[:, None])
    exact = np.zeros(len(a))
    for at in range(0, len(a), PAIRS):
        part = slice(at, at + PAIRS)
        x, y = held[b[part]], asked[a[part]]
        for k in range(held.shape[1]):
            exact[part] += x[:, k] * y[:, k]
    exact /= norms[b] * asked_norms[a]
    order = np.lexsort((keys[b], -np.where(np.isnan(exact), np.inf, rounded(exact, digits)), a))
    first = np.flatnonzero(np.diff(a[order], prepend=-1))
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    best = order[place < n]
    return a[best], b[best], exact[best]


def _scored(width: int, many: int, probed: bool, kinds: tuple[str, str], n: int, digits: int) -> Callable:
    """For mapInArrow over joined blocks: (_query, _key, _kept, similarity) of the n best of each query in each pair of
    blocks. kinds: of the numbers of queries' vectors and of the others."""
    groups = min(GROUPS, many)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                queries, keys, kept = (batch.column(k)[i].values for k in (0, 1, 2))
                asked_norms, norms = (np.frombuffer(batch.column(k)[i].as_py(), np.float64) for k in (3, 4))
                asked, held = (np.frombuffer(batch.column(k)[i].as_py(), kind).reshape(-1, width).astype(np.float64) for k, kind in zip((5, 6), kinds, strict=True))
                lists = np.frombuffer(batch.column(7)[i].as_py(), np.int32)
                rank = np.empty(len(keys), np.int64)
                rank[pa.compute.array_sort_indices(keys, null_placement="at_start").to_numpy()] = np.arange(len(keys))
                parts = [(np.arange(len(asked)), np.arange(len(held)))]
                if probed:
                    bits = np.frombuffer(batch.column(8)[i].as_py(), np.uint8).reshape(len(asked), -1)
                    asks = np.unpackbits(bits, axis=1, count=len(range(int(lists[0]) % groups, many, groups))).astype(bool)
                    parts = [(np.flatnonzero(asks[:, l // groups]), np.flatnonzero(lists == l)) for l in np.unique(lists)]
                for a, b in parts:
                    if not len(a):
                        continue
                    x, y, similarity = _found(asked[a], asked_norms[a], held[b], norms[b], rank[b], n, digits)
                    x, y = pa.array(a[x]), pa.array(b[y])
                    yield pa.RecordBatch.from_arrays([queries.take(x), keys.take(y), kept.take(y), pa.array(similarity)], ["_query", "_key", "_kept", "similarity"])

    return run


@dataclass
class VectorIndex:
    spark: SparkSession
    path: str
    centroids: np.ndarray
    probes: int
    schema: StructType

    @property
    def width(self) -> int:
        return self.centroids.shape[1]

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/lists")

    def search(self, queries: DataFrame, key: str, vector: str, n: int = 10, probes: int | None = None, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
        """query, key, kept columns, similarity, rank: the n most similar of each query, from its `probes` nearest lists
        (default: the index's own number; len(centroids): all, which is exact)."""
        probes = min(self.probes if probes is None else probes, len(self.centroids))
        many, lists = len(self.centroids), self.table()
        asked = queries.where(has_direction(F.col(vector), self.width)).select(F.col(key).alias("_query"), F.col(vector).alias("_asked"), F.sqrt(dot(F.col(vector), F.col(vector))).alias("_asked_norm"))
        probed = probes < many
        if probed:
            asked = written(asked.select("*", nearest_lists(F.col("_asked"), self.centroids, probes).alias("lists")), "probes")
            named = [r[0] for r in asked.select(F.explode("lists").alias("list")).distinct().limit(MOST_NAMED + 1).collect()]
            lists = lists.where(F.col("list").isin(named)) if len(named) <= MOST_NAMED else lists
        else:
            asked = asked.withColumn("lists", F.lit(None).cast("array<int>"))
        single = [isinstance(rows.schema[c].dataType.elementType, FloatType) for rows, c in ((asked, "_asked"), (lists, "_vector"))]
        numbers = lambda c, is_single: F.col(c) if is_single else F.col(c).cast("array<double>").alias(c)
        asked = asked.select("_query", numbers("_asked", single[0]), "_asked_norm", "lists")
        lists = lists.select("list", "_key", "_kept", numbers("_vector", single[1]), "_norm")
        kind = {c: rows.schema[c].dataType.simpleString() for rows, c in ((asked, "_query"), (lists, "_key"), (lists, "_kept"))}
        lanes = min(GROUPS, many) * SLOTS
        asks = asked.mapInArrow(_asked_blocks(self.width, many, probed), f"lane int, queries array<{kind['_query']}>, asked binary, asked_norms binary, probes binary").repartition(lanes, "lane")
        held = lists.mapInArrow(_held_blocks(self.width, many), f"lane int, keys array<{kind['_key']}>, kept array<{kind['_kept']}>, lists binary, held binary, norms binary").repartition(lanes, "lane")
        both = held.join(asks, "lane").select("queries", "keys", "kept", "asked_norms", "norms", "asked", "held", "lists", "probes")
        kinds = tuple("<f4" if x else "<f8" for x in single)
        pairs = both.mapInArrow(_scored(self.width, many, probed, kinds, n, digits), f"_query {kind['_query']}, _key {kind['_key']}, _kept {kind['_kept']}, similarity double")
        pairs = pairs.select("_query", "_key", *(F.col(f"_kept.{c}").alias(c) for c in keep), F.round("similarity", digits).alias("similarity"))
        return _ranked(pairs, n).select(F.col("_query").alias("query"), F.col("_key").alias("key"), *keep, "similarity", "rank")

    def recall(self, queries: DataFrame, key: str, vector: str, n: int = 10, probes: int | None = None) -> DataFrame:
        """One row: queries, neighbours (of the exact search) and how many of them the search finds."""
        true = self.search(queries, key, vector, n, len(self.centroids)).select("query", "key")
        found = self.search(queries, key, vector, n, probes).select("query", "key", F.lit(1).alias("hit"))
        both = true.join(found, ["query", "key"], "left")
        return both.agg(F.countDistinct("query").alias("queries"), F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found"))


def build(rows: DataFrame, key: str, vector: str, path: str, width: int, lists: int | None = None, keep: tuple[str, ...] = (), per_list: int = PER_LIST, rounds: int = 10, goal: float = 0.97, n: int = 10, seed: int = 11) -> VectorIndex:
    """Writes the index of rows to path. lists: the square root of the number of rows, unless given."""
    spark = rows.sparkSession
    v = F.col(vector)
    usable = rows.where(has_direction(v, width))
    total = usable.count()
    lists = max(1, min(lists or round(total**0.5), MOST_LISTS, CENTROID_BYTES // (4 * width), total))
    sample = written(usable.select(v.alias("_vector")).sample(min(1.0, lists * per_list / max(1, total)), seed).select("_vector", array_to_vector(F.transform("_vector", lambda x: x.cast("double"))).alias("features")), "vector-sample")
    if lists == 1:
        centroids = np.ones((1, width), np.float32)
    else:
        centroids = np.array(KMeans(k=lists, seed=seed, maxIter=rounds, distanceMeasure="cosine").fit(sample).clusterCenters(), np.float32)
    norm = F.sqrt(dot(v, v)).alias("_norm")
    kept = F.struct(F.lit(None).cast("int").alias("_"), *keep).alias("_kept")
    dealt = usable.select(F.col(key).alias("_key"), v.alias("_vector"), norm, kept, F.get(nearest_lists(v, centroids, 1), F.lit(0)).alias("list"))
    # Spark cuts and joins the parts of this exchange by size, so that a list of most rows is written by many tasks
    dealt.hint("rebalance", "list").sortWithinPartitions("list", "_key").write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")
    probes = _probes(sample, centroids, goal, n, seed)
    spark.createDataFrame([(i, [float(x) for x in c], probes, dealt.schema.json()) for i, c in enumerate(centroids)], "list int, centroid array<float>, probes int, schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return VectorIndex(spark, path, centroids, probes, dealt.schema)


def _probes(sample: DataFrame, centroids: np.ndarray, goal: float, n: int, seed: int) -> int:
    """The least number of lists that hold the goal's share of the n nearest of some sample vectors."""
    if len(centroids) == 1:
        return 1
    numbered = sample.select(F.monotonically_increasing_id().alias("_key"), "_vector", F.sqrt(dot(F.col("_vector"), F.col("_vector"))).alias("_norm"))
    asked = numbered.orderBy(F.xxhash64("_vector", F.lit(seed)), "_key").limit(CALIBRATORS).select(F.col("_key").alias("_query"), F.col("_vector").alias("_asked"), F.col("_norm").alias("_asked_norm"))
    asked = asked.withColumn("_order", nearest_lists(F.col("_asked"), centroids, len(centroids)))
    held = numbered.withColumn("list", F.get(nearest_lists(F.col("_vector"), centroids, 1), F.lit(0))).withColumn("_all", F.lit(1))
    pairs = held.join(F.broadcast(asked.withColumn("_all", F.lit(1))), "_all").select("_query", "_key", _similarity(6), F.array_position("_order", F.col("list")).alias("needs"))  # CALIBRATORS rows
    needs = sorted(r[0] for r in _ranked(pairs, n).select("needs").collect())  # n for each of them
    return int(needs[min(len(needs), ceil(goal * len(needs))) - 1]) if needs else 1


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    found = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()
    return VectorIndex(spark, path, np.array([r["centroid"] for r in found], np.float32), found[0]["probes"], StructType.fromJson(json.loads(found[0]["schema"])))
