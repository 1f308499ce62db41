"""Centroid clustering by Yinyang k-means: exact Lloyd rounds in whole numbers, most distances left out by bounds.

Centroids are put into groups once. Each vector carries its cluster, an upper bound on the distance to its own centroid and
one lower bound for each group of the other centroids. When centroids have moved, bounds are moved by how far they went; a
vector whose upper bound lies below all its lower bounds stays (global filter), after the distance to its own centroid has
been made exact it may stay yet; else only groups whose bound is not above go on (group filter), and their centroids are
scanned exactly. Bounds are kept on the safe side of rounding and compared strictly, so that ties are always scanned.

A round is one narrow pass: it reads the vectors with their bounds, writes them with new ones, and beside them a few rows of
sums by cluster and component for each task, which Spark adds up. The driver holds centroids only. Each round lies in the
shared folder, so a lost executor costs no earlier round; the round before the last is removed.

Defined cases: vectors that are null, or with another number of components, or a component null or not finite, take no part;
an empty or too small table gives as many clusters as there are vectors; a null id is hashed as an empty one, and vectors of
one id start in the order of their components; repeated rows are vectors each; ties go to the smaller number; a cluster
without vectors keeps its centroid; further columns are ignored. Components of any finite size are taken exactly, by way of
Python's whole numbers where a double can't hold a distance; results beyond 64 bits stop at the largest number.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import clear, new_path

DIM, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, "3:"
#: Rows worked on at a time; bits of a part of a sum; what bounds give way to rounding, relatively.
ROWS, LIMB, SLACK = 8192, 30, 1e-9
MOST = (1 << 63) - 1


def exact(dim: int) -> int:
    """Up to this magnitude of components a squared distance is exact in a double, in any order of summing."""
    return math.isqrt((1 << 51) // max(1, dim))


def scaled(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x), as whole numbers in doubles (exact: scale is a power of two)."""
    return np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) * scale)


class Distances:
    """Exact squared distances of rows to centroids."""

    def __init__(self, x: np.ndarray, centroids: np.ndarray) -> None:
        self.whole = max(np.abs(x).max(initial=0), max((abs(c) for row in centroids.tolist() for c in row), default=0)) > exact(x.shape[1])
        self.x = np.array([[int(a) for a in row] for row in x.tolist()], object).reshape(x.shape) if self.whole else x
        self.c = centroids if self.whole else centroids.astype(np.float64)
        if not self.whole:
            self.xx, self.cc = (self.x * self.x).sum(1), (self.c * self.c).sum(1)

    def between(self, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        """All of `rows` with all centroids of `which`."""
        if self.whole:
            return np.array([[sum((a - b) * (a - b) for a, b in zip(self.x[i], self.c[j], strict=True)) for j in which] for i in rows], object).reshape(len(rows), len(which))
        return self.xx[rows, None] - 2 * (self.x[rows] @ self.c[which].T) + self.cc[None, which]

    def own(self, rows: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Each row with one centroid."""
        away = self.x[rows] - self.c[cluster]
        return (away * away).sum(1) if len(rows) else np.zeros(0, object if self.whole else np.float64)


def root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def assign(x: np.ndarray, cluster: np.ndarray | None, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, groups: list[np.ndarray], moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """One round for some vectors: new clusters and bounds, and how many distances were computed. moved: how far each
    centroid went, not less. cluster None: the first round."""
    n, k, t = len(x), len(centroids), len(groups)
    group_of = np.zeros(k, np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
    d = Distances(x, centroids)
    if cluster is None:
        whole = d.between(np.arange(n), np.arange(k))
        cluster = whole.argmin(1)
        upper, lower = root(whole[np.arange(n), cluster]) * (1 + SLACK), np.full((n, t), np.inf)
        whole = root(whole) * (1 - SLACK)
        whole[np.arange(n), cluster] = np.inf
        for g, members in enumerate(groups):
            lower[:, g] = whole[:, members].min(1)
        return cluster, upper, lower, n * k
    cluster, upper, lower = cluster.copy(), (upper + moved[cluster]) * (1 + SLACK), lower - np.array([moved[m].max() for m in groups])
    lower = np.where(np.isinf(lower), lower, lower - np.abs(lower) * SLACK)
    rows = np.flatnonzero(lower.min(1) <= upper)  # global filter
    best = d.own(rows, cluster[rows])
    upper[rows] = root(best) * (1 + SLACK)
    still = lower[rows].min(1) <= upper[rows]
    rows, best, done = rows[still], best[still], len(rows)
    before, before_d, own = cluster[rows], best.copy(), cluster[rows].copy()
    open_ = lower[rows] <= upper[rows, None]  # group filter, by the bound on the old centroid: it only falls later
    found = {}
    for g, members in enumerate(groups):
        at = np.flatnonzero(open_[:, g])
        if not len(at):
            continue
        here = d.between(rows[at], members)
        done += here.size
        found[g] = (at, here)
        nearest = here.argmin(1)
        value, number = here[np.arange(len(at)), nearest], members[nearest]
        better = ((value < best[at]) | ((value == best[at]) & (number < own[at]))).astype(bool)
        best[at[better]], own[at[better]] = value[better], number[better]
    for g, (at, here) in found.items():  # the nearest of each scanned group besides the new cluster
        away = root(here) * (1 - SLACK)
        away[own[at][:, None] == groups[g][None, :]] = np.inf
        lower[rows[at], g] = away.min(1)
    left = np.flatnonzero(own != before)  # the centroid that was left belongs to the others of its group again
    lower[rows[left], group_of[before[left]]] = np.minimum(lower[rows[left], group_of[before[left]]], root(before_d[left]) * (1 - SLACK))
    cluster[rows], upper[rows] = own, root(best) * (1 + SLACK)
    return cluster, upper, lower, done


def grouped(centroids: np.ndarray, groups: int) -> list[np.ndarray]:
    """The centroids in at most `groups` groups, by a few Lloyd rounds among themselves."""
    c = centroids.astype(np.float64)
    c = c / max(1.0, np.abs(c).max(initial=0))
    seeds = c[np.linspace(0, len(c) - 1, min(groups, len(c))).astype(int)]
    for _ in range(5):
        near = ((c[:, None] - seeds[None]) ** 2).sum(2).argmin(1)
        seeds = np.array([c[near == g].mean(0) if (near == g).any() else seeds[g] for g in range(len(seeds))])
    return [m for g in range(len(seeds)) if len(m := np.flatnonzero(near == g))]


def limbs(value: int) -> list[tuple[int, int]]:
    """(place, part) with value = sum of part << LIMB * place; parts below 2 to LIMB, so that many add up in 64 bits."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    for place in itertools.count():
        if not value:
            return out
        if part := value & ((1 << LIMB) - 1):
            out.append((place, sign * part))
        value >>= LIMB


def added(rows: list) -> dict[tuple[int, int], int]:
    """(cluster, what) to the whole sum."""
    out: dict[tuple[int, int], int] = {}
    for r in rows:
        key = r["cluster"], r["what"]
        out[key] = out.get(key, 0) + (r["part"] << LIMB * r["place"])
    return out


#: Besides components, what is summed: rows, distances, and distances that were computed.
COUNT, DISTANCE, COMPUTED = -1, -2, -3


def one_round(state: DataFrame, first: bool, last: bool, centroids: list[list[int]], moved: np.ndarray, groups: list[np.ndarray], dim: int, scale: int, kind: str) -> DataFrame:
    """The vectors with new clusters and bounds (kind 0), and sums of the task (kind 1)."""
    names = ["kind", "id", "vector", "cluster", "upper", "lower", "distance", "what", "place", "part"]
    c, k, t = np.array(centroids, object).reshape(-1, dim), len(centroids), len(groups)

    def run(batches):
        sums: dict[tuple[int, int], int] = {}
        types = None
        for batch in batches:
            types = types or [batch.schema.field("id").type, batch.schema.field("vector").type]
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vectors, n = part.column(part.schema.get_field_index("vector")), part.num_rows
                x = scaled(vectors, dim, scale)
                if first:
                    old, upper, lower = None, np.zeros(0), np.zeros((0, t))
                else:
                    old, upper = (part.column(part.schema.get_field_index(f)).to_numpy() for f in ("cluster", "upper"))
                    old, lower = old.astype(np.int64), part.column(part.schema.get_field_index("lower")).flatten().to_numpy().reshape(n, t)
                cluster, upper, lower, computed = assign(x, old, upper, lower, c, groups, moved)
                sums[0, COMPUTED] = sums.get((0, COMPUTED), 0) + computed
                far = None
                if last:
                    far = [int(v) for v in Distances(x, c).own(np.arange(n), cluster)]
                for j in np.unique(cluster):
                    mine = np.flatnonzero(cluster == j)
                    new = {COUNT: len(mine)}
                    if last:
                        new[DISTANCE] = sum(far[i] for i in mine)
                    elif np.abs(x).max(initial=0) <= exact(dim):
                        new |= dict(enumerate(x[mine].astype(np.int64).sum(0).tolist()))
                    else:
                        new |= {i: sum(int(v) for v in x[mine, i]) for i in range(dim)}
                    for what, v in new.items():
                        sums[int(j), what] = sums.get((int(j), what), 0) + v
                blank = lambda kind: pa.nulls(n, kind)  # noqa: B023, E731
                kept = [blank(pa.float64()), blank(pa.list_(pa.float64()))] if last else [pa.array(upper), pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * t, pa.int32()), pa.array(lower.ravel()))]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), part.column(part.schema.get_field_index("id")), blank(types[1]) if last else vectors, pa.array(cluster.astype(np.int32)), *kept, pa.array([min(v, MOST) for v in far], pa.int64()) if last else blank(pa.int64()), blank(pa.int32()), blank(pa.int32()), blank(pa.int64())], names)
        rows = [(j, what, place, v) for (j, what), value in sums.items() for place, v in limbs(value)]
        if rows:
            cols, n = list(zip(*rows, strict=True)), len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, types[0]), pa.nulls(n, types[1]), pa.array(cols[0], pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())], names)

    return state.mapInArrow(run, f"kind int, {kind}, cluster int, upper double, lower array<double>, distance long, what int, place int, part long")


def yinyang(table: DataFrame, k: int = K, rounds: int = ROUNDS, groups: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE, seed: str = SEED, report: list | None = None) -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. groups: one for each ten centroids, two at
    least. report gets, for each assignment, how many distances were computed."""
    spark, v = table.sparkSession, F.col(f"`{vector_col}`")
    whole = (F.size(v) == dim) & F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    state = table.filter(v.isNotNull() & whole).select(F.col(f"`{id_col}`").alias("id"), v.alias("vector"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields)
    started = state.orderBy(F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), "vector").limit(k).collect()  # k rows
    centroids = [[int(np.floor(np.float64(a) * scale)) for a in r["vector"]] for r in started]
    if not centroids:
        return state.limit(0).select(F.col("id").alias(id_col), *(F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    parts = grouped(np.array(centroids, object), groups or max(2, -(-k // 10)))
    moved, before = np.zeros(len(centroids)), None
    for i in range(rounds + 1):
        last = i == rounds
        path = new_path(spark, f"clusters-{i}")
        done = one_round(state, i == 0, last, centroids, moved, parts, dim, scale, kind)
        done.write.partitionBy("kind").parquet(path)
        read = spark.read.schema(done.schema).parquet(path)
        state = read.filter("kind = 0").select("id", "vector", "cluster", "upper", "lower", "distance")
        sums = added(read.filter("kind = 1").groupBy("cluster", "what", "place").agg(F.sum("part").alias("part")).collect())  # k times dim numbers
        if before:
            clear(spark, [before])
        before = path
        if report is not None:
            report.append(sums.get((0, COMPUTED), 0))
        if not last:
            new = [[sums.get((j, a), 0) // sums[j, COUNT] for a in range(dim)] if (j, COUNT) in sums else c for j, c in enumerate(centroids)]
            squared = [sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for x, y in zip(new, centroids, strict=True)]
            moved, centroids = np.array([float(s) for s in squared]) ** 0.5 * (1 + SLACK), new
    inertia = [sums.get((j, DISTANCE), 0) for j in range(len(centroids))]
    facts = [(j, min(inertia[j], MOST), min(sum(inertia), MOST), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows are broadcast


def sql(k: int = K, rounds: int = ROUNDS) -> str:
    """Lloyd's rounds, one after another, without bounds."""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda a: CAST(floor({SCALE} * CAST(a AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda a: a IS NOT NULL AND isfinite(a))) = {DIM}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS j, v AS c FROM v QUALIFY j < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, CAST(j AS INTEGER) AS cluster, d FROM (SELECT r, vec_id, v, j, list_sum(list_transform(list_zip(v, c), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS d FROM v, c{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT cluster, i, sum(CAST(x AS HUGEINT)) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({DIM})) AS i FROM a{i}) GROUP BY cluster, i),
c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY cluster) m ON m.cluster = c{i}.j)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON j = cluster"""


SQL = sql()
