"""Mixing sources to target weights: a time-varying curriculum, in DataFrame operations only.

Each source has a target (its share by weight, at most `most` times its size, the excess reshared by weight) and a weight
schedule over training time 0 to 1. The schedule's integral, scaled to the target, is the source's cumulative demand of
words; its documents, in an order drawn by hash, supply them pass after pass. The word that a document begins with in that
supply is met by the demand at one time: the inverse of the cumulative demand gives the document's training position, and
documents are range-sorted by position.

Supplies are running sums over all documents of a source. They are taken by Spark's range exchange: rows are dealt by
(source, draw), so that a large source lies in many ranges; sums per range are carried on, and within a range a window adds
the rest. Nothing but one row for each source and range is ever brought together.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own, last in order; a
source of size 0 has target 0; rows equal in id and text come one after another, each as a document of its own; rows of a
null id are drawn by their texts; very long texts are counted whole and may be cut by the end of a demand; an empty table
gives an empty result; further columns are carried along only where asked for, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import partitions, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeated; how often a document is taken at most; the seed of the draw.
WEIGHTS, MOST, SEED = (5, 2, 1), 3, 12
#: For each weight the schedule's knots (time, height), straight between them: heavy sources come early, light ones late.
SCHEDULES = {5: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)), 1: ((0.0, 0.5), (1.0, 1.5))}


def segments(knots: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float, float]]:
    """(time, length, height, slope, integral before) of each stretch of a schedule, the whole integral scaled to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    if knots[0][0] != 0 or knots[-1][0] != 1 or area <= 0 or any(h < 0 for _, h in knots) or any(b[0] <= a[0] for a, b in zip(knots, knots[1:], strict=False)):
        raise ValueError("a schedule goes from time 0 to 1, is nowhere below 0 and not 0 throughout")
    out, before = [], 0.0
    for (t, h), (u, g) in zip(knots, knots[1:], strict=False):
        out.append((t, u - t, h / area, (g - h) / area / (u - t), before))
        before += (u - t) * (h + g) / 2 / area
    return out


def position(weight: Column, part: Column, schedules: dict) -> Column:
    """The time at which a schedule's integral reaches `part` of the whole, 0 to 1: the inverse of the cumulative demand."""
    found = F.lit(None).cast("double")
    for w, knots in schedules.items():
        here = F.lit(1.0)
        for t, length, height, slope, before in segments(knots):
            left = F.greatest(part - before, F.lit(0.0))  # = height * x + slope * x * x / 2
            root = height + F.sqrt(F.greatest(F.lit(height * height) + F.lit(2 * slope) * left, F.lit(0.0)))
            here = F.when(part >= before, F.lit(t) + F.least(F.when(root > 0, F.lit(2.0) * left / root).otherwise(0.0), F.lit(length))).otherwise(here)
        found = F.when(weight == w, here).otherwise(found)
    return found


def running(df: DataFrame, keys: list[str], order: list, sums: dict[str, str], name: str) -> DataFrame:
    """df with, for each (column, new name) of sums, the sum over earlier rows of the same keys, at any size of a key: rows
    are dealt by ranges of keys and order, sums of whole ranges are carried on. Where no key is given, all rows are one."""
    ranged = df.repartitionByRange(partitions(df.sparkSession), *keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, name)
    per_range = ranged.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_{new}") for c, new in sums.items()))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.select(*keys, "_range", *(F.coalesce(F.sum(f"_{new}").over(earlier), F.lit(0)).alias(f"_{new}") for new in sums.values()))
    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select("*", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"__{new}") for c, new in sums.items()))
    both = inside.join(carried, [*keys, "_range"])
    return both.select(*df.columns, *((F.col(f"_{new}") + F.col(f"__{new}")).alias(new) for new in sums.values()))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """no_source, source, source_size (one row each) with weight and target. Sources are taken by the ratio of cap to weight:
    the first whose cap is not below its weight's share of what is left, and all after it, share by weight; those before it
    stop at their caps. Comparisons are made on whole numbers."""
    ranked = running(sizes.withColumn("one", F.lit(1)), [], ["no_source", "source"], {"one": "no"}, "source-order")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int"))
    ranked = ranked.select("no_source", "source", "source_size", "no", weight.cast("long").alias("weight")).withColumn("cap", F.col("source_size") * most)
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    ranked = running(ranked, [], ["ratio", "no"], {"cap": "caps_before", "weight": "weights_before"}, "source-caps")
    whole = ranked.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weights"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    left, shared = F.col("total") - F.col("caps_before"), F.col("weights") - F.col("weights_before")
    state = ranked.join(F.broadcast(whole)).withColumns({"left": left, "shared": shared})  # a single row
    state = state.withColumn("below", wide("cap") * wide("shared") < wide("weight") * wide("left"))
    first = state.filter(~F.col("below")).agg(F.min(F.struct("ratio", "no", "left", "shared")).alias("first")).select("first.*")
    first = first.select(F.col("ratio").alias("at"), F.col("no").alias("at_no"), (F.col("left") / F.when(F.col("shared") > 0, F.col("shared"))).alias("level"))
    capped = (F.col("ratio") < F.col("at")) | ((F.col("ratio") == F.col("at")) & (F.col("no") < F.col("at_no")))
    target = F.when(capped | F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")))
    return state.join(F.broadcast(first)).select("no_source", "source", "source_size", "weight", target.alias("target"))  # a single row


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, most: int = MOST, schedules: dict = SCHEDULES, seed: int = SEED) -> DataFrame:
    """One row per document, range-sorted by its first training position (those not taken last): id, size, source_size,
    target, taken, weight, position, and passes, an array of (position, words), one for each time that it is taken."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    rows = docs.select(
        F.col(f"`{source_col}`").isNull().alias("no_source"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"), draw.alias("draw"), F.monotonically_increasing_id().alias("tie"),
        F.struct(F.col(f"`{id_col}`").alias("id"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep))).alias("row"), F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("size"),
    )
    key = ["no_source", "source"]
    rows = written(rows, "sizes")  # texts are read once, and ties keep their numbers
    rows = written(running(rows, key, ["draw", "tie"], {"size": "start"}, "supply"), "supplied")
    aims = written(targets(rows.groupBy(key).agg(F.sum("size").alias("source_size")), weights, most), "targets")
    # a source's rows lie in many ranges; the join's other side has one row a source, and Spark splits the larger one
    state = rows.join(aims, key).withColumn("demand", F.floor("target").cast("long"))
    words = lambda i: F.greatest(F.least(F.col("demand") - F.col("start") - i * F.col("source_size"), F.col("size")), F.lit(0))
    at = lambda i: position(F.col("weight"), (F.col("start") + i * F.col("source_size")) / F.col("target"), schedules)
    passes = F.filter(F.array(*(F.struct(F.when(words(i) > 0, at(i)).alias("position"), words(i).alias("words")) for i in range(most))), lambda x: x["words"] > 0)
    state = state.withColumn("passes", passes).withColumn("taken", sum((words(i) for i in range(most)), F.lit(0)))
    state = state.withColumn("position", F.get("passes", F.lit(0))["position"])
    state = state.orderBy(F.col("position").asc_nulls_last(), "draw", "tie")
    return state.select(F.col("row.id").alias(id_col), *(F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)), "size", "source_size", "target", "taken", "weight", "position", "passes")


def training_order(mixed: DataFrame) -> DataFrame:
    """The passes of mix(), one row each, range-sorted by position: the order of training. Words beyond a pass's `words` are
    those that the end of the source's demand cuts off."""
    held = [c for c in mixed.columns if c not in ("passes", "position", "taken")]
    return mixed.select(*held, F.explode("passes").alias("p")).select(*held, F.col("p.position").alias("position"), F.col("p.words").alias("words")).orderBy("position", *held[:1])


def _sql_position(weight: str, part: str) -> str:
    cases = []
    for w, knots in SCHEDULES.items():
        here = "1.0::DOUBLE"
        for t, length, height, slope, before in segments(knots):
            left = f"greatest({part} - {before!r}::DOUBLE, 0.0::DOUBLE)"
            root = f"({height!r}::DOUBLE + sqrt(greatest({height * height!r}::DOUBLE + {2 * slope!r}::DOUBLE * {left}, 0.0::DOUBLE)))"
            here = f"CASE WHEN {part} >= {before!r}::DOUBLE THEN {t!r}::DOUBLE + least(CASE WHEN {root} > 0 THEN 2.0::DOUBLE * {left} / {root} ELSE 0.0::DOUBLE END, {length!r}::DOUBLE) ELSE {here} END"
        cases.append(f"WHEN {w} THEN {here}")
    return f"CASE {weight} {' '.join(cases)} END"


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS draw FROM documents),
s AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS no FROM (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source)),
r AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER o, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS shared
  FROM s WINDOW o AS (ORDER BY {MOST} * source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT no AS first_no, {MOST} * source_size / weight AS first_ratio, rest::BIGINT / shared::BIGINT AS level FROM r WHERE {MOST} * source_size * shared >= weight * rest ORDER BY first_ratio, no LIMIT 1),
t AS (
  SELECT source, source_size::BIGINT AS source_size, weight,
    CASE WHEN ({MOST} * source_size / weight, no) < (first_ratio, first_no) THEN CAST({MOST} * source_size AS DOUBLE) ELSE least(weight * level, CAST({MOST} * source_size AS DOUBLE)) END AS target FROM r, f),
c AS (
  SELECT doc_id, size, source_size, target, weight, floor(target)::BIGINT AS demand,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, {" + ".join(f"greatest(least(demand - start - {i} * source_size, size), 0)" for i in range(MOST))} AS taken, start / target AS part FROM c)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN {_sql_position("weight", "part")} END AS position FROM p
"""
