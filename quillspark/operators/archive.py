"""Versioned archives: names, best versions, differences from a master table, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import Settings
from quillspark.functions import text

#: Rank of a version's kind.
KIND_RANK = {"Corrected": 4, "Final": 3, "Script": 2, "Raw": 1}


def kind_rank(kind: Column, ranks: dict[str, int] = KIND_RANK) -> Column:
    known = F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))
    return F.coalesce(known[kind], F.lit(0))


def version_number(version: Column) -> Column:
    """The number if the text is all digits, else 0."""
    return F.when(version.rlike("^[0-9]+$"), F.coalesce(version.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def named_parts(name: Column, exact: bool = True) -> Column:
    """struct(ticker, quarter, year, kind, event_id, version_id, family) of `ticker_quarter_year_kind_event_version.xml`,
    null where there are not six parts (exact) or fewer than six, or where one of the first three is empty."""
    parts = F.split(F.regexp_replace(text.basename(name), r"\.xml$", ""), "_")
    enough = (F.size(parts) == 6) if exact else (F.size(parts) >= 6)
    filled = (F.get(parts, F.lit(0)) != "") & (F.get(parts, F.lit(1)) != "") & (F.get(parts, F.lit(2)) != "")
    fields = ("ticker", "quarter", "year", "kind", "event_id", "version_id")
    found = F.struct(*(F.get(parts, F.lit(i)).alias(f) for i, f in enumerate(fields)), F.array_join(F.slice(parts, 1, 3), "_").alias("family"))
    return F.when(enough & filled, found)


def path_parts(path: Column, root: str = "Data") -> Column:
    """struct(year, quarter, kind): the three steps behind the first `root` of a path that has three behind it."""
    steps = F.split(path, "/")
    at = F.array_position(steps, root).cast("int")
    return F.when((at > 0) & (F.size(steps) >= at + 3), F.struct(F.get(steps, at).alias("year"), F.get(steps, at + 1).alias("quarter"), F.get(steps, at + 2).alias("kind")))


def best(versions: DataFrame, family: str | list[str], order: list[Column]) -> DataFrame:
    """One row of each family: the first by `order`. The order must be total for a repeatable result."""
    w = Window.partitionBy(family).orderBy(*order)
    return versions.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def current_order(rank: str, version: str, changed: str, ordinal: str) -> list[Column]:
    """Rank of the kind, then version, then time of change, each greatest first; ties keep the input's order."""
    return [F.col(rank).desc(), F.col(version).desc(), F.col(changed).desc_nulls_last(), F.col(ordinal).asc()]


def legacy_order(rank: str, version: str, changed: str, ordinal: str) -> list[Column]:
    """By ten times the version plus the rank, then time of change."""
    return [(F.col(version) * 10 + F.col(rank)).desc(), F.col(changed).desc_nulls_last(), F.col(ordinal).asc()]


def difference(archive: DataFrame, master: DataFrame, family: str, name: str, changed: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(to process, to remove), by family. The best of the archive is compared with the best of the master: if only the
    archive has the family, its best is processed; if only the master has it, all its names go; if names or times differ
    (null-safe), the best is processed and all the master's names go."""
    keys = [F.col(family), F.col(name), F.col(changed)]
    a = best(archive, family, order).select(keys[0], F.struct(*keys[1:]).alias("a"))
    m = best(master, family, order).select(keys[0], F.struct(*keys[1:]).alias("m"))
    both = a.join(m, family, "full_outer")
    changed_ = ~(F.col(f"a.{name}").eqNullSafe(F.col(f"m.{name}")) & F.col(f"a.{changed}").eqNullSafe(F.col(f"m.{changed}")))
    touched = both.where(F.col("a").isNull() | F.col("m").isNull() | changed_)
    process = touched.where("a IS NOT NULL").select(family, F.col(f"a.{name}").alias(name))
    remove = master.join(touched.where("m IS NOT NULL").select(family), family, "left_semi").select(family, name)
    return process, remove


def difference_by_name(archive: DataFrame, master: DataFrame, name: str, changed: str) -> DataFrame:
    """(name, status): new, modified or deleted; what is the same on both sides is left out."""
    a, m = archive.select(name, F.col(changed).alias("_a"), F.lit(1).alias("_in_a")), master.select(name, F.col(changed).alias("_m"), F.lit(1).alias("_in_m"))
    status = F.when(F.col("_in_m").isNull(), "new").when(F.col("_in_a").isNull(), "deleted").when(~F.col("_a").eqNullSafe(F.col("_m")), "modified")
    return a.join(m, name, "full_outer").select(name, status.alias("status")).where("status IS NOT NULL")


def without_ignored(rows: DataFrame, ignored: DataFrame, keys: list[str]) -> DataFrame:
    """rows whose keys, as trimmed text, are not on the list."""
    same = [F.trim(rows[k].cast("string")) == F.trim(ignored[k].cast("string")) for k in keys]
    return rows.join(ignored, same, "left_anti")


def sync_status(found: DataFrame, archive: DataFrame, ordinal: str) -> DataFrame:
    """found(event_id, kind, ticker, version_id) against the archive's rows of these columns: status new_event, new_kind,
    version_update (replaces: the version it stands for) or unchanged. Of several matches the first by ordinal counts."""
    keys = ["event_id", "kind", "ticker"]
    first = best(archive, keys, [F.col(ordinal).asc()]).select(*keys, F.col("version_id").alias("_have"))
    events = archive.select("event_id").distinct().withColumn("_seen", F.lit(1))
    joined = found.join(first, keys, "left").join(events, "event_id", "left")
    status = F.when(F.col("_seen").isNull(), "new_event").when(F.col("_have").isNull(), "new_kind").when(F.col("_have") != F.col("version_id"), "version_update").otherwise("unchanged")
    return joined.withColumn("status", status).withColumn("replaces", F.when(F.col("status") == "version_update", F.col("_have"))).drop("_have", "_seen")


def merged(master: DataFrame, removed_paths: DataFrame, new_rows: DataFrame, name: str, path: str = "path") -> DataFrame:
    """master without rows whose name is the last step of a removed path, and the new rows."""
    gone = removed_paths.select(text.basename(F.col(path)).alias(name)).distinct()
    return master.join(gone, name, "left_anti").unionByName(new_rows, allowMissingColumns=True)


def latest_change(rows: DataFrame, name: str, changed: str) -> DataFrame:
    """The greatest time of change of each name."""
    return rows.groupBy(name).agg(F.max(changed).alias(changed))


def sole_member(rows: DataFrame, members: str, allowed: DataFrame, key: str) -> DataFrame:
    """rows with exactly one member, which is one of the allowed keys."""
    one = rows.where(F.size(members) == 1).withColumn(key, F.col(members)[0])
    return one.join(allowed.select(key).distinct(), key, "left_semi")


def is_sole_id(ids: Column, ticker: Column) -> Column:
    """Whether the ticker is the only primary id; false for null."""
    return F.coalesce((F.size(ids) == 1) & (F.get(ids, F.lit(0)) == ticker), F.lit(False))


def is_earnings(ids: Column, event_type: Column) -> Column:
    """One primary id, and `Earnings` in the type of the event."""
    return F.coalesce((F.size(ids) == 1) & event_type.contains("Earnings"), F.lit(False))


def of_kinds(rows: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """rows of the kinds that the settings name."""
    return rows.where(F.col(kind).isin(settings.kinds))


def resume(work: DataFrame, done: DataFrame, key: str, again: bool = False) -> DataFrame:
    """work with `action`: skip what is completed and verified, or failed (unless again); run the rest."""
    state = done.select(key, F.col("status").alias("_status"), F.col("verified").alias("_verified"))
    skip = (F.col("_status") == "completed") & F.coalesce(F.col("_verified"), F.lit(False)) | (F.col("_status") == "failed") & F.lit(not again)
    return work.join(state, key, "left").withColumn("action", F.when(skip, "skip").otherwise("run")).drop("_status", "_verified")
