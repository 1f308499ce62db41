"""Documents as nested structures: paragraphs with ordinals, structural checks, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text

#: Shape of a transcript document; a speaker's paragraphs stand in plist or directly below.
XML_SCHEMA = (
    "meta struct<title:string,date:string,companies:struct<company:array<string>>,participants:struct<participant:array<struct<_id:string,_type:string,_affiliation:string,_affiliation_entity:string,_title:string,_entity:string,_VALUE:string>>>>,"
    "body struct<section:array<struct<_name:string,speaker:array<struct<_id:string,_type:string,plist:struct<p:array<string>>,p:array<string>>>>>>"
)


def parsed(files: DataFrame, content: str = "content") -> DataFrame:
    """files with `doc`, the parsed document, null fields where it is malformed. A default namespace is dropped first."""
    plain = F.regexp_replace(F.col(content).cast("string"), r'\sxmlns="[^"]*"', "")
    return files.withColumn("doc", F.from_xml(plain, XML_SCHEMA, {"mode": "PERMISSIVE"}))


def headers(docs: DataFrame, *keys: str) -> DataFrame:
    """keys, title, date, companies and people (ids, each once, in order) of parsed docs; empty arrays where there are none."""
    none = F.array().cast("array<string>")
    ids = F.transform(F.col("doc.meta.participants.participant"), lambda p: p["_id"])
    named = F.filter(F.coalesce(F.transform("doc.meta.companies.company", text.clean), none), lambda c: F.coalesce(c != "", F.lit(False)))
    return docs.select(*keys, text.clean(F.col("doc.meta.title")).alias("title"), text.none_if_blank(F.col("doc.meta.date")).alias("date"), named.alias("companies"), F.array_distinct(F.array_compact(F.coalesce(ids, none))).alias("people"))


def _pruned_sections() -> Column:
    """Sections with speakers with paragraphs; whatever has none is gone, so ordinals count what is left."""
    filled = lambda ps: F.filter(F.transform(F.coalesce(ps, F.array().cast("array<string>")), text.clean), lambda p: F.coalesce(p != "", F.lit(False)))
    speaker = lambda s: F.struct(s["_id"].alias("id"), s["_type"].alias("kind"), filled(F.coalesce(s["plist"]["p"], s["p"])).alias("ps"))
    speakers = lambda ss: F.filter(F.transform(F.coalesce(ss, F.array()), speaker), lambda s: F.size(s["ps"]) > 0)
    sections = F.transform(F.col("doc.body.section"), lambda s: F.struct(s["_name"].alias("name"), speakers(s["speaker"]).alias("speakers")))
    return F.filter(sections, lambda s: F.size(s["speakers"]) > 0)


def paragraphs(docs: DataFrame, key: str) -> DataFrame:
    """A row for each paragraph of parsed docs: section_id, section_name, speaker_block_id, paragraph_id (both over the
    whole document, from 1), question_answer_flag, speaker, paragraph_content. Ordinals come from positions within the
    document's own arrays, so no shuffle is needed."""
    people = F.map_from_entries(F.transform(F.array_distinct(F.filter(F.transform(F.coalesce("doc.meta.participants.participant", F.array()), lambda p: p["_id"]), lambda i: i.isNotNull())), lambda i: F.struct(i, F.filter(F.col("doc.meta.participants.participant"), lambda p: p["_id"] == i)[0])))
    flat = F.flatten(F.transform("_sections", lambda s, i: F.transform(s["speakers"], lambda k: F.struct((i + 1).alias("section_id"), s["name"].alias("section_name"), k["id"].alias("id"), k["kind"].alias("kind"), k["ps"].alias("ps")))))
    rows = F.flatten(F.transform("_blocks", lambda b, i: F.transform(b["ps"], lambda p: F.struct(b["section_id"].alias("section_id"), b["section_name"].alias("section_name"), (i + 1).alias("speaker_block_id"), b["id"].alias("id"), b["kind"].alias("kind"), p.alias("paragraph_content")))))
    out = docs.withColumn("_sections", _pruned_sections()).withColumn("_blocks", flat).withColumn("_people", people)
    out = out.select(key, F.col("doc.meta.title").alias("title"), "_people", F.posexplode(rows).alias("_at", "_row"))
    who = F.col("_people")[F.col("_row.id")]
    return out.select(
        key, "title", "_row.section_id", "_row.section_name", (F.col("_at") + 1).alias("paragraph_id"), "_row.speaker_block_id",
        text.question_flag(F.col("_row.kind")).alias("question_answer_flag"), text.speaker_label(who["_VALUE"], who["_title"], who["_affiliation"]).alias("speaker"), "_row.paragraph_content",
    )


def exploded_paragraphs(blocks: DataFrame, key: str, block: str, content: str) -> DataFrame:
    """Lines of each block as paragraphs; blank ones go; paragraph_id runs over the whole key."""
    lines = F.filter(F.transform(F.split(content, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = blocks.select(key, block, F.posexplode(lines).alias("_at", "paragraph_content"))
    w = Window.partitionBy(key).orderBy(block, "_at")
    return rows.select(key, block, F.row_number().over(w).alias("paragraph_id"), F.dense_rank().over(Window.partitionBy(key).orderBy(block)).alias("speaker_block_id"), "paragraph_content")


def structure(rows: DataFrame, key: str, name: str, expected: list[str]) -> DataFrame:
    """Whether each key has exactly the expected names: is_valid, errors (count, then missing, then unexpected), found
    names, number of rows. Blank names are ignored."""
    names = F.array_sort(F.collect_set(text.none_if_blank(F.trim(name))))
    want = F.array(*(F.lit(x) for x in expected))
    grouped = rows.groupBy(key).agg(names.alias("sections_found"), F.count(F.lit(1)).alias("total_records"))
    wrong = F.when(F.size("sections_found") != len(expected), F.array(F.concat(F.lit(f"expected {len(expected)} sections, found "), F.size("sections_found"))))
    missing = F.transform(F.array_except(want, "sections_found"), lambda x: F.concat(F.lit("missing: "), x))
    more = F.transform(F.array_except("sections_found", want), lambda x: F.concat(F.lit("unexpected: "), x))
    errors = F.concat(F.coalesce(wrong, F.array().cast("array<string>")), missing, more)
    return grouped.withColumn("validation_errors", errors).withColumn("is_valid", F.size("validation_errors") == 0)


def valid_rows(rows: DataFrame, verdicts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """rows of valid keys, and all others."""
    good = verdicts.where("is_valid").select(key)
    return rows.join(good, key, "left_semi"), rows.join(good, key, "left_anti")


def version_histogram(versions: DataFrame, family: str) -> DataFrame:
    """How many families have how many versions."""
    return versions.groupBy(family).agg(F.count(F.lit(1)).alias("versions")).groupBy("versions").agg(F.count(F.lit(1)).alias("families"))


def duplicates(rows: DataFrame, column: str, first: str) -> DataFrame:
    """Values found more than once: how often, and the first row that has it."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")).where("n > 1")


def first_of_each(rows: DataFrame, column: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(column).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def samples(rows: DataFrame, group: str, order: list[Column], n: int = 3) -> DataFrame:
    """The first n rows of each group, with their number. Spark cuts the groups before it sorts them (group limit)."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)
