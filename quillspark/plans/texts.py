"""Queries over documents, pages and conversations as documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import documents, enrichment, token_count
from quillspark.plans.book import Book, read
from quillspark.sources import sinks

book = Book()


@book.add("""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS page_text FROM pages""")
def html_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.html_text(F.col("html")).alias("page_text"))


_LINES = """(SELECT conv_id, turn, role, trim(x) AS paragraph_content, i FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM conversations) WHERE trim(x) <> '')"""


@book.add(f"""
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS INTEGER) AS paragraph_id, CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS speaker_block_id, paragraph_content FROM {_LINES}""")
def paragraph_explode(spark, sf_dir):
    return documents.exploded_paragraphs(read(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@book.add(f"""
SELECT conv_id, CAST(section AS INTEGER) AS section_id, CASE section WHEN 1 THEN 'MANAGEMENT DISCUSSION SECTION' ELSE 'Q&A' END AS section_name,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS INTEGER) AS paragraph_id, CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS speaker_block_id,
  CASE WHEN turn >= 2 THEN CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' END END AS question_answer_flag,
  CASE role WHEN 'user' THEN 'Ann, Analyst' WHEN 'assistant' THEN 'Bob' ELSE 'Unknown Speaker' END AS speaker, paragraph_content
FROM (SELECT *, CASE WHEN turn < 2 THEN 1 WHEN min(turn) OVER (PARTITION BY conv_id) < 2 THEN 2 ELSE 1 END AS section FROM {_LINES})""")
def xml_paragraphs(spark, sf_dir):
    """Conversations written as XML transcripts (the first two turns are one section), parsed and exploded again."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    ps = F.array_join(F.transform(F.split("text", "\n"), lambda p: F.concat(F.lit("<p>"), esc(p), F.lit("</p>"))), "")
    kind = F.when(F.col("turn") >= 2, F.when(F.col("role") == "user", "q").when(F.col("role") == "assistant", "a")).otherwise("")
    speaker = F.concat(F.lit('<speaker id="'), "role", F.lit('" type="'), F.coalesce(kind, F.lit("")), F.lit('"><plist>'), ps, F.lit("</plist></speaker>"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", speaker.alias("x")).alias("s"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    part = lambda early: F.array_join(F.transform(F.filter("s", lambda x: (x["turn"] < 2) if early else (x["turn"] >= 2)), lambda x: x["x"]), "")
    people = '<participants><participant id="user" title="Analyst">Ann</participant><participant id="assistant" title="Bob">Bob</participant></participants>'
    content = F.concat(F.lit(f'<transcript xmlns="urn:t"><meta><title>Q1 2024 Earnings Call</title>{people}</meta><body><section name="MANAGEMENT DISCUSSION SECTION">'), part(True), F.lit('</section><section name="Empty"></section><section name="Q&amp;A">'), part(False), F.lit("</section></body></transcript>"))
    return documents.paragraphs(documents.parsed(held.select("conv_id", content.alias("content"))), "conv_id").drop("title")


_STRUCTURE = """
WITH g AS (SELECT conv_id, list_sort(list(DISTINCT role)) AS f, count(*) AS total_records FROM conversations GROUP BY conv_id)
SELECT conv_id, f AS sections_found, total_records,
  list_concat(CASE WHEN len(f) <> 2 THEN ['expected 2 sections, found ' || len(f)] ELSE [] END,
    list_transform(list_filter(['user', 'assistant'], lambda x: NOT list_contains(f, x)), lambda x: 'missing: ' || x),
    list_transform(list_filter(f, lambda x: x NOT IN ('user', 'assistant')), lambda x: 'unexpected: ' || x)) AS validation_errors,
  len(f) = 2 AND list_contains(f, 'user') AND list_contains(f, 'assistant') AS is_valid
FROM g"""


@book.add(_STRUCTURE)
def structure_validation(spark, sf_dir):
    return documents.structure(read(spark, sf_dir, "conversations"), "conv_id", "role", ["user", "assistant"])


@book.add("""
WITH v AS (SELECT conv_id, list_sort(list(DISTINCT role)) = ['assistant', 'user'] AS ok FROM conversations GROUP BY conv_id)
SELECT conv_id, turn, ok FROM conversations JOIN v USING (conv_id)""")
def valid_split(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    good, bad = documents.valid_rows(turns, documents.structure(turns, "conv_id", "role", ["user", "assistant"]), "conv_id")
    return good.select("conv_id", "turn", F.lit(True).alias("ok")).unionByName(bad.select("conv_id", "turn", F.lit(False).alias("ok")))


@book.add("""
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'user, Analyst, Fund' WHEN 'assistant' THEN 'assistant, Fund' ELSE 'Unknown Speaker' END AS speaker, role = 'user' AS is_analyst,
  CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' END AS question_answer_flag, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview FROM conversations""")
def speaker_label(spark, sf_dir):
    role = F.col("role")
    title = F.when(role == "user", "Analyst").when(role == "assistant", "assistant")
    label = text.speaker_label(F.when(role == "system", "").otherwise(role), title, F.lit("Fund"))
    flag = text.question_flag(F.when(role == "user", "q").when(role == "assistant", "a"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", label.alias("speaker"), text.is_analyst(label).alias("is_analyst"), flag.alias("question_answer_flag"), text.preview(F.col("text"), 100).alias("preview"))


_WORDS = "list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')"


@book.add(f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS words, CASE WHEN length(text) > 0 THEN CAST(trunc((length(array_to_string(w, ' ')) / 3.5::DOUBLE * 0.5::DOUBLE + length(text) / 4.0::DOUBLE * 0.3::DOUBLE + len(w) * 1.3::DOUBLE * 0.2::DOUBLE) * 1.1::DOUBLE) AS INTEGER) ELSE 0 END AS tokens
FROM (SELECT doc_id, text, {_WORDS} AS w FROM documents)""")
def token_estimate(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"), text.token_estimate(F.col("text")).alias("tokens"))


@book.add("""
SELECT conv_id, round(sum(length(text)) FILTER (role = 'user') / 1000 * 0.005::DOUBLE + coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) / 1000 * 0.015::DOUBLE, 6) AS cost FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0""")
def token_cost(spark, sf_dir):
    n = F.length("text")
    sums = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(F.when(F.col("role") == "user", n)).alias("p"), F.coalesce(F.sum(F.when(F.col("role") == "assistant", n)), F.lit(0)).alias("c"))
    return sums.where("p IS NOT NULL").select("conv_id", text.token_cost(F.col("p"), F.col("c"), 0.005, 0.015).alias("cost"))


@book.add("SELECT doc_id, sha256(text) AS checksum FROM documents")
def file_checksum(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", sinks.checksum(F.col("text")).alias("checksum"))


@book.add("SELECT doc_id, trim(replace(replace(replace(replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), chr(10), ' '), chr(13), ' '), chr(9), ' '), '\"', '\\\"')) AS clean_text FROM documents")
def string_hygiene(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.escaped(F.col("text")).alias("clean_text"))


@book.add("SELECT count(*) AS n, count(DISTINCT text) AS texts, count(DISTINCT doc_id) AS ids FROM documents")
def distinct_checks(spark, sf_dir):
    return read(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.md5("text")).alias("texts"), F.count_distinct("doc_id").alias("ids"))


@book.add("SELECT sha256(text) AS checksum, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", sinks.checksum(F.col("text")).alias("checksum"))
    return documents.duplicates(rows, "checksum", "doc_id")


@book.add("SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def dedupe_text(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", sinks.checksum(F.col("text")).alias("checksum"))
    return documents.first_of_each(rows, "checksum", [F.col("doc_id")]).select("doc_id")


@book.add("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def frequency_report(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source")


KEYWORDS = {1: ["the ", "with"], 2: ["der ", "und"], 3: ["les ", "pour"], 4: ["que "], 5: ["license"]}
NAMES = {0: "Other", 1: "English", 2: "German", 3: "French", 4: "Spanish", 5: "Licence"}
_IDS = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN {i} END" for i, ws in KEYWORDS.items()) + "], lambda x: x IS NOT NULL)"
CATEGORY_IDS = f"(SELECT doc_id, CASE WHEN len({_IDS}) > 0 THEN {_IDS} ELSE [0] END AS ids FROM documents)"


@book.add(f"SELECT doc_id, ids AS classification_ids, list_transform(ids, lambda i: (['Other', 'English', 'German', 'French', 'Spanish', 'Licence'])[i + 1]) AS classification_names FROM {CATEGORY_IDS}")
def category_multilabel(spark, sf_dir):
    ids = enrichment.by_keywords(F.col("text"), KEYWORDS)
    return read(spark, sf_dir, "documents").select("doc_id", ids.alias("classification_ids")).withColumn("classification_names", enrichment.names_of(F.col("classification_ids"), NAMES))


@book.add(f"SELECT doc_id FROM {CATEGORY_IDS} WHERE list_has_any(ids, [4, 5]) ORDER BY doc_id")
def category_overlap(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(enrichment.has_category(F.col("text"), KEYWORDS, [4, 5])).select("doc_id").orderBy("doc_id")


_BLOCK_IDS = _IDS.replace("lower(text)", "lower(t)")


@book.add(f"""
WITH b AS (SELECT conv_id, role, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id, role), i AS (SELECT conv_id, role, {_BLOCK_IDS} AS x FROM b)
SELECT conv_id, turn, CASE WHEN len(x) > 0 THEN x ELSE [0] END AS classification_ids FROM conversations JOIN i USING (conv_id, role)""")
def category_by_block(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "role", "turn", "text")
    return enrichment.classify(rows, "conv_id", "role", "turn", "text", lambda c: enrichment.by_keywords(c, KEYWORDS), NAMES).select("conv_id", "turn", "classification_ids")


@book.add("""
SELECT doc_id, coalesce(source, 'Unknown Speaker') || ': ' || CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS block_summary FROM documents""")
def summaries_other(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", enrichment.template_summary(F.col("source"), F.col("text")).alias("block_summary"))


@book.add("""
SELECT doc_id, coalesce(nullif(regexp_extract(text, '^(.{1,200}?[.!?])([ \\t\\n\\r\\f\\v]|$)', 1, 's'), ''), CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END) AS block_summary FROM documents""")
def summaries_lead(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", enrichment.lead_summary(F.col("text")).alias("block_summary"))


@book.add("SELECT conv_id, turn, role || ' | ' || turn || ' | ' || length(text) AS line FROM conversations")
def line_formats(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(" | ", "role", F.col("turn"), F.length("text")).alias("line"))


@book.add("""
SELECT count(*) AS rows, count(*) FILTER (vec_id % 13 = 0) AS lacking, count(*) FILTER (vec_id % 11 = 0 OR vec_id % 7 = 0) AS bad_vectors FROM embeddings""")
def integrity_check(spark, sf_dir):
    """Over vectors of which some are cut, some are missing, and labels of which some are missing."""
    vector = F.when(F.col("vec_id") % 11 != 0, F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding")))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 13 != 0, F.col("label")).alias("label"), vector.alias("embedding"))
    return sinks.integrity(rows, ["vec_id", "label"], "embedding", 64)


@book.add("SELECT doc_id FROM documents WHERE list_contains(regexp_extract_all(lower(text), '[a-z0-9]+'), 'license') AND list_contains(regexp_extract_all(lower(text), '[a-z0-9]+'), 'the') ORDER BY doc_id")
def full_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(text.has_terms(F.col("text"), ["license", "the"])).select("doc_id").orderBy("doc_id")


@book.add("SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS INTEGER) AS terms FROM documents")
def text_terms(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(text.terms(F.col("text"))).alias("terms"))


@book.add("""
SELECT conv_id, turn, array_to_string(list_transform(list_slice(p, 1, 3), lambda x: CASE WHEN length(x) > 200 THEN substr(x, 1, 200) || '...' ELSE x END), chr(10)) || CASE WHEN len(p) > 3 THEN chr(10) || '... and ' || (len(p) - 3) || ' more' ELSE '' END AS digest,
  '1: English, 5: Licence' AS labels FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS p FROM conversations)""")
def block_digest(spark, sf_dir):
    ids = F.array(F.lit(1), F.lit(77), F.lit(5))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", text.block_digest(F.split("text", "\n")).alias("digest"), text.labelled_ids(ids, NAMES).alias("labels"))


@book.add()
def token_counts(spark, sf_dir):
    """Tokens of each document by a public vocabulary; tested against its own encoder on all documents."""
    import public_tokenizers

    return token_count.token_counts(read(spark, sf_dir, "documents"), "doc_id", "text", f"file://{public_tokenizers.path('byte_bpe_50k.tiktoken')}")
