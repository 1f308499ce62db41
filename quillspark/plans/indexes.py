"""Queries over indexes that are written first: vectors, terms, categories; names against texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import documents, enrichment, name_match, text_index, vector_index
from quillspark.plans.book import Book, read
from quillspark.plans.texts import CATEGORY_IDS, KEYWORDS
from quillspark.tables import new_path

book = Book()
#: Width of the vectors of the tables.
WIDTH = 64


def _vectors(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    return vector_index.build(rows, "vec_id", "embedding", new_path(spark, "vectors"), WIDTH, keep=("label",)), rows.where("vec_id % 50 = 0")


_TRUE = """
SELECT * FROM (SELECT q.vec_id AS query, a.vec_id AS key, a.label,
  round(list_sum(list_transform(list_zip(a.embedding, q.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(q.embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS similarity,
  CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY similarity DESC, a.vec_id) AS INTEGER) AS rank
FROM embeddings a, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 10"""


@book.add(_TRUE)
def vector_search_all_lists(spark, sf_dir):
    """The ten most similar vectors of every fiftieth one, through an index of which all lists are probed."""
    index, queries = _vectors(spark, sf_dir)
    return index.search(queries, "vec_id", "embedding", 10, len(index.centroids), keep=("label",))


@book.add()
def vector_search(spark, sf_dir):
    """The same from the lists that the index probes by itself; tested against the exact search."""
    index, queries = _vectors(spark, sf_dir)
    return index.search(queries, "vec_id", "embedding", 10, keep=("label",))


@book.add(f"SELECT count(DISTINCT query) AS queries, count(*) AS neighbours, true AS enough FROM ({_TRUE})")
def vector_recall(spark, sf_dir):
    """Whether the index finds 95 of 100 true neighbours."""
    index, queries = _vectors(spark, sf_dir)
    return index.recall(queries, "vec_id", "embedding").select("queries", "neighbours", (F.col("found") >= 0.95 * F.col("neighbours")).alias("enough"))


_ASKED = {"licence": ("all", ["license", "the"]), "rare": ("all", ["apache", "license", "version"]), "either": ("any", ["mit", "apache", "nosuchword"]), "phrase": ("phrase", ["under", "the", "mit", "license"]), "repeat": ("phrase", ["the", "the"]), "none": ("all", ["license", "nosuchword"])}


def _asked_sql() -> str:
    has = lambda w: f"list_contains(t, '{w}')"
    rule = {"all": lambda ws: " AND ".join(map(has, ws)), "any": lambda ws: " OR ".join(map(has, ws)), "phrase": lambda ws: f"contains(' ' || array_to_string(t, ' ') || ' ', ' {' '.join(ws)} ')"}
    parts = [f"SELECT '{q}' AS query, doc_id AS id FROM d WHERE {rule[kind](ws)}" for q, (kind, ws) in _ASKED.items()]
    return f"WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents) {' UNION ALL '.join(parts)}"


@book.add(_asked_sql())
def text_index_search(spark, sf_dir):
    """All words, any word and phrases, by the postings of an inverted index."""
    path = new_path(spark, "terms")
    text_index.build(read(spark, sf_dir, "documents"), "doc_id", text.ordered_terms(F.col("text")), path)
    return text_index.search(spark, path, text_index.queries_of(spark, _ASKED))


@book.add("SELECT conv_id AS id, query FROM (SELECT conv_id, list_distinct(list(role)) AS r, count(*) AS n FROM conversations GROUP BY conv_id) JOIN (VALUES ('both', 2), ('short', 1)) v(query, k) ON CASE k WHEN 2 THEN list_contains(r, 'user') AND list_contains(r, 'assistant') ELSE n <= 2 END")
def text_index_appended(spark, sf_dir):
    """An index that is written in two parts: ids of conversations by their roles, and by how many turns they have."""
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_append(F.collect_set("role"), F.when(F.count(F.lit(1)) <= 2, "few").otherwise("many")).alias("tags"))
    path = new_path(spark, "tags")
    for part in range(2):
        text_index.build(rows.where(F.col("conv_id") % 2 == part), "conv_id", F.col("tags"), path, buckets=4, append=part > 0)
    return text_index.search(spark, path, text_index.queries_of(spark, {"both": ("all", ["user", "assistant"]), "short": ("any", ["few"])}))


@book.add(f"SELECT doc_id AS id FROM {CATEGORY_IDS} WHERE list_has_any(ids, [4, 5])")
def category_index(spark, sf_dir):
    """Documents of some categories, by an index over their arrays of ids."""
    ids = enrichment.by_keywords(F.col("text"), KEYWORDS)
    path = new_path(spark, "categories")
    text_index.build(read(spark, sf_dir, "documents"), "doc_id", F.transform(ids, lambda i: i.cast("string")), path, buckets=8)
    return text_index.search(spark, path, text_index.queries_of(spark, {"of both": ("any", ["4", "5"])})).select("id")


#: Titles of pages against the first words of documents, by doc_id.
_NAMES = "SELECT doc_id AS o, split_part(text, ' ', 1) AS name FROM documents"
_TITLES = "SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title FROM pages"


@book.add(f"""
SELECT page_id, min(o) AS ordinal, min_by(name, (o, name)) AS name
FROM ({_TITLES}) JOIN ({_NAMES}) ON length(title) > 0 AND length(name) > 0 AND (contains(lower(title), lower(name)) OR contains(lower(name), lower(title))) GROUP BY page_id""")
def names_of_any_table(spark, sf_dir):
    """The first name that stands in the title of a page, or in which the title stands: an equality join on rare q-grams."""
    titles = read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))
    names = read(spark, sf_dir, "documents").select("doc_id", F.split_part("text", F.lit(" "), F.lit(1)).alias("name"))
    found = name_match.first_match(titles, "title", names, "name", "doc_id").where("matched IS NOT NULL")
    return found.select("page_id", F.col("matched.ordinal").alias("ordinal"), F.col("matched.name").alias("name"))


@book.add("""
WITH n AS (SELECT c_custkey AS o, 'T-' || c_custkey AS ticker, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ' ' || c_custkey % 7 ELSE c_custkey % 50 || '' END AS name FROM customer),
d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN 'Co ' || o_custkey || ' of HOUSEHOLD ' || o_orderkey % 11 END AS company FROM orders),
m AS (SELECT company, min_by(ticker, o) AS ticker FROM (SELECT DISTINCT company FROM d) JOIN n ON contains(lower(company), lower(name)) OR contains(lower(name), lower(company)) GROUP BY company)
SELECT o_orderkey, coalesce(company, 'Unknown Company') AS primary_company, ticker AS primary_ticker FROM d LEFT JOIN m USING (company)""")
def primary_company(spark, sf_dir):
    """The first company of a document's list, and the ticker of the first institution whose name matches it."""
    key = F.col("o_orderkey")
    company = F.concat(F.lit("<company>Co "), "o_custkey", F.lit(" of HOUSEHOLD "), key % 11, F.lit("</company><company>Other</company>"))
    xml = F.concat(F.lit("<transcript><meta><title>t</title><companies>"), F.when(key % 9 > 0, company).otherwise(""), F.lit("</companies></meta></transcript>"))
    docs = documents.parsed(read(spark, sf_dir, "orders").select("o_orderkey", xml.alias("content")))
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat_ws(" ", "c_mktsegment", F.col("c_custkey") % 7)).otherwise((F.col("c_custkey") % 50).cast("string"))
    institutions = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("T-"), "c_custkey").alias("ticker"), name.alias("name"))
    return name_match.primary_company(docs, institutions, "ticker", "name", "c_custkey").select("o_orderkey", "primary_company", "primary_ticker")
