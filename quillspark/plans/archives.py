"""Queries over versioned archives; orders stand for versions of customers' documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import archive, documents
from quillspark.operators.calendar import small
from quillspark.plans.book import Book, read

book = Book()
RANKS = {"F": 4, "P": 3, "O": 2}
VERSIONS_SQL = "(SELECT o_custkey AS family, o_orderkey AS version, CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'P' THEN 3 WHEN 'O' THEN 2 ELSE 0 END AS rank, CAST(o_orderdate AS VARCHAR) AS changed, 'v' || o_orderkey || '.xml' AS name, o_orderkey AS ordinal, o_orderstatus, o_orderpriority FROM orders)"
BEST_SQL = "row_number() OVER (PARTITION BY family ORDER BY rank DESC, version DESC, changed DESC, ordinal)"


def versions(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    changed = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return orders.select(F.col("o_custkey").alias("family"), F.col("o_orderkey").alias("version"), archive.kind_rank(F.col("o_orderstatus"), RANKS).alias("rank"), changed.alias("changed"), F.concat(F.lit("v"), "o_orderkey", F.lit(".xml")).alias("name"), F.col("o_orderkey").alias("ordinal"), "o_orderstatus", "o_orderpriority")


ORDER = ("rank", "version", "changed", "ordinal")


@book.add(f"SELECT family, name, rank FROM (SELECT *, {BEST_SQL} AS nth FROM {VERSIONS_SQL}) WHERE nth = 1")
def best_version(spark, sf_dir):
    return archive.best(versions(spark, sf_dir), "family", archive.current_order(*ORDER)).select("family", "name", "rank")


@book.add(f"SELECT family, name, rank FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY version * 10 + rank DESC, changed DESC, ordinal) AS nth FROM {VERSIONS_SQL}) WHERE nth = 1")
def best_version_legacy(spark, sf_dir):
    return archive.best(versions(spark, sf_dir), "family", archive.legacy_order(*ORDER)).select("family", "name", "rank")


@book.add("SELECT versions, count(*) AS families FROM (SELECT o_custkey, count(*) AS versions FROM orders GROUP BY o_custkey) GROUP BY versions")
def version_histogram(spark, sf_dir):
    return documents.version_histogram(read(spark, sf_dir, "orders"), "o_custkey")


# archive: all but every fifth order; master: all but every seventh, some of them changed since
_SIDES = f"""
WITH v AS (SELECT * FROM {VERSIONS_SQL}),
a AS (SELECT * FROM v WHERE version % 5 <> 0 AND family % 11 <> 0),
m AS (SELECT family, version, rank, CASE WHEN version % 13 = 0 THEN 'old' ELSE changed END AS changed, name, ordinal FROM v WHERE version % 7 <> 0 AND family % 13 <> 0),
ba AS (SELECT family, name, changed FROM (SELECT *, {BEST_SQL} AS nth FROM a) WHERE nth = 1),
bm AS (SELECT family, name, changed FROM (SELECT *, {BEST_SQL} AS nth FROM m) WHERE nth = 1),
t AS (SELECT coalesce(ba.family, bm.family) AS family, ba.name AS a_name, bm.name AS m_name FROM ba FULL JOIN bm ON ba.family = bm.family WHERE ba.name IS NULL OR bm.name IS NULL OR ba.name <> bm.name OR ba.changed <> bm.changed)
"""


def _sides(spark, sf_dir):
    v = versions(spark, sf_dir)
    master = v.where("version % 7 <> 0 AND family % 13 <> 0").withColumn("changed", F.when(F.col("version") % 13 == 0, "old").otherwise(F.col("changed")))
    return v.where("version % 5 <> 0 AND family % 11 <> 0"), master


@book.add(_SIDES + "SELECT 'process' AS action, family, a_name AS name FROM t WHERE a_name IS NOT NULL UNION ALL SELECT 'remove', family, m.name FROM m WHERE family IN (SELECT family FROM t WHERE m_name IS NOT NULL)")
def delta_full_outer(spark, sf_dir):
    process, remove = archive.difference(*_sides(spark, sf_dir), "family", "name", "changed", archive.current_order(*ORDER))
    tag = lambda d, a: d.select(F.lit(a).alias("action"), "family", "name")
    return tag(process, "process").unionByName(tag(remove, "remove"))


@book.add(_SIDES + "SELECT coalesce(a.name, m.name) AS name, CASE WHEN m.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'deleted' ELSE 'modified' END AS status FROM a FULL JOIN m ON a.name = m.name WHERE a.name IS NULL OR m.name IS NULL OR a.changed <> m.changed")
def delta_legacy(spark, sf_dir):
    return archive.difference_by_name(*_sides(spark, sf_dir), "name", "changed")


@book.add("""
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS event_id, o_orderstatus AS kind, 'T' || o_custkey % 10 AS ticker, CAST(o_orderkey AS VARCHAR) AS version_id, o_orderkey AS ordinal FROM orders WHERE o_orderkey % 3 = 0),
i AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS event_id, ' ' || o_orderkey || ' ' AS version_id FROM orders WHERE o_orderpriority LIKE '1%'),
a AS (SELECT CAST(o_custkey AS VARCHAR) AS event_id, o_orderstatus AS kind, 'T' || o_custkey % 10 AS ticker, CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey ELSE o_orderkey + 1 END AS VARCHAR) AS version_id, o_orderkey AS ordinal FROM orders WHERE o_orderkey % 2 = 0),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, kind, ticker ORDER BY ordinal) AS nth FROM a) WHERE nth = 1)
SELECT f.event_id, f.kind, f.ticker, f.version_id,
  CASE WHEN f.event_id NOT IN (SELECT event_id FROM a) THEN 'new_event' WHEN g.version_id IS NULL THEN 'new_kind' WHEN g.version_id <> f.version_id THEN 'version_update' ELSE 'unchanged' END AS status,
  CASE WHEN g.version_id <> f.version_id THEN g.version_id END AS replaces
FROM f LEFT JOIN g ON f.event_id = g.event_id AND f.kind = g.kind AND f.ticker = g.ticker
WHERE NOT EXISTS (SELECT 1 FROM i WHERE trim(i.event_id) = trim(f.event_id) AND trim(i.version_id) = trim(f.version_id))""")
def delta_api_archive(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    row = lambda d, version: d.select(F.col("o_custkey").cast("string").alias("event_id"), F.col("o_orderstatus").alias("kind"), F.concat(F.lit("T"), F.col("o_custkey") % 10).alias("ticker"), version.cast("string").alias("version_id"), F.col("o_orderkey").alias("ordinal"))
    found = row(orders.where("o_orderkey % 3 = 0"), F.col("o_orderkey")).drop("ordinal")
    have = row(orders.where("o_orderkey % 2 = 0"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey")).otherwise(F.col("o_orderkey") + 1))
    ignored = orders.where("o_orderpriority LIKE '1%'").select(F.col("o_custkey").cast("string").alias("event_id"), F.concat(F.lit(" "), "o_orderkey", F.lit(" ")).alias("version_id"))
    return archive.sync_status(archive.without_ignored(found, ignored, ["event_id", "version_id"]), have, "ordinal")


@book.add(f"""
WITH v AS (SELECT name, changed, version FROM {VERSIONS_SQL})
SELECT name, changed FROM v WHERE version % 3 = 0 AND version % 4 <> 0 UNION ALL SELECT name, changed FROM v WHERE version % 3 = 1""")
def master_merge(spark, sf_dir):
    v = versions(spark, sf_dir).select("name", "changed", "version")
    removed = v.where("version % 4 = 0").select(F.concat(F.lit("Data/2024/Q1/"), "name").alias("path"))
    return archive.merged(v.where("version % 3 = 0").drop("version"), removed, v.where("version % 3 = 1").drop("version"), "name")


@book.add(f"SELECT name, max(changed) AS changed FROM (SELECT 'n' || family % 50 AS name, changed FROM {VERSIONS_SQL}) GROUP BY name")
def latest_change(spark, sf_dir):
    return archive.latest_change(versions(spark, sf_dir).select(F.concat(F.lit("n"), F.col("family") % 50).alias("name"), "changed"), "name", "changed")


@book.add("""
WITH s AS (SELECT l_orderkey, list(DISTINCT l_suppkey) AS ids FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, ids[1] AS s_suppkey FROM s WHERE len(ids) = 1 AND ids[1] IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def sole_membership(spark, sf_dir):
    ids = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("ids"))
    return archive.sole_member(ids, "ids", read(spark, sf_dir, "supplier").where("s_acctbal > 0"), "s_suppkey").select("l_orderkey", "s_suppkey")


@book.add("SELECT c_custkey, c_nationkey, CASE WHEN n_nationkey IS NULL THEN 'new' ELSE 'monitored' END AS status FROM customer LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2) ON c_nationkey = n_nationkey")
def monitored_or_new(spark, sf_dir):
    known = read(spark, sf_dir, "nation").where("n_regionkey < 2").select("n_nationkey")
    return read(spark, sf_dir, "customer").join(small(known), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_nationkey", F.when(F.col("n_nationkey").isNull(), "new").otherwise("monitored").alias("status"))


@book.add("""
SELECT o_orderkey, CASE WHEN status IN ('completed') AND verified OR status = 'failed' THEN 'skip' ELSE 'run' END AS action FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed' ELSE 'in_progress' END AS status, o_orderkey % 2 = 0 AS verified FROM orders)""")
def resume_actions(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("in_progress")
    done = orders.select("o_orderkey", status.alias("status"), (F.col("o_orderkey") % 2 == 0).alias("verified"))
    return archive.resume(orders.select("o_orderkey"), done, "o_orderkey")


@book.add("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus")
def status_totals(spark, sf_dir):
    from quillspark.sources import sinks

    return sinks.status_totals(read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"))


_TITLES = """(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Q' || quarter(o_orderdate) || ' ' || (year(o_orderdate) + 10) || ' Earnings Call' WHEN 1 THEN 'q' || quarter(o_orderdate) || '  ' || (year(o_orderdate) + 10) || ' earnings call, revised'
  WHEN 2 THEN CASE quarter(o_orderdate) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END || ' Quarter ' || (year(o_orderdate) + 10) WHEN 3 THEN quarter(o_orderdate) || 'Q' || substr(CAST((year(o_orderdate) + 10) AS VARCHAR), 3, 2) || ' results' ELSE 'Annual meeting' END AS title, quarter(o_orderdate) AS q, (year(o_orderdate) + 10) AS y FROM orders)"""


@book.add(f"""
SELECT o_orderkey, title, regexp_matches(title, '^(?i)Q([1-4])\\s+(20\\d{{2}})\\s+Earnings\\s+Call$') AS is_call,
  CASE WHEN o_orderkey % 5 = 4 THEN 'Unknown' ELSE 'Q' || q END AS quarter, CASE WHEN o_orderkey % 5 = 4 THEN 'Unknown' ELSE CAST(y AS VARCHAR) END AS year,
  CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'Q' || q ELSE 'Unknown' END AS plain_quarter
FROM {_TITLES}""")
def title_parse(spark, sf_dir):
    q, y, n = F.quarter("o_orderdate"), F.year("o_orderdate") + 10, F.col("o_orderkey") % 5
    word = F.element_at(F.array(*(F.lit(w) for w in text.SPELT)), q)
    title = (
        F.when(n == 0, F.concat(F.lit("Q"), q, F.lit(" "), y, F.lit(" Earnings Call"))).when(n == 1, F.concat(F.lit("q"), q, F.lit("  "), y, F.lit(" earnings call, revised")))
        .when(n == 2, F.concat(word, F.lit(" Quarter "), y)).when(n == 3, F.concat(q, F.lit("Q"), F.substring(y.cast("string"), 3, 2), F.lit(" results"))).otherwise("Annual meeting")
    )
    rows = read(spark, sf_dir, "orders").select("o_orderkey", title.alias("title"))
    quarter, year = text.title_period(F.col("title"))
    return rows.select("o_orderkey", "title", text.title_is_call(F.col("title")).alias("is_call"), quarter.alias("quarter"), year.alias("year"), text.title_period(F.col("title"), False)[0].alias("plain_quarter"))


@book.add("""
SELECT o_orderkey, 'T' || o_custkey AS ticker, 'Q' || quarter(o_orderdate) AS quarter, o_orderstatus AS kind, o_orderkey AS version, 'T' || o_custkey || '_Q' || quarter(o_orderdate) || '_' || year(o_orderdate) AS family,
  CAST(year(o_orderdate) AS VARCHAR) AS path_year FROM orders WHERE o_orderkey % 9 <> 0""")
def name_parts(spark, sf_dir):
    cut = F.when(F.col("o_orderkey") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), "o_orderkey"))
    name = F.concat(F.lit("Data/"), F.year("o_orderdate"), F.lit("/Q"), F.quarter("o_orderdate"), F.lit("/Raw/Some_Co/T"), "o_custkey", F.lit("_Q"), F.quarter("o_orderdate"), F.lit("_"), F.year("o_orderdate"), F.lit("_"), "o_orderstatus", F.lit("_e"), "o_custkey", cut, F.lit(".xml"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", archive.named_parts(name).alias("p"), archive.path_parts(name).alias("d")).where("p IS NOT NULL")
    return rows.select("o_orderkey", "p.ticker", "p.quarter", "p.kind", archive.version_number(F.col("p.version_id")).alias("version"), "p.family", F.col("d.year").alias("path_year"))


@book.add("""
SELECT page_id, split_part(url, '/', -1) AS base, len(string_split(url, '/')) AS steps, coalesce(NOT contains(u, '..') AND NOT starts_with(u, '/') AND NOT regexp_matches(u, '[<>:"|?*]') AND length(u) <= 260, false) AS is_safe, false AS whole_is_safe,
  regexp_replace(regexp_replace(url, '//[^/@]*@', '//***@', 'g'), '\\?.*$', '?***') AS redacted FROM (SELECT *, CASE page_id % 4 WHEN 0 THEN '/' WHEN 1 THEN '../' ELSE '' END || regexp_replace(url, '^[a-z]+://', '') AS u FROM pages)""")
def path_decompose(spark, sf_dir):
    """Paths: the address without its scheme, some made absolute, some leading upwards; the whole address is none, for its colon."""
    url = F.col("url")
    lead = F.when(F.col("page_id") % 4 == 0, "/").when(F.col("page_id") % 4 == 1, "../").otherwise("")
    path = F.concat(lead, F.regexp_replace(url, "^[a-z]+://", ""))
    return read(spark, sf_dir, "pages").select("page_id", text.basename(url).alias("base"), F.size(F.split(url, "/")).cast("long").alias("steps"), text.is_safe_path(path).alias("is_safe"), text.is_safe_path(url).alias("whole_is_safe"), text.redacted_url(url).alias("redacted"))


@book.add("""
SELECT s_suppkey, replace(replace(replace(s_name || ' Group, Inc.', ' ', '_'), '.', ''), ',', '') AS path_safe, s_name || ' Holding' AS bare,
  list_distinct(['s' || s_suppkey || '-us']) AS first_variant, CASE s_nationkey % 3 WHEN 0 THEN 'Zero' WHEN 1 THEN 'One' ELSE 'kind two' END AS label FROM supplier""")
def names_and_labels(spark, sf_dir):
    name = F.concat("s_name", F.lit(" Group, Inc."))
    kind = F.concat(F.lit("kind_"), F.element_at(F.array(F.lit("zero"), F.lit("one"), F.lit("two")), (F.col("s_nationkey") % 3 + 1).cast("int")))
    variants = text.ticker_variants(F.concat(F.lit("s"), "s_suppkey", F.lit("-us")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", text.path_safe(name).alias("path_safe"), text.bare_company(F.concat("s_name", F.lit(" Holding Group Ltd."))).alias("bare"), F.slice(variants, 1, 1).alias("first_variant"), text.display_label(kind, {"kind_zero": "Zero", "kind_one": "One"}).alias("label"))


@book.add("""
SELECT p_partkey, type_word FROM (SELECT p_partkey, w AS type_word, row_number() OVER (PARTITION BY p_partkey ORDER BY o) AS nth FROM part JOIN (VALUES (1, 'MED'), (2, 'promo'), (3, 'Standard edition')) t(o, w) ON contains(lower(p_type), lower(w)) OR contains(lower(w), lower(p_type))) WHERE nth = 1""")
def fuzzy_name_match(spark, sf_dir):
    """A few names against all rows: folded into one expression, first hit wins, so that no join is needed."""
    low = F.lower("p_type")
    hit = F.coalesce(*(F.when(low.contains(w.lower()) | F.lit(w.lower()).contains(low), w) for w in ("MED", "promo", "Standard edition")))
    return read(spark, sf_dir, "part").select("p_partkey", hit.alias("type_word")).where("type_word IS NOT NULL")
