"""Queries over records in general: filters of a feed, fall-backs, forced groups, nesting, checked parts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.config import Settings
from quillspark.functions import text
from quillspark.operators import archive, documents, enrichment, pairing
from quillspark.plans.book import Book, read
from quillspark.plans.conversations import _GROUPS
from quillspark.plans.texts import _IDS, KEYWORDS, NAMES
from quillspark.sources import sinks
from quillspark.tables import new_path as folder

book = Book()


@book.add("""
SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_custkey % 10 = o_custkey % 5 AS sole, o_orderkey % 3 <> 0 AND o_orderpriority LIKE '1%' AS earnings FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def feed_filter(spark, sf_dir):
    """Of the wanted kinds: whether the ticker is the only primary id, and whether it is an earnings event of one id."""
    first = F.concat(F.lit("T"), F.col("o_custkey") % 10)
    ids = F.when(F.col("o_orderkey") % 3 == 0, F.array(first, F.lit("X"))).otherwise(F.array(first))
    kind = F.when(F.col("o_orderpriority").startswith("1"), "Q1 Earnings Release").otherwise(F.col("o_orderpriority"))
    wanted = archive.of_kinds(read(spark, sf_dir, "orders"), "o_orderstatus", Settings(["T0"], kinds=["F", "P"]))
    return wanted.select("o_orderkey", archive.is_sole_id(ids, F.concat(F.lit("T"), F.col("o_custkey") % 5)).alias("sole"), archive.is_earnings(ids, kind).alias("earnings"))


@book.add("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN 'f' || c_custkey ELSE 'A-' || c_custkey || '_' || c_nationkey END AS transcript_key,
  CASE WHEN c_custkey % 4 > 1 THEN c_name WHEN c_custkey % 5 > 1 THEN 'A ' || c_custkey ELSE 'Unknown' END AS company FROM customer""")
def fallback_chains(spark, sf_dir):
    """Names of files that are empty or null, companies without a name, and without a ticker either."""
    key, ticker = F.col("c_custkey"), F.concat(F.lit("A-"), "c_custkey")
    file = F.when(key % 3 == 0, "").when(key % 3 == 2, F.concat(F.lit("f"), key))
    company = F.when(key % 4 == 0, "").when(key % 4 > 1, F.col("c_name"))
    some = F.when(key % 5 == 0, "").when(key % 5 > 1, ticker)
    return read(spark, sf_dir, "customer").select("c_custkey", text.transcript_key(file, ticker, F.col("c_nationkey")).alias("transcript_key"), text.company_or_ticker(company, some).alias("company"))


_MIXED = "CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS VARCHAR) ELSE n_name END"


@book.add(f"SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey % 2, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END, {_MIXED}) AS INTEGER) AS place FROM nation")
def mixed_order(spark, sf_dir):
    mixed = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("string")).otherwise(F.col("n_name"))
    w = Window.partitionBy("n_regionkey").orderBy(*text.mixed_order(mixed))
    return read(spark, sf_dir, "nation").select("n_nationkey", F.row_number().over(w).alias("place"))


@book.add("""
WITH b AS (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 5 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT conv_id, CAST(k + 1 AS INTEGER) AS qa_group_id, min(turn) AS start_block_id, max(turn) AS end_block_id, CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS confidence, CASE WHEN n = 1 THEN 'final' ELSE 'forced_skip_limit' END AS method FROM b GROUP BY conv_id, k, n""")
def groups_forced(spark, sf_dir):
    """A decider that always skips: windows that grow by one block are forced at the fifth skip."""
    blocks = read(spark, sf_dir, "conversations").select("conv_id", "turn")
    return pairing.state_machine(blocks, "conv_id", "turn", pairing.bounded(lambda view: 0), window=1)


@book.add("""
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS qa_group_id, turn AS start_block_id, turn AS end_block_id, 0.5::DOUBLE AS confidence, 'unvalidated' AS method FROM conversations""")
def groups_rejected(spark, sf_dir):
    """Every group of one block is rejected, and taken after the second rejection."""
    blocks = read(spark, sf_dir, "conversations").select("conv_id", "turn")
    return pairing.state_machine(blocks, "conv_id", "turn", pairing.bounded(lambda view: 1), pairing.lenient(lambda part: False))


@book.add("""
SELECT conv_id, 1 AS qa_group_id, min(turn) AS start_block_id, max(turn) AS end_block_id, 1.0::DOUBLE AS confidence, 'final' AS method FROM conversations GROUP BY conv_id""")
def groups_undecided(spark, sf_dir):
    """A decider whose answers all lie outside its window counts as one without an answer: all is one group at the end."""
    blocks = read(spark, sf_dir, "conversations").select("conv_id", "turn")
    return pairing.state_machine(blocks, "conv_id", "turn", pairing.bounded(lambda view: len(view) + 1))


@book.add(f"""
WITH g AS (SELECT conv_id, g, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS b FROM {_GROUPS} GROUP BY conv_id, g)
SELECT conv_id, string_agg(g || ':' || b, ' ' ORDER BY g) AS groups FROM g GROUP BY conv_id""")
def nested_groups(spark, sf_dir):
    grouped = pairing.by_rule(read(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user")
    line = F.array_join(F.transform("groups", lambda g: F.concat(g["qa_group_id"].cast("string"), F.lit(":"), F.array_join(g["blocks"].cast("array<string>"), ","))), " ")
    return pairing.nested(grouped, "conv_id", "qa_group_id", "turn").select("conv_id", line.alias("groups"))


@book.add(f"""
SELECT conv_id, turn, coalesce(last_value(CASE WHEN len(ids) > 0 THEN ids END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn), [0]) AS classification_ids FROM (SELECT conv_id, turn, {_IDS} AS ids FROM conversations)""")
def category_in_order(spark, sf_dir):
    """A block without a category of its own takes those of the block before it."""

    def strategy(content, before):
        own = enrichment.by_keywords(content, KEYWORDS)
        return F.when(own != F.array(F.lit(enrichment.OTHER)), own).otherwise(F.get(before, F.size(before) - 1))

    return enrichment.classify_in_order(read(spark, sf_dir, "conversations"), "conv_id", "turn", "text", strategy, list(NAMES))


_BROKEN = "(SELECT s_nationkey FROM supplier WHERE s_nationkey IN (3, 7) GROUP BY s_nationkey HAVING min(s_suppkey % 2) <> max(s_suppkey % 2))"


@book.add(f"""
SELECT s_suppkey, s_nationkey, 'sound' AS side FROM supplier WHERE s_nationkey NOT IN {_BROKEN} UNION ALL SELECT NULL, s_nationkey, 'broken' FROM {_BROKEN}""")
def parts_consolidated(spark, sf_dir):
    """Parts by key with a sidecar each; two lose rows behind its back and are found."""
    rows, path = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), folder(spark)
    sinks.replace_keys(rows, f"{path}/parts", ["s_nationkey"])
    sinks.sidecar(rows, ["s_nationkey"]).write.parquet(f"{path}/meta")
    sinks.replace_keys(rows.where("s_nationkey IN (3, 7) AND s_suppkey % 2 = 0"), f"{path}/parts", ["s_nationkey"])
    parts = spark.read.schema(rows.schema).parquet(f"{path}/parts")
    good, bad = sinks.consolidated(parts, spark.read.parquet(f"{path}/meta"), ["s_nationkey"])
    return good.select("s_suppkey", "s_nationkey", F.lit("sound").alias("side")).unionByName(bad.select(F.lit(None).cast("long").alias("s_suppkey"), "s_nationkey", F.lit("broken").alias("side")))


@book.add("""
SELECT s_suppkey, list_distinct(['s' || s_suppkey || '-us', 's' || s_suppkey, 'S' || s_suppkey || '-US', 'S' || s_suppkey, 'S' || s_suppkey || '-CA', 'S' || s_suppkey || '-GB']).list_sort().array_to_string(' ') AS variants FROM supplier""")
def ticker_variants(spark, sf_dir):
    """All spellings of a ticker, each once."""
    found = text.ticker_variants(F.concat(F.lit("s"), "s_suppkey", F.lit("-us")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(F.array_sort(found), " ").alias("variants"))


@book.add("""
SELECT c_custkey, array_to_string(list_distinct(CASE c_custkey % 3 WHEN 0 THEN ['The ' || c_mktsegment] WHEN 1 THEN [c_mktsegment || ' James', c_mktsegment, 'James'] ELSE [c_mktsegment] END).list_sort(), '|') AS terms FROM customer""")
def company_search_terms(spark, sf_dir):
    kind = F.col("c_custkey") % 3
    name = F.when(kind == 0, F.concat(F.lit("The "), "c_mktsegment", F.lit(" Group"))).when(kind == 1, F.concat("c_mktsegment", F.lit(" James PLC"))).otherwise(F.concat("c_mktsegment", F.lit(" N.V.")))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(F.array_sort(text.search_terms(name)), "|").alias("terms"))


@book.add("SELECT page_id, page_id % 5 IN (0, 1) AS is_safe FROM pages")
def share_paths(spark, sf_dir):
    """Paths on a share: with slashes at the ends, without, with an empty step, with a step up, and with a colon."""
    bare, key = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?].*$|/+$", ""), F.col("page_id") % 5
    path = F.when(key == 0, F.concat(F.lit("/"), bare, F.lit("/"))).when(key == 1, bare).when(key == 2, F.concat(F.lit("a//"), bare)).when(key == 3, F.concat(bare, F.lit("/../x"))).otherwise(F.concat(F.lit("c:/"), bare))
    return read(spark, sf_dir, "pages").select("page_id", text.is_safe_share_path(path).alias("is_safe"))


_MANIFEST = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 8 = 0 THEN 'completed' ELSE 'failed' END ELSE 'open' END AS status, CASE WHEN o_orderkey % 12 = 0 THEN o_custkey ELSE o_orderkey END AS chunks FROM orders WHERE o_orderkey % 3 <> 1 OR o_orderkey % 4 = 0"


def _manifest(spark, sf_dir):
    orders, key = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    manifest = orders.where("o_orderkey % 3 <> 1").select(key.alias("id"), F.lit("open").alias("status"), key.alias("chunks"))
    chunks = F.when((key % 12 == 0), F.col("o_custkey")).when(key % 3 == 1, key)
    updates = orders.where("o_orderkey % 4 = 0").select(key.alias("id"), F.when(key % 8 == 0, "completed").otherwise("failed").alias("status"), chunks.alias("chunks"))
    return sinks.merged_manifest(manifest, updates, "id")


@book.add(_MANIFEST)
def manifest_merged(spark, sf_dir):
    """Updates of some ids, of which some are new and some leave a field as it is."""
    return _manifest(spark, sf_dir)


@book.add(f"SELECT count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed FROM ({_MANIFEST})")
def manifest_totals(spark, sf_dir):
    return sinks.manifest_totals(_manifest(spark, sf_dir))


@book.add("""
SELECT event_type AS error_type, event_id, props, count(*) OVER (PARTITION BY event_type) AS total_errors FROM events WHERE user_id % 9 = 0""")
def error_logs(spark, sf_dir):
    """Errors by class, with their totals, from a log that has a folder for each class."""
    errors, path = read(spark, sf_dir, "events").where("user_id % 9 = 0").select("event_id", "event_type", "props"), folder(spark)
    sinks.save_error_logs(errors, "event_type", path)
    held = spark.read.schema("event_id long, event_type string, props string, error_type string").json(path)
    return sinks.error_logs(held, "error_type", "event_id", "props")


@book.add("""
SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tokens_so_far,
  CAST(sum(CASE WHEN role = 'user' THEN length(text) * 5 ELSE length(text) * 15 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cost_so_far FROM conversations""")
def run_costs(spark, sf_dir):
    """Running totals of tokens and cost of each run, here a conversation."""
    n = F.coalesce(F.length("text"), F.lit(0))
    usage = read(spark, sf_dir, "conversations").select("conv_id", "turn", n.alias("tokens"), F.when(F.col("role") == "user", n * 5).otherwise(n * 15).alias("cost"))
    return sinks.run_totals(usage, "conv_id", "turn", "tokens", "cost").select("conv_id", "turn", "tokens_so_far", "cost_so_far")


@book.add("""
SELECT o_orderkey, 'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
  CASE WHEN o_orderkey % 3 > 0 THEN 'C' || o_custkey || CASE WHEN o_orderkey % 3 = 2 THEN '|' || o_orderpriority ELSE '' END ELSE '' END AS companies, '1|' || o_orderstatus AS people FROM orders""")
def xml_headers(spark, sf_dir):
    """Title, date, companies and people of documents, some without a date or companies, and with people named twice."""
    key = F.col("o_orderkey")
    one = lambda tag, c: F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))
    companies = F.when(key % 3 > 0, F.concat(one("company", F.concat(F.lit(" C"), "o_custkey")), F.when(key % 3 == 2, one("company", F.col("o_orderpriority"))).otherwise("<company> </company>"))).otherwise("")
    day = F.when(key % 5 > 0, one("date", F.date_format("o_orderdate", "yyyy-MM-dd"))).otherwise("")
    person = lambda c: F.concat(F.lit('<participant id="'), c, F.lit('" type="x">A</participant>'))
    xml = one("transcript", one("meta", F.concat(one("title", F.concat(F.lit("Order "), key)), day, one("companies", companies), one("participants", F.concat(person(F.lit("1")), person(F.col("o_orderstatus")), person(F.lit("1")))))))
    docs = documents.parsed(read(spark, sf_dir, "orders").select("o_orderkey", xml.alias("content")))
    return documents.headers(docs, "o_orderkey").select("o_orderkey", "title", "date", F.array_join("companies", "|").alias("companies"), F.array_join("people", "|").alias("people"))
