"""Queries through the table functions, as SQL calls them, and over clustered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import clustering, pairing, table_functions
from quillspark.plans.book import Book, read
from quillspark.plans.conversations import chunk_sql
from quillspark.tables import new_path

book = Book()


def _views(spark, sf_dir, *names: str) -> None:
    for name in names:
        read(spark, sf_dir, name).createOrReplaceTempView(f"tf_{name}")


@book.add()
def table_split(spark, sf_dir):
    """The splitter as a table function; tested to equal the splitter's own rows."""
    _views(spark, sf_dir, "documents")
    table_functions.register(spark)
    return spark.sql("SELECT * FROM split_parts(TABLE(SELECT doc_id, text FROM tf_documents), 'doc_id', 'text', 500, 300)")


@book.add("SELECT id AS doc_id, chunk_id, chunk_content, first_piece, last_piece, chunk_tokens FROM (" + chunk_sql("SELECT doc_id AS id, string_split(text, chr(10)) AS ps, source FROM documents", "'[' || source || ']' || chr(10) || chr(10)", "chr(10) || chr(10)", -1, 500, 300) + ")")
def table_chunks(spark, sf_dir):
    """The chunker over ordered rows of pieces: one chunk and the one before are held, never a document."""
    _views(spark, sf_dir, "documents")
    table_functions.register(spark)
    pieces = "SELECT doc_id, concat('[', source, ']\\n\\n') AS head, posexplode(split(text, '\\n')) AS (at, piece) FROM tf_documents"
    return spark.sql(f"SELECT * FROM chunk_pieces(TABLE({pieces}), 'doc_id', 'at', 'piece', 'head', 500, 300)")


@book.add("""
WITH s AS (SELECT conv_id, turn, role = 'user' OR turn = min(turn) OVER (PARTITION BY conv_id) AS b FROM conversations),
g AS (SELECT conv_id, turn, CAST(sum(CAST(b AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS q FROM s)
SELECT conv_id, q AS qa_group_id, min(turn) AS start_block_id, max(turn) AS end_block_id, CAST(1 AS DOUBLE) AS confidence, CASE WHEN q = max(q) OVER (PARTITION BY conv_id) THEN 'final' ELSE 'validated' END AS method FROM g GROUP BY conv_id, q""")
def table_groups(spark, sf_dir):
    """The decider by rule over ordered rows (no stretch without a question has fifty blocks here)."""
    _views(spark, sf_dir, "conversations")
    table_functions.register(spark)
    return spark.sql("SELECT * FROM block_groups(TABLE(SELECT conv_id, turn, role = 'user' AS is_start FROM tf_conversations), 'conv_id', 'turn')")


def _undecided(view: list[dict]) -> None:
    return None


@book.add("""
WITH b AS (SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 50 AS k FROM events)
SELECT event_type, CAST(k + 1 AS INTEGER) AS qa_group_id, min(event_id) AS start_block_id, max(event_id) AS end_block_id, CASE WHEN count(*) = 50 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS confidence, CASE WHEN count(*) = 50 THEN 'memory_limit' ELSE 'final' END AS method FROM b GROUP BY event_type, k""")
def table_groups_undecided(spark, sf_dir):
    """Without any decision the window is forced whenever it holds fifty blocks: a few keys with very many blocks each."""
    _views(spark, sf_dir, "events")
    table_functions.register(spark, pairing.bounded(_undecided))
    return spark.sql("SELECT * FROM block_groups(TABLE(SELECT event_type, event_id FROM tf_events), 'event_type', 'event_id')")


@book.add("""
WITH RECURSIVE n AS (SELECT conv_id, turn, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS p, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
r(conv_id, i, turn, block_summary, a, b) AS (
  SELECT conv_id, i, turn, p || ' []', CASE WHEN p IS NOT NULL THEN length(p) + 3 END, CAST(NULL AS BIGINT) FROM n WHERE i = 1
  UNION ALL
  SELECT conv_id, i, turn, s, CASE WHEN s IS NULL THEN a ELSE length(s) END, CASE WHEN s IS NULL THEN b ELSE a END
  FROM (SELECT n.conv_id, n.i, n.turn, r.a, r.b, n.p || ' [' || concat_ws(',', r.b, r.a) || ']' AS s FROM r JOIN n ON n.conv_id = r.conv_id AND n.i = r.i + 1))
SELECT conv_id, turn, block_summary FROM r""")
def table_summaries(spark, sf_dir):
    """Each summary depends on the two before it, which depend on theirs."""
    _views(spark, sf_dir, "conversations")
    table_functions.register(spark)
    return spark.sql("SELECT * FROM summaries_in_order(TABLE(SELECT conv_id, turn, text FROM tf_conversations), 'conv_id', 'turn', 'text')")


@book.add("""
SELECT 'family' AS wanted, l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey = 7
UNION ALL SELECT 'period', l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 11
UNION ALL SELECT 'both', l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (3, 5) AND l_quantity < 4
UNION ALL SELECT 'key', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey = 33""")
def clustered_lookup(spark, sf_dir):
    """A table clustered by three columns, with a Bloom filter for a key that is none of them: filters on one, two, none."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_partkey", "l_orderkey", "l_linenumber")
    held = clustering.read_clustered(lines, ["l_suppkey", "l_quantity", "l_partkey"], new_path(spark, "clustered"), bloom=("l_orderkey",))
    wanted = {"family": "l_suppkey = 7", "period": "l_quantity BETWEEN 10 AND 11", "both": "l_suppkey IN (3, 5) AND l_quantity < 4", "key": "l_orderkey = 33"}
    parts = [held.where(condition).select(F.lit(name).alias("wanted"), "l_orderkey", "l_linenumber") for name, condition in wanted.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])
