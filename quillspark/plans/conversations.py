"""Queries over conversations: grouping, gaps, runs, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import chunking, coverage, pairing
from quillspark.plans.book import Book, read
from quillspark.plans.texts import _WORDS

book = Book()
_ESTIMATE = "CASE WHEN length({0}) > 0 THEN CAST(trunc((length(array_to_string({1}, ' ')) / 3.5::DOUBLE * 0.5::DOUBLE + length({0}) / 4.0::DOUBLE * 0.3::DOUBLE + len({1}) * 1.3::DOUBLE * 0.2::DOUBLE) * 1.1::DOUBLE) AS INTEGER) ELSE 0 END"


def _estimate(c: str) -> str:
    return _ESTIMATE.format(c, _WORDS.replace("(text,", f"({c},"))


def _turns(spark, sf_dir):
    return read(spark, sf_dir, "conversations")


@book.add("""
SELECT conv_id, turn, CASE WHEN turn = min(turn) OVER w THEN 'opening' WHEN turn = max(turn) OVER w THEN 'closing' ELSE 'middle' END AS block_position FROM conversations WINDOW w AS (PARTITION BY conv_id)""")
def block_position(spark, sf_dir):
    return pairing.positions(_turns(spark, sf_dir).select("conv_id", "turn"), "conv_id", "turn")


@book.add("""
SELECT conv_id, turn, list_filter([lag(p, 2) OVER w, lag(p) OVER w], lambda x: x IS NOT NULL) AS context FROM (SELECT conv_id, turn, CASE WHEN length(text) > 30 THEN substr(text, 1, 30) || '...' ELSE text END AS p FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def prev_context(spark, sf_dir):
    return pairing.context(_turns(spark, sf_dir), "conv_id", "turn", text.preview(F.col("text"), 30)).select("conv_id", "turn", "context")


_GROUPS = "(SELECT conv_id, turn, role, CAST(greatest(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn), 1) AS INTEGER) AS g FROM conversations)"


@book.add(f"SELECT conv_id, turn, CASE WHEN role <> 'system' THEN g END AS qa_group_id FROM {_GROUPS}")
def qa_grouping_rules(spark, sf_dir):
    return pairing.by_rule(_turns(spark, sf_dir), "conv_id", "turn", F.col("role") == "user", F.col("role") != "system").select("conv_id", "turn", "qa_group_id")


@book.add("""
WITH s AS (SELECT conv_id, turn, role, turn = min(turn) OVER (PARTITION BY conv_id) AS f FROM conversations),
g AS (SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'user' OR f THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS q FROM s)
SELECT conv_id, q AS qa_group_id, min(turn) AS start_block_id, max(turn) AS end_block_id, CAST(1 AS DOUBLE) AS confidence, CASE WHEN q = max(q) OVER (PARTITION BY conv_id) THEN 'final' ELSE 'validated' END AS method FROM g GROUP BY conv_id, q""")
def qa_grouping_statemachine(spark, sf_dir):
    blocks = _turns(spark, sf_dir).select("conv_id", "turn", (F.col("role") == "user").alias("is_start"))
    return pairing.state_machine(blocks, "conv_id", "turn", pairing.asker_rule())


@book.add(f"SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN g END AS qa_group_id FROM {_GROUPS}")
def qa_assigned(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    groups = pairing.by_rule(turns, "conv_id", "turn", F.col("role") == "user").groupBy("conv_id", "qa_group_id").agg(F.min("turn").alias("start_block_id"), F.max("turn").alias("end_block_id"))
    return pairing.assigned(turns.select("conv_id", "turn", "role"), groups, "conv_id", "turn", F.col("role") == "assistant").select("conv_id", "turn", "qa_group_id")


_THINNED = f"(SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 AND turn % 3 = 0 THEN NULL ELSE g END AS g FROM {_GROUPS})"


def _thinned(spark, sf_dir):
    grouped = pairing.by_rule(_turns(spark, sf_dir), "conv_id", "turn", F.col("role") == "user")
    return grouped.select("conv_id", "turn", F.when(~((F.col("conv_id") % 5 == 0) & (F.col("turn") % 3 == 0)), F.col("qa_group_id")).alias("g"))


@book.add(f"""
SELECT conv_id, turn, position FROM (SELECT conv_id, turn, g, CASE WHEN turn = min(turn) OVER w THEN 'first' WHEN turn = max(turn) OVER w THEN 'last' ELSE 'middle' END AS position FROM {_THINNED} WINDOW w AS (PARTITION BY conv_id)) WHERE g IS NULL""")
def qa_gaps(spark, sf_dir):
    return pairing.gap_positions(_thinned(spark, sf_dir), "conv_id", "turn", "g").select("conv_id", "turn", "position")


_SHUFFLED = f"(SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN g * 2 ELSE g END AS g FROM {_THINNED})"


@book.add(f"SELECT conv_id, turn, g, previous FROM (SELECT conv_id, turn, g, lag(g) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM {_SHUFFLED} WHERE g IS NOT NULL) WHERE g <> previous AND g <> previous + 1")
def qa_order(spark, sf_dir):
    rows = _thinned(spark, sf_dir).withColumn("g", F.when(F.col("conv_id") % 4 == 0, F.col("g") * 2).otherwise(F.col("g")))
    return pairing.order_breaks(rows, "conv_id", "turn", "g").select("conv_id", "turn", "g", "previous")


@book.add(f"""
WITH m AS (SELECT *, CASE WHEN lag(turn) OVER w IS NULL OR turn <> lag(turn) OVER w + 1 OR g IS DISTINCT FROM lag(g) OVER w THEN 1 ELSE 0 END AS c FROM {_THINNED} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
i AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM m)
SELECT conv_id, g, min(turn) AS first_block, max(turn) AS last_block, count(*) AS blocks FROM i GROUP BY conv_id, island, g""")
def run_merge(spark, sf_dir):
    return pairing.runs(_thinned(spark, sf_dir), "conv_id", "turn", ["g"])


_N = f"len({_WORDS})"


@book.add(f"SELECT conv_id, CAST(sum({_N}) AS BIGINT) AS total_words, CAST(sum(CASE WHEN role = 'user' THEN {_N} ELSE 0 END) AS BIGINT) AS asked_words, CAST(max({_N}) AS INTEGER) AS longest FROM conversations GROUP BY conv_id")
def word_rollup(spark, sf_dir):
    return coverage.word_rollup(_turns(spark, sf_dir), "conv_id", "role", "text", "user")


@book.add(f"SELECT conv_id, turn, CAST({_N} AS INTEGER) AS words, round({_N} * 800.0::DOUBLE / max({_N}) OVER (), 2) AS width FROM conversations")
def bar_scale(spark, sf_dir):
    return coverage.bar_widths(_turns(spark, sf_dir), "text").select("conv_id", "turn", "words", "width")


@book.add("""
WITH b AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE turn % 4 <> 2 AND (conv_id + turn) % 7 <> 3)
SELECT conv_id, turn + 1 AS missing_block FROM b b1 WHERE NOT EXISTS (SELECT 1 FROM b b2 WHERE b2.conv_id = b1.conv_id AND b2.turn = b1.turn + 1) AND turn < (SELECT max(turn) FROM b b3 WHERE b3.conv_id = b1.conv_id)""")
def block_gap_detection(spark, sf_dir):
    return pairing.first_missing(_turns(spark, sf_dir).where("turn % 4 <> 2 AND (conv_id + turn) % 7 <> 3"), "conv_id", "turn")


@book.add("""
WITH b AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE turn % 4 <> 2 AND (conv_id + turn) % 7 <> 3), e AS (SELECT conv_id, min(turn) AS a, max(turn) AS z FROM b GROUP BY conv_id),
s AS (SELECT conv_id, unnest(range(a, z + 1)) AS turn FROM e)
SELECT conv_id, turn AS missing_block FROM s WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.conv_id = s.conv_id AND b.turn = s.turn)""")
def block_gap_all(spark, sf_dir):
    return pairing.all_missing(_turns(spark, sf_dir).where("turn % 4 <> 2 AND (conv_id + turn) % 7 <> 3"), "conv_id", "turn")


@book.add("SELECT turn, role, text FROM conversations WHERE conv_id = 7 AND role IN ('user', 'assistant') ORDER BY turn")
def section_fetch(spark, sf_dir):
    _turns(spark, sf_dir).createOrReplaceTempView("chunks")
    return spark.sql("SELECT turn, role, text FROM chunks WHERE conv_id = 7 AND role IN ('user', 'assistant') ORDER BY turn")


@book.add("SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 5)")
def first_transcripts(spark, sf_dir):
    """A limiting operator: all rows of the first five conversations."""
    return coverage.first_rows(_turns(spark, sf_dir), "conv_id", "conv_id", 5).select("conv_id", "turn")


def chunk_sql(blocks: str, head: str, glue: str, whole: int, target: int, tail: int | None) -> str:
    """The greedy chunker as a recursive query. blocks: (id, ps, head): a key, an ordered list of pieces, the header."""
    joined = lambda ps: f"rtrim(head || array_to_string({ps}, {glue}))"
    tail_ids = f"CASE WHEN last > 1 AND {_estimate('tail_text')} < {tail} THEN list_transform(ids, lambda i: least(i, last - 1)) ELSE ids END" if tail is not None else "ids"
    return f"""
WITH RECURSIVE b AS (SELECT id, list_filter(ps, lambda p: trim(p) <> '') AS ps, {head} AS head FROM ({blocks})),
s AS (SELECT *, {joined('ps')} AS whole_text FROM b WHERE len(ps) > 0),
t AS (SELECT *, {_estimate('whole_text')} AS all_tokens, {_estimate('head')} AS head_tokens FROM s),
p AS (SELECT id, i, ps[i] AS piece FROM (SELECT id, ps, unnest(range(1, len(ps) + 1)) AS i FROM t)),
k AS (SELECT id, i, {_estimate('piece')} AS n FROM p),
f(id, i, chunk, now, held) AS (
  SELECT t.id, CAST(0 AS BIGINT), 1, t.head_tokens, 0 FROM t WHERE all_tokens > {whole}
  UNION ALL
  SELECT f.id, k.i, CASE WHEN f.now + k.n > {target} AND f.held > 0 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.now + k.n > {target} AND f.held > 0 THEN t.head_tokens + k.n ELSE f.now + k.n END, CASE WHEN f.now + k.n > {target} AND f.held > 0 THEN 1 ELSE f.held + 1 END
  FROM f JOIN k ON k.id = f.id AND k.i = f.i + 1 JOIN t ON t.id = f.id),
c AS (SELECT id, list(chunk ORDER BY i) AS ids FROM f WHERE i > 0 GROUP BY id),
w AS (SELECT t.*, coalesce(ids, list_transform(ps, lambda x: 1)) AS ids FROM t LEFT JOIN c USING (id)),
l AS (SELECT *, ids[-1] AS last, {joined('list_filter(ps, lambda x, i: ids[i] = ids[-1])')} AS tail_text FROM w),
m AS (SELECT * REPLACE ({tail_ids} AS ids) FROM l),
o AS (SELECT *, unnest(range(1, ids[-1] + 1)) AS chunk_id FROM m),
r AS (SELECT id, CAST(chunk_id AS INTEGER) AS chunk_id, CAST(ids[-1] AS INTEGER) AS total_chunks, {joined('list_filter(ps, lambda x, i: ids[i] = chunk_id)')} AS chunk_content,
  CAST(list_position(ids, chunk_id) AS INTEGER) AS first_piece, CAST(list_position(ids, chunk_id) + len(list_filter(ids, lambda x: x = chunk_id)) - 1 AS INTEGER) AS last_piece, all_tokens <= {whole} AS block_level_chunk FROM o)
SELECT *, {_estimate('chunk_content')} AS chunk_tokens FROM r"""


@book.add(chunk_sql("SELECT doc_id AS id, string_split(text, chr(10)) AS ps, source FROM documents", "'[' || source || ']' || chr(10) || chr(10)", "chr(10) || chr(10)", 1000, 500, 300))
def chunk_paragraphs_md(spark, sf_dir):
    blocks = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.split("text", "\n").alias("ps"), "source")
    return chunking.chunks(blocks, ["id"], chunking.speaker_header(F.col("source")), "ps")


@book.add(chunk_sql("SELECT conv_id AS id, list('[' || role || ']' || chr(10) || text ORDER BY turn) AS ps FROM conversations GROUP BY conv_id", "'[Q&A Group ' || id || ']' || chr(10) || chr(10)", "chr(10) || chr(10)", 1000, 500, None))
def chunk_blocks_qa(spark, sf_dir):
    unit = F.struct("turn", F.concat(F.lit("["), "role", F.lit("]\n"), "text").alias("u"))
    blocks = _turns(spark, sf_dir).groupBy(F.col("conv_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(unit)), lambda x: x["u"]).alias("ps"))
    return chunking.chunks(blocks, ["id"], chunking.group_header(F.col("id")), "ps", tail=None)


@book.add()
def sentence_splitter(spark, sf_dir):
    """Sequential per text; its properties are tested: nothing is lost, parts are within their bounds."""
    return chunking.split_texts(read(spark, sf_dir, "documents"), "doc_id", "text")
