"""Table functions for SQL: splitter, chunker, decider of groups, and summaries that see the summaries before.

    SELECT * FROM split_parts(TABLE(docs), 'doc_id', 'text', 500, 300)
    SELECT * FROM chunk_pieces(TABLE(pieces), 'doc_id', 'at', 'piece', 'head', 500, 300)
    SELECT * FROM block_groups(TABLE(blocks), 'conv_id', 'turn')
    SELECT * FROM summaries_in_order(TABLE(blocks), 'conv_id', 'turn', 'text')

The ordered ones ask for their own partitioning and order in `analyze`, so a call can't forget them: rows are dealt by
key, sorted by Spark (which spills), and come to a key's state one after another. The state is one chunk and the one
before, one window of at most MOST_BLOCKS blocks and a step, or the last few summaries; no key is held, however long.
Rows of a null key are a key of their own; rows of equal order come in any order; an empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from quillspark.operators import chunking, pairing

#: strategy(text, the summaries before, oldest first) -> summary or None.
Summariser = Callable[[str, list[str]], str | None]


def _column(rows: AnalyzeArgument, name: AnalyzeArgument) -> StructField:
    """The column of the table argument that a constant names."""
    if not (rows.isTable and name.isConstantExpression and name.value in rows.dataType.names):
        raise ValueError(f"give a table and the names of its columns; found {name.value!r}")
    return rows.dataType[name.value]


def _schema(key: StructField, **kinds: DataType) -> StructType:
    return StructType([StructField(key.name, key.dataType), *(StructField(name, kind) for name, kind in kinds.items())])


def _ordered(schema: StructType, key: str, order: str) -> AnalyzeResult:
    quoted = lambda name: f"`{name.replace('`', '``')}`"
    return AnalyzeResult(schema, partitionBy=[PartitioningColumn(quoted(key))], orderBy=[OrderingColumn(quoted(order))])


class SplitParts:
    """(key, part, part_text, part_tokens) by chunking.split_text; no parts for null and blank texts."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, content: AnalyzeArgument, most: AnalyzeArgument, least: AnalyzeArgument) -> AnalyzeResult:
        _column(rows, content)
        return AnalyzeResult(_schema(_column(rows, key), part=IntegerType(), part_text=StringType(), part_tokens=IntegerType()))

    def eval(self, row, key: str, content: str, most: int, least: int) -> Iterator[tuple]:
        for k, (part, tokens) in enumerate(chunking.split_text(row[content] or "", most, least), 1):
            yield row[key], k, part, tokens


@dataclass
class _Chunk:
    number: int
    first: int
    pieces: list[str]


class ChunkPieces:
    """(key, chunk_id, chunk_content, first_piece, last_piece, chunk_tokens): ordered pieces of a key, joined to chunks of
    about `target` tokens under the key's header (a column; null: none). Blank and null pieces are dropped and not
    numbered; a last chunk below `tail` tokens joins the one before (0: never)."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, piece: AnalyzeArgument, head: AnalyzeArgument, target: AnalyzeArgument, tail: AnalyzeArgument) -> AnalyzeResult:
        for name in (order, piece, head):
            _column(rows, name)
        schema = _schema(_column(rows, key), chunk_id=IntegerType(), chunk_content=StringType(), first_piece=IntegerType(), last_piece=IntegerType(), chunk_tokens=IntegerType())
        return _ordered(schema, key.value, order.value)

    def __init__(self):
        self.now: _Chunk | None = None
        self.before: _Chunk | None = None
        self.tokens = self.seen = self.tail = 0
        self.head, self.of = "", None

    def _content(self, pieces: list[str]) -> str:
        return (self.head + "\n\n".join(pieces)).rstrip(" ")

    def _row(self, chunk: _Chunk) -> tuple:
        content = self._content(chunk.pieces)
        return self.of, chunk.number, content, chunk.first, chunk.first + len(chunk.pieces) - 1, chunking.estimate(content)

    def eval(self, row, key: str, order: str, piece: str, head: str, target: int, tail: int) -> Iterator[tuple]:
        if not (row[piece] or "").strip(" "):
            return
        if self.now is None:
            self.of, self.head, self.tail = row[key], row[head] or "", tail
            self.now, self.tokens = _Chunk(1, 1, []), chunking.estimate(self.head)
        self.seen += 1
        size = chunking.estimate(row[piece])
        if self.now.pieces and self.tokens + size > target:
            if self.before is not None:
                yield self._row(self.before)
            self.before, self.now = self.now, _Chunk(self.now.number + 1, self.seen, [])
            self.tokens = chunking.estimate(self.head)
        self.now.pieces.append(row[piece])
        self.tokens += size

    def terminate(self) -> Iterator[tuple]:
        if self.now is None:
            return
        if self.before is not None and chunking.estimate(self._content(self.now.pieces)) < self.tail:
            self.before.pieces += self.now.pieces
            yield self._row(self.before)
            return
        if self.before is not None:
            yield self._row(self.before)
        yield self._row(self.now)


def block_groups(decide: pairing.Decider, validate: pairing.Validator = lambda _: True, window: int = 10) -> type:
    """The decider of groups as a table function: (key, qa_group_id, start_block_id, end_block_id, confidence, method)."""

    class BlockGroups:
        @staticmethod
        def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, block: AnalyzeArgument) -> AnalyzeResult:
            kind = _column(rows, block).dataType
            schema = _schema(_column(rows, key), qa_group_id=IntegerType(), start_block_id=kind, end_block_id=kind, confidence=DoubleType(), method=StringType())
            return _ordered(schema, key.value, block.value)

        def __init__(self):
            self.groups, self.of = None, None

        def eval(self, row, key: str, block: str) -> Iterator[tuple]:
            if self.groups is None:
                self.groups, self.of = pairing.Grouper(decide, validate, window, block), row[key]
            for g in self.groups.feed(row.asDict()):
                yield self.of, g.qa_group_id, g.start_block_id, g.end_block_id, g.confidence, g.method

        def terminate(self) -> Iterator[tuple]:
            for g in self.groups.finish() if self.groups is not None else ():
                yield self.of, g.qa_group_id, g.start_block_id, g.end_block_id, g.confidence, g.method

    return BlockGroups


def summaries_in_order(strategy: Summariser, context: int = 2) -> type:
    """(key, order, block_summary): each text's summary is made in sight of the `context` summaries before it. A null text,
    and one that the strategy fails on, has a null summary, which is no context."""

    class SummariesInOrder:
        @staticmethod
        def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, content: AnalyzeArgument) -> AnalyzeResult:
            _column(rows, content)
            place = _column(rows, order)
            return _ordered(_schema(_column(rows, key), **{place.name: place.dataType}, block_summary=StringType()), key.value, order.value)

        def __init__(self):
            self.before = deque(maxlen=context)

        def eval(self, row, key: str, order: str, content: str) -> Iterator[tuple]:
            found = None
            if row[content] is not None:
                try:
                    found = strategy(row[content], list(self.before))
                except pairing.FAILURES:
                    found = None
            if found is not None:
                self.before.append(found)
            yield row[key], row[order], found

    return SummariesInOrder


def template_in_context(content: str, before: list[str], most: int = 100) -> str:
    """A strategy without a model: a preview, and the lengths of the summaries that it was made in sight of."""
    preview = content[:most] + "..." if len(content) > most else content
    return f"{preview} [{','.join(str(len(x)) for x in before)}]"


def register(spark: SparkSession, decide: pairing.Decider | None = None, validate: pairing.Validator = lambda _: True, window: int = 10, strategy: Summariser = template_in_context) -> None:
    """Makes the four functions callable in SQL, with the decider (by default: a group ends before a block whose column
    is_start is true) and the strategy of summaries given here."""
    functions = {
        "split_parts": SplitParts,
        "chunk_pieces": ChunkPieces,
        "block_groups": block_groups(decide or pairing.asker_rule(), validate, window),
        "summaries_in_order": summaries_in_order(strategy),
    }
    for name, made in functions.items():
        # rows come singly, and an Arrow batch for each row's result costs several times what pickled rows cost
        spark.udtf.register(name, F.udtf(made, useArrow=False))
