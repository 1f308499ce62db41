"""Tables clustered by several columns at once (Z-order), so that a filter on any of them reads few files and row groups.

Each column's values get ranks among boundaries taken from a sample of at most SAMPLE rows or so; the ranks' bits are
interleaved, rows are dealt by ranges of that number and sorted within. A rank holds about as many rows as any other, so a
frequent value takes several ranks of the other columns, not one file. Boundaries decide where rows lie, never which.

Defined cases: nulls rank lowest; an empty table gives an empty one; repeated rows stay; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Rows that boundaries are taken from, and bits of a rank: a column has 2 ** BITS ranks.
SAMPLE, BITS = 20_000, 6
#: Characters of a text that decide its rank.
PREFIX = 64
#: Bytes of a row group: small enough that skipping one saves something, large enough for long reads.
GROUP_BYTES = 32 << 20
_RANK = "_z_rank"


def _comparable(rows: DataFrame, name: str) -> Column:
    return F.left(F.col(name), F.lit(PREFIX)) if isinstance(rows.schema[name].dataType, StringType) else F.col(name)


def boundaries(rows: DataFrame, columns: list[str], sample: int = SAMPLE, bits: int = BITS, seed: int = 42) -> list[list]:
    """For each column 2 ** bits - 1 values that cut its sampled values into equal parts; only these reach the driver."""
    n = rows.count()
    some = rows if n <= sample else rows.sample(fraction=sample / n, seed=seed)
    held = some.agg(*(F.array_sort(F.collect_list(_comparable(rows, c))).alias(f"b{i}") for i, c in enumerate(columns)))
    steps = F.sequence(F.lit(1), F.lit(2**bits - 1))
    place = lambda name: lambda k: F.get(name, F.floor(F.size(name) * k / 2**bits).cast("int"))
    row = held.select(*(F.transform(steps, place(f"b{i}")).alias(f"b{i}") for i in range(len(columns)))).head()
    return [list(x) for x in row]


def rank(value: Column, bounds: list, kind: str, bits: int = BITS) -> Column:
    """How many of the boundaries are at or below the value: a binary search, in the engine."""
    if not bounds or bounds[0] is None:
        return F.lit(0)
    among = F.array(*(F.lit(b).cast(kind) for b in bounds))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(bits))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(value >= F.element_at(among, at + step), at + step).otherwise(at))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """One number with the ranks' bits in turn, the first column's highest."""
    many = len(ranks)
    out = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        for k in range(bits):
            out = out + F.shiftleft(F.shiftright(r, k).bitwiseAND(F.lit(1)).cast("long"), k * many + many - 1 - i)
    return out


def z_order(rows: DataFrame, columns: list[str], sample: int = SAMPLE, bits: int = BITS) -> Column:
    """The Z-order number of a row by these columns."""
    if not columns or len(columns) * bits > 62:
        raise ValueError(f"ranks of {bits} bits fit for 1 to {62 // bits} columns")
    bounds = boundaries(rows, columns, sample, bits)
    kinds = [rows.schema[c].dataType.simpleString() for c in columns]
    held = [rank(_comparable(rows, c), b, kind, bits) for c, b, kind in zip(columns, bounds, kinds, strict=True)]
    return interleaved(held, bits)


def write_clustered(rows: DataFrame, columns: list[str], path: str, files: int | None = None, bloom: tuple[str, ...] = (), group_bytes: int = GROUP_BYTES, sample: int = SAMPLE, bits: int = BITS) -> None:
    """rows as Parquet files clustered by `columns`, about `files` of them (None: Spark joins neighbouring ranges by size), with Bloom filters for the keys in `bloom` (for keys of
    many values, whose least and largest in a row group say little). One exchange, by ranges of the Z-order number."""
    name = _RANK
    while name in rows.columns:
        name += "_"
    dealt = rows.withColumn(name, z_order(rows, columns, sample, bits))
    dealt = dealt.repartitionByRange(name) if files is None else dealt.repartitionByRange(files, name)
    out = dealt.sortWithinPartitions(name, *columns).drop(name).write.option("parquet.block.size", group_bytes)
    for key in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
    out.parquet(path)


def read_clustered(rows: DataFrame, columns: list[str], path: str, files: int | None = None, **options) -> DataFrame:
    """write_clustered, and the table to filter: filters reach the scan, which skips what can't match."""
    write_clustered(rows, columns, path, files, **options)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
