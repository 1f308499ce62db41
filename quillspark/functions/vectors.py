"""Vector expressions over arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null for null, unequally long and zero vectors."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), dot(a, b) / F.nullif(norms, F.lit(0.0)))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine_similarity(a, b)
