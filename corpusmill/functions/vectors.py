"""Expressions over array<float> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector is null, 0 or has a null, or their lengths differ."""
    n = norm(a) * norm(b)
    return F.when(n > 0, F.coalesce(dot(a, b) / n, F.lit(0.0))).otherwise(0.0)


def unit(a: Column) -> Column:
    """The vector at length 1, as doubles; 0 stays 0."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0))
