"""Array arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Inner product of two equally long arrays."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(dot(vector, vector))


def softmax(logits: Column) -> Column:
    """Probabilities of stored logits, shifted by the maximum for stability (K7)."""
    shifted = F.transform(logits, lambda x: F.exp(x.cast("double") - F.array_max(logits).cast("double")))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based position of the first greatest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
