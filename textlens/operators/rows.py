"""Array elements to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(frame: DataFrame, array: Column | str, name: str, position: str | None = None) -> DataFrame:
    """One row per non-null element of ``array`` beside the columns of ``frame``.

    The outer form with a filter on the element is used on purpose: for the inner form the
    optimizer adds a filter on the array's size, which computes the array a second time, and
    below an exchange in a task per file instead of a task per shuffle partition.
    """
    array = F.col(array) if isinstance(array, str) else array
    if position is None:
        rows = frame.select("*", F.explode_outer(array).alias(name))
    else:
        rows = frame.select("*", F.posexplode_outer(array).alias(position, name))
    return rows.where(F.col(name).isNotNull())
