"""Order-dependent steps that never sort one whole group, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.session import store

# Rows of one group that share a task in the window steps below.
CHUNK_ROWS = 100_000

_ROW_BITS = 33


def dense_index(
    frame: DataFrame,
    order: Sequence[str],
    name: str = "seq",
    keep: Callable[[DataFrame], DataFrame] = store,
) -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order (E8); the order must be unique.

    Range-partition on all order columns (a hot first column is split by the next), number rows
    inside partitions, store, and add the row counts of the partitions before. Only the count
    table, one row per partition, passes through a single task. ``keep`` stores the rows;
    :func:`~textlens.session.cut` starts faster for small tables.
    """
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = keep(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_at", "_part", "_start")
    )


def _chunked(frame: DataFrame, position: str, chunk_rows: int) -> DataFrame:
    return frame.withColumn("_chunk", F.floor(F.col(position) / F.lit(chunk_rows)).cast("long"))


def _beside(rows: DataFrame, carried: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` with the row of ``carried`` of the same group and chunk; a null in the group is a value like others."""
    keys = [*group, "_chunk"]
    other = carried.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_carried")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return rows.join(other, same).drop(*[f"_of_{k}" for k in keys])


def carry_forward(
    frame: DataFrame,
    group: Sequence[str],
    position: str,
    value: Column,
    name: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Last non-null ``value`` at or before each row of its group.

    ``position`` numbers the rows of a group. Each chunk of positions is filled on its own; the
    chunk table (one row per ``chunk_rows`` rows) carries values across chunk borders.
    """
    rows = _chunked(frame, position, chunk_rows).withColumn("_value", value)
    tails = rows.groupBy(*group, "_chunk").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(position))).alias("_tail")
    )
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*group, "_chunk", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("_inside", F.last("_value", ignorenulls=True).over(inside))
    return (
        _beside(filled, carried, group)
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_chunk", "_value", "_inside", "_carried")
    )


def previous_row(
    frame: DataFrame,
    group: Sequence[str],
    position: str,
    columns: Sequence[str],
    name: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Struct of ``columns`` of the row before, within the group; null for the first row.

    Same two-level scheme as :func:`carry_forward`; positions may have gaps.
    """
    rows = _chunked(frame, position, chunk_rows).withColumn("_row", F.struct(*columns))
    ends = rows.groupBy(*group, "_chunk").agg(F.max_by("_row", position).alias("_end"))
    by_chunk = Window.partitionBy(*group).orderBy("_chunk")
    carried = ends.select(*group, "_chunk", F.lag("_end").over(by_chunk).alias("_carried"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(position)
    lagged = rows.withColumn("_inside", F.lag("_row").over(inside))
    return (
        _beside(lagged, carried, group)
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_chunk", "_row", "_inside", "_carried")
    )
