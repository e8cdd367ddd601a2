"""Joins whose broadcast side is measured first, and top-k per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.session import cut_counted

# A stored side with at most this many rows, and at most this many bytes of data, is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

# Beyond it, a key of the large side is spread over this many join partitions.
SALTS = 16


def measured_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    limit_rows: int = BROADCAST_ROWS,
    rows: int | None = None,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``large`` with a side that is expected, but not known, to be small.

    ``small`` is stored and counted, unless it is stored already and the caller counted its
    ``rows``. Within ``limit_rows`` rows and ``limit_bytes`` bytes (the length of its rows
    written as JSON, measured on the stored rows) it is broadcast; beyond, both sides
    shuffle on the keys and a salt, so one hot key of ``large`` is worked on by many tasks.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``: each row of ``large`` meets
    exactly one copy of its partners, so all four stay exact.
    """
    stored, rows = cut_counted(small) if rows is None else (small, rows)
    if rows <= limit_rows and stored_bytes(stored) <= limit_bytes:
        return large.join(F.broadcast(stored), list(keys), how)
    return salted_join(large, stored, keys, how)


def stored_bytes(stored: DataFrame) -> int:
    """Bytes of a stored table's rows, as the length of each row written as JSON: one pass over the stored rows."""
    size = stored.agg(F.sum(F.octet_length(F.to_json(F.struct(*stored.columns)))).alias("b")).first()["b"]
    return int(size or 0)


def salted_join(
    large: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffle join on keys and salt; the salt is a hash of the row, so a retried task repeats it."""
    hashable = [f.name for f in large.schema.fields if f.dataType.typeName() != "map"]
    left = large.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def top_per_key(
    frame: DataFrame, key: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows per key, numbered from 0 (Q9).

    Spark keeps only ``k`` rows per key in each task before the shuffle (WindowGroupLimit), so
    the exchange is bounded by tasks x keys x k however many rows a key has.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    numbered = frame.withColumn("_number", F.row_number().over(window)).where(F.col("_number") <= k)
    return numbered.withColumn(name, F.col("_number") - 1).drop("_number")
