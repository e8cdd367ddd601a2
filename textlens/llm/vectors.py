"""Blocks of vectors, and the meeting of query blocks with candidate blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.session import scratch_path

# Ranks of candidate blocks whose longest vector the driver looks at.
LENGTH_STEPS = 1_000


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def doubles(rows: DataFrame, key: str, vector: str, queries: Column, each: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """``(key long, vec array<double>, length double, query boolean)`` of the usable rows that have a key."""
    vec = F.transform(F.col(vector), lambda x: each(x.cast("double")))
    taken = rows.where(F.col(key).isNotNull() & usable(F.col(vector)))
    taken = taken.select(F.col(key).cast("long").alias("key"), vec.alias("vec"), F.coalesce(queries, F.lit(False)).alias("query"))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return taken.withColumn("length", length)


def _pack(dims: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        keys, matrices, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, matrix = np.concatenate(keys), np.concatenate(matrices)
            number += 1
            longest = float(np.sqrt((matrix**2).sum(1)).max(initial=0.0))
            row = [pa.array([part * (1 << 32) + number - 1]), pa.array([longest]), pa.array([ids.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays([*row, pa.array([matrix.tobytes()], pa.binary())], ["block", "longest", "keys", "cells"])

        for batch in batches:
            lists = batch.column(1)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            counts = np.diff(ends)
            matrix = np.zeros((batch.num_rows, dims))
            rows = np.repeat(np.arange(batch.num_rows), counts)
            matrix[rows, np.arange(len(rows)) - np.repeat(ends[:-1] - ends[0], counts)] = values[ends[0] : ends[-1]]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for begin in range(0, batch.num_rows, size):  # never more than one block and a batch is held
                keys.append(ids[begin : begin + size])
                matrices.append(matrix[begin : begin + size])
                held += len(keys[-1])
                if held >= size:
                    yield flush()
                    keys, matrices, held = [], [], 0
        if held:
            yield flush()

    return run


def blocks(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """Stored blocks ``(block, longest, keys, cells)`` of about ``size`` rows, in the order of ``rows`` within its partitions.

    Shorter vectors are filled up with zeros to ``dims``.
    """
    packed = rows.select("key", "vec").mapInArrow(_pack(dims, size), "block long, longest double, keys binary, cells binary")
    path = scratch_path(rows.sparkSession, "blocks")
    packed.write.parquet(path)
    return rows.sparkSession.read.schema(packed.schema).parquet(path)


def few_parts(rows: DataFrame, count: int, size: int) -> DataFrame:
    """Rows dealt out in turn to partitions of about ``size``."""
    return rows.repartition(max(1, min(-(-count // size), 10_000)))


def matrix_of(cells: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(cells, dtype="<f8").reshape(-1, dims)


def keys_of(keys: bytes) -> np.ndarray:
    return np.frombuffer(keys, dtype="<i8")


def ranked(candidates: DataFrame) -> tuple[DataFrame, int, list[float]]:
    """Blocks numbered in ``rank`` by their longest vector, descending; their number; the lengths at even steps of rank.

    Only block numbers and lengths are sorted, one short row per block; at most :data:`LENGTH_STEPS` of them reach the driver.
    """
    order = Window.orderBy(F.desc("longest"), "block")
    numbered = candidates.select("block", "longest").withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    count = candidates.count()
    step = max(1, -(-count // LENGTH_STEPS))
    marks = numbered.where(F.col("rank") % step == 0).orderBy("rank").select("longest").collect()
    return numbered, count, [row["longest"] for row in marks]


def meet(queries: DataFrame, candidates: DataFrame, ranks: DataFrame, count: int, marks: list[float]) -> DataFrame:
    """Each query block beside each candidate block it needs.

    ``queries`` has ``need``: the length under which no candidate can matter. Blocks below it are left out
    by steps of rank here, and exactly after the join. Query blocks are copied once per needed candidate block, vectors are
    never paired outside a task.
    """
    step = max(1, -(-count // LENGTH_STEPS))
    steps = F.size(F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: m >= F.col("need")))
    last = F.least(steps * step, F.lit(count)) - 1
    wanted = queries.where(last >= 0).withColumn("rank", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    tasks = max(1, min(2 * count, 10_000))
    left = candidates.join(ranks.select("block", "rank"), "block").repartition(tasks, "rank")
    right = wanted.select("rank", "need", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c not in ("rank", "need")])
    return right.repartition(tasks, "rank").join(left, "rank").where("longest >= need")


def best_per_query(query: np.ndarray, key: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` best, ties to the smaller key; a key counts once per query, with its best score."""
    order = np.lexsort((key, -score, query))
    if len(order):
        pairs = np.lexsort((-score, key, query))
        new = np.ones(len(pairs), dtype=bool)
        new[1:] = (query[pairs[1:]] != query[pairs[:-1]]) | (key[pairs[1:]] != key[pairs[:-1]])
        first = np.zeros(len(pairs), dtype=bool)
        first[pairs[new]] = True
        order = order[first[order]]
    q = query[order]
    begins = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(q)) - np.repeat(begins, np.diff(np.r_[begins, len(q)]))
    return order[place < k]


def top_pairs(hits: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` over all blocks; rank counts from 1."""
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    numbered = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return numbered.select("query_id", "rank", "vec_id", "score")


def frame_of(query: np.ndarray, key: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"query_id": query, "vec_id": key, "score": score})


