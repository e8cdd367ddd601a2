"""Exact largest inner products by length order, rotation, and bounds on the rest of a partial sum."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm import vectors as vx

# Share of the pairs of two blocks that is computed exactly without a closer bound.
FEW_PAIRS = 0.001

# Pairs whose exact product is taken at once.
EXACT_PAIRS = 200_000


def _moments(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for cells in batch.column(0).to_pylist():
                matrix = vx.matrix_of(cells, dims)
                total += matrix.T @ matrix
        at = np.arange(dims * dims, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["cell", "value"])

    return run


def rotation(candidates: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all candidates, strongest first: from the sums of products of their components."""
    parts = candidates.select("cells").mapInArrow(_moments(dims), "cell long, value double")
    moments = np.zeros(dims * dims)
    for row in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # dims * dims rows
        moments[row["cell"]] = row["value"]
    return np.linalg.eigh(moments.reshape(dims, dims))[1][:, ::-1].copy()


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise inner products of integers held in doubles, as Python or 64-bit integers, exactly."""
    bound = np.abs(left).max(initial=0.0) * np.abs(right).max(initial=0.0) * left.shape[1]
    if bound < 2.0**53:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    if bound < 2.0**62:
        return np.einsum("ij,ij->i", left.astype(np.int64), right.astype(np.int64))
    raise ValueError("inner products beyond 64 bits")


def _pruned(query: np.ndarray, candidate: np.ndarray, turn: np.ndarray, least: np.ndarray, head: int):
    """Pairs whose bound reaches the query's ``least``: the product of lengths, then partial sums and the rests' lengths.

    The sum grows by ``head`` rotated components at a time, strongest first; it ends when few pairs
    are left, which need no further bound.
    """
    rq, rc = query @ turn, candidate @ turn
    tails_q = np.sqrt(np.cumsum((rq**2)[:, ::-1], axis=1)[:, ::-1])
    tails_c = np.sqrt(np.cumsum((rc**2)[:, ::-1], axis=1)[:, ::-1])
    slack = 1e-9 * (1.0 + tails_q[:, 0] * tails_c[:, 0].max(initial=0.0))
    bar = (least - slack)[:, None]
    alive = np.outer(tails_q[:, 0], tails_c[:, 0]) >= bar
    total = np.zeros(alive.shape)
    for at in range(0, turn.shape[1], head):
        if np.count_nonzero(alive) <= FEW_PAIRS * alive.size:
            break
        end = at + head
        total += rq[:, at:end] @ rc[:, at:end].T
        rest = np.outer(tails_q[:, end], tails_c[:, end]) if end < turn.shape[1] else 0.0
        alive &= total + rest >= bar
    return np.nonzero(alive)


def _hits(query, query_keys, candidate, keys, turn, least, head, k):
    """Best ``k`` of one candidate block for each query, as positions of the query, keys and scores."""
    found = []
    step = max(1, 4_000_000 // max(1, len(keys)))
    for begin in range(0, len(query), step):
        part = slice(begin, begin + step)
        q, c = _pruned(query[part], candidate, turn, least[part], head)
        q += begin
        other = query_keys[q] != keys[c]
        q, c = q[other], c[other]
        scores = [
            exact_products(query[q[i : i + EXACT_PAIRS]], candidate[c[i : i + EXACT_PAIRS]]) for i in range(0, len(q), EXACT_PAIRS)
        ]
        score = np.concatenate(scores) if scores else np.zeros(0, dtype=np.int64)
        best = vx.best_per_query(q, keys[c], score, k)
        found.append((q[best], keys[c[best]], score[best]))
    return [np.concatenate(column) for column in zip(*found)]


def _thresholds(top: list[tuple[bytes, bytes]], dims: int, turn: np.ndarray, head: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least_of, need = [], []
            for row in batch.itertuples(index=False):
                query, ids = vx.matrix_of(row.cells, dims), vx.keys_of(row.keys)
                least = np.full(len(ids), -np.inf)
                for keys, cells in top:
                    q, _, score = _hits(query, ids, vx.matrix_of(cells, dims), vx.keys_of(keys), turn, least, head, k)
                    # results come sorted by query and score; the last of k is the bar
                    counts = np.bincount(q, minlength=len(ids))
                    full = np.flatnonzero(counts == k)
                    least[full] = score[np.cumsum(counts)[full] - 1]
                length = np.sqrt((query**2).sum(1))
                reach = np.where(least > 0, least / np.maximum(length, 1e-300) * (1 - 1e-9), -1.0)
                least_of.append(least.tobytes())
                need.append(float(reach.min(initial=np.inf)))
            yield batch.assign(least=least_of, need=need)

    return run


def _search(dims: int, turn: np.ndarray, head: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                query, ids = vx.matrix_of(row.q_cells, dims), vx.keys_of(row.q_keys)
                least = np.frombuffer(row.q_least, dtype="<f8")
                q, key, score = _hits(query, ids, vx.matrix_of(row.cells, dims), vx.keys_of(row.keys), turn, least, head, k)
                yield vx.frame_of(ids[q], key, score)

    return run


def top_inner_products(
    rows: DataFrame,
    queries: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 1024.0,
    block_rows: int = 4_096,
    query_rows: int = 512,
    head: int = 16,
) -> DataFrame:
    """Each query's ``k`` largest integer inner products: ``(query_id, rank, vec_id, score long)``.

    Components become ``floor(scale * x)``. Queries are the rows where ``queries`` holds, candidates all rows with
    another key than the query's. Ties go to the smaller key, ``rank`` counts from 1. Rows without a
    key, and vectors that are null or hold null or non-finite numbers, take no part; an empty vector
    counts as zeros, and shorter ones are filled up with zeros. Rows that share a key are one
    candidate, with the best of their scores. Fewer than ``k`` candidates give fewer rows, no queries none. Other columns
    are not read.

    Candidates are dealt to blocks in descending length. The longest block gives each query a bar, the score of its
    k-th best there. A candidate block meets the queries only while its longest vector can reach a bar; in it, the
    product of lengths bounds a pair, then the sum over the strongest rotated components, ``head`` more at a
    time, plus the product of the lengths of the rests. What is left is computed exactly.
    """
    spark = rows.sparkSession
    taken = vx.doubles(rows, key, vector, queries, lambda x: F.floor(F.lit(scale) * x).cast("double"))
    facts = taken.agg(F.max(F.size("vec")).alias("dims"), F.count("*").alias("n"), F.count_if("query").alias("queries")).first()
    if not facts["dims"]:
        if not facts["n"]:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, facts["dims"])
    parts = max(1, min(-(-facts["n"] // block_rows), 10_000))
    sorted_rows = taken.repartitionByRange(parts, F.desc("length"), "key").sortWithinPartitions(F.desc("length"), "key")
    candidates = vx.blocks(sorted_rows, dims, block_rows)
    turn = rotation(candidates, dims)
    head = min(head, dims)
    # one block: at most block_rows vectors, or one Arrow batch more
    longest = candidates.orderBy(F.desc("longest"), "block").select("keys", "cells").limit(1).collect()
    top = [(bytes(r["keys"]), bytes(r["cells"])) for r in longest]
    asked = vx.blocks(vx.few_parts(taken.where("query"), facts["queries"], query_rows), dims, query_rows)
    schema = "block long, longest double, keys binary, cells binary, least binary, need double"
    barred = asked.mapInPandas(_thresholds(top, dims, turn, head, k), schema)
    ranks, count, marks = vx.ranked(candidates)
    met = vx.meet(barred.select("keys", "cells", "least", "need"), candidates, ranks, count, marks)
    fields = met.select("q_keys", "q_cells", "q_least", "keys", "cells")
    return vx.top_pairs(fields.mapInPandas(_search(dims, turn, head, k), "query_id long, vec_id long, score long"), k)
