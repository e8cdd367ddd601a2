"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.llm import collision_search, inner_products
from textlens.llm import vectors as vx

SCHEMA = "vec_id long, embedding array<float>, score string, block int"


def _rows(n=400, d=12, seed=1):
    rng = np.random.default_rng(seed)
    made = rng.standard_normal((n, d)) * rng.random((n, 1)) * 3
    made[50:90] = made[50]  # many equal vectors
    rows = [(i, [float(x) for x in v], "x", 1) for i, v in enumerate(made)]
    nan, inf = float("nan"), float("inf")
    rows += [(100_000, None, "x", 1), (100_020, [nan] * d, "x", 1), (100_040, [None] * d, "x", 1), (100_060, [inf] * d, "x", 1)]
    rows += [(None, [1.0] * d, "x", 1), (100_080, [0.0] * d, "x", 1), (100_100, [2.0, 1.0], "x", 1), (7, rows[7][1], "x", 1), (20, rows[20][1], "x", 1)]
    return rows


def _vectors(rows, d=12):
    out = {}
    for key, vector, *_ in rows:
        if key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            out[key] = np.array([np.float32(x) for x in vector] + [0.0] * (d - len(vector)), dtype=float)
    return out


def test_inner_products_are_exact(spark):
    rows = _rows()
    held = {k: np.floor(1024 * v).astype(int) for k, v in _vectors(rows).items()}
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in inner_products.top_inner_products(frame, F.col("vec_id") % 20 == 0, k=5, block_rows=64, query_rows=8, head=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {k for k in held if k % 20 == 0}
    for q, found in got.items():
        best = sorted(((-int(v @ held[q]), k) for k, v in held.items() if k != q))[:5]
        assert sorted(found) == [(i + 1, k, -s) for i, (s, k) in enumerate(best)]


def test_few_and_no_candidates(spark):
    pair = spark.createDataFrame([(0, [1.0], "x", 1), (3, [2.0], "x", 1)], SCHEMA)
    assert [tuple(r) for r in inner_products.top_inner_products(pair, F.col("vec_id") == 0).collect()] == [(0, 1, 3, 1024 * 2048)]
    assert [tuple(r) for r in collision_search.nearest_by_collisions(pair, F.col("vec_id") == 0).collect()] == [(0, 1, 3, 2.0)]
    for search in (inner_products.top_inner_products, collision_search.nearest_by_collisions):
        assert search(pair.limit(0), F.col("vec_id") == 0).count() == 0
        assert search(pair, F.col("vec_id") == 99).count() == 0
        assert search(spark.createDataFrame([(0, None, "x", 1)], SCHEMA), F.col("vec_id") == 0).count() == 0


def test_collision_search_recall_and_scores(spark):
    rows = _rows(3000, 12, 2)
    held = {k: v for k, v in _vectors(rows).items() if v.any()}
    found = collision_search.nearest_by_collisions(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, block_rows=1024)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {k for k in held if k % 20 == 0}
    recall = []
    for q, hits in got.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 21)) and len({h[1] for h in hits}) == 20
        assert all(abs(held[k] @ held[q] - s) < 1e-9 and k != q for _, k, s in hits)
        assert all((a[2], -a[1]) > (b[2], -b[1]) for a, b in zip(hits, hits[1:]))
        bar = sorted((-(v @ held[q]) for k, v in held.items() if k != q))[19]
        recall.append(np.mean([-s <= bar + 1e-12 for _, _, s in hits]))
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("longest", [1.0, 2.0])
def test_collision_search_recall_of_its_defaults(spark, longest):
    made = np.random.default_rng(4).standard_normal((2000, 64))
    made /= np.sqrt((made**2).sum(1))[:, None]
    made[77] *= longest
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<double>")
    got = {}
    for r in collision_search.nearest_by_collisions(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q, found in got.items():
        best = [i for i in np.argsort(-(made @ made[q]), kind="stable").tolist() if i != q][:20]
        recall.append(len(found & set(best)) / 20)
    assert len(recall) == 100 and np.mean(recall) >= 0.95


def test_best_per_query_counts_a_key_once():
    query, key = np.array([0, 0, 0, 0, 1]), np.array([5, 5, 3, 9, 5])
    best = vx.best_per_query(query, key, np.array([7, 9, 9, 1, 2]), 2)
    assert [(int(query[i]), int(key[i])) for i in best] == [(0, 3), (0, 5), (1, 5)]


def test_products_beyond_64_bits_are_refused():
    with pytest.raises(ValueError):
        inner_products.exact_products(np.array([[2.0**40]]), np.array([[2.0**40]]))
    assert inner_products.exact_products(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]])).tolist() == [2**60 + 1]
