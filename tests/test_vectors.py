import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from textlens.functions import vectors as vx
from textlens.operators import cluster as cl
from textlens.operators import embed as em
from textlens.operators.dense_search import approximate_cosine_topk, cosine_topk


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(5)
    return draw.normal(size=(200, 6))


@pytest.fixture(scope="module")
def docs(spark, points):
    data = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame([*data, (900, [0.0] * 6), (901, None)], "doc_id long, vec array<float>").repartition(5)


def brute_force(points, wanted, k):
    points = points.astype(np.float32).astype(np.float64)
    out = []
    for q in wanted:
        scores = points @ points[q] / (np.linalg.norm(points, axis=1) * np.linalg.norm(points[q]) + 1e-10)
        best = sorted((-round(s, 6), i) for i, s in enumerate(scores))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_cosine_topk_equals_brute_force(docs, points, block):
    queries = docs.where("doc_id < 9").withColumnRenamed("doc_id", "query_id")
    found = rows(cosine_topk(queries, docs, 5, block_queries=block))
    for a, b in zip(found, brute_force(points, range(9), 5), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=2e-6)


def test_zero_vectors_score_zero_and_null_vectors_are_skipped(docs, spark):
    only = docs.where("doc_id >= 900")
    queries = spark.createDataFrame([(1, [1.0] * 6)], "query_id long, vec array<double>")
    assert rows(cosine_topk(queries, only, 5)) == [(1, 0, 900, 0.0)]
    assert cosine_topk(queries.where("false"), docs).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(40)], "doc_id long, vec array<double>").repartition(7)
    queries = spark.createDataFrame([(1, [2.0, 0.0])], "query_id long, vec array<double>")
    assert [r["doc_id"] for r in cosine_topk(queries, same, 4).orderBy("rank").collect()] == [0, 1, 2, 3]


def test_approximate_search_recalls_most(docs):
    queries = docs.where("doc_id < 20").withColumnRenamed("doc_id", "query_id")
    exact = {(r["query_id"], r["doc_id"]) for r in cosine_topk(queries, docs, 3).collect()}
    near = {(r["query_id"], r["doc_id"]) for r in approximate_cosine_topk(queries, docs, 3).collect()}
    assert len(exact & near) / len(exact) > 0.8


def test_softmax_and_argmax(spark):
    frame = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0, 0.0],)], "x array<double>")
    out = frame.select(vx.softmax(F.col("x")).alias("p"), vx.argmax(F.col("x")).alias("i")).collect()
    total = math.exp(-2) + 2
    assert out[0]["p"] == pytest.approx([math.exp(-2) / total, 1 / total, 1 / total])
    assert [r["i"] for r in out] == [1, 0]
    assert out[1]["p"] == pytest.approx([1.0, 0.0, 0.0])


def test_mean_word_vectors_by_hand(spark):
    vocab = spark.createDataFrame([("red", 2.0), ("fish", 3.0)], "term string, idf double")
    words = spark.createDataFrame([("red", [1.0, 0.0]), ("fish", [0.0, 1.0]), ("other", [9.0, 9.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, "red fish, other red"), (2, "Red"), (3, "  "), (4, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["vec"] for r in em.mean_word_vectors(docs, em.weighted_word_vectors(words, vocab), 2).collect()}
    # five tokens: red fish , other red
    assert out[1] == pytest.approx([2 * 2 / 5, 3 / 5])
    assert out[2] == [0.0, 0.0]
    assert out[3] is None and out[4] is None


def test_encoder_does_not_depend_on_batch_mates(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} and more {i}") for i in range(30)], "doc_id long, text string")
    once = rows(em.encode_texts(docs, em.hashing_encoder(8), batch_size=1000).selectExpr("doc_id", "cast(vec as string)"))
    again = rows(em.encode_texts(docs.repartition(7), em.hashing_encoder(8), batch_size=2).selectExpr("doc_id", "cast(vec as string)"))
    assert once == again


def test_assignment_ties_go_to_the_lower_cluster(spark):
    centroids = spark.createDataFrame([(3, [0.0]), (1, [2.0]), (2, [10.0])], "cluster_id int, vec array<double>")
    vectors = spark.createDataFrame([(1, [1.0]), (2, [-5.0]), (3, [7.0]), (4, None)], "doc_id long, vec array<double>")
    assert rows(cl.assign_to_centroids(vectors, centroids), "doc_id", "cluster_id", "distance") == [(1, 1, 1.0), (2, 3, 25.0), (3, 2, 9.0)]
    with pytest.raises(ValueError):
        cl.assign_to_centroids(vectors, centroids.where("false"))


def test_histogram_lists_and_members(spark):
    assigned = spark.createDataFrame(
        [(1, 0, "a", 3.0), (2, 0, "b", 1.0), (3, 0, "b", 1.0), (4, 1, "c", 0.0)],
        "doc_id long, cluster_id int, label string, distance double",
    )
    histogram = cl.cluster_labels(assigned)
    lists = {r["cluster_id"]: (r["counts"], r["labels"]) for r in cl.label_lists(histogram).collect()}
    assert lists == {0: ([2, 1], ["b", "a"]), 1: ([1], ["c"])}
    queries = spark.createDataFrame([(7, 0)], "query_id long, cluster_id int")
    assert cl.describe_queries(queries, histogram).first()["labels"] == ["b", "a"]
    assert rows(cl.cluster_members(assigned, 2), "cluster_id", "rank", "doc_id") == [(0, 0, 2), (0, 1, 3), (1, 0, 4)]


def test_projection_and_clusters(docs, points):
    model = cl.fit_projection(docs.where("doc_id < 900"), 3)
    reduced = cl.project(model, docs.where("doc_id < 900"))
    matrix = np.array([r["vec"] for r in reduced.orderBy("doc_id").collect()])
    assert np.allclose(matrix.mean(axis=0), 0, atol=1e-6)
    variances = matrix.var(axis=0)
    assert list(variances) == sorted(variances, reverse=True)
    expected = np.linalg.svd(points - points.mean(axis=0))[1][:3] ** 2 / len(points)
    assert np.allclose(variances, expected, rtol=1e-4)
    fitted = cl.fit_clusters(reduced, 4, rounds=50)
    by_model = rows(cl.predict_clusters(fitted, reduced), "doc_id", "cluster_id")
    by_table = rows(cl.assign_to_centroids(reduced, cl.centroid_table(fitted, docs.sparkSession)), "doc_id", "cluster_id")
    assert by_model == by_table
