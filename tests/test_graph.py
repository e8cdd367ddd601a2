import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from textlens.operators import graph as gr

TEXTS = ["rostam and sohrab", "", "rostam rides", "kay [2] here", "sohrabs end", "zal ", "zalx", "rostam zal ", "x", "kay", "end"]
REGEXES = ["rostam|rustam", "sohrab", "zal ", "ka[yz]", "[2]", "sohrab", "missing"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "seq long, text string").repartition(3)


@pytest.fixture(scope="module")
def entities(spark):
    return gr.distinct_entities(spark.createDataFrame([(r,) for r in REGEXES], "regex string"))


def names(entities):
    return {r["entity_id"]: r["regex"] for r in entities.collect()}


def test_equal_regexes_become_one_entity(entities):
    assert rows(entities, "entity_id", "regex") == list(enumerate(sorted(set(REGEXES))))


def test_mentions_equal_a_regex_search(texts, entities):
    known = names(entities)
    found = sorted((r["seq"], known[r["entity_id"]]) for r in gr.entity_mentions(texts, entities).collect())
    assert found == sorted((i, x) for i, t in enumerate(TEXTS) for x in set(REGEXES) if re.search(x, t))


def test_support(texts, entities):
    kept = gr.with_support(gr.entity_mentions(texts, entities), 2)
    known = names(entities)
    assert {known[r["entity_id"]]: r["support"] for r in gr.entity_support(kept).collect()} == {
        "rostam|rustam": 3, "sohrab": 2, "zal ": 2, "ka[yz]": 2,
    }


def shared_windows(positions, window):
    """Two tilings as padded blocks of a 0/1 matrix."""
    total = 0
    for shift in (0, window // 2):
        size = positions.shape[1] + shift
        padded = np.pad(positions, ((0, 0), (shift, -size % window)))
        blocks = padded.reshape(len(positions), -1, window).any(axis=2).astype(int)
        total = total + blocks @ blocks.T
    return total


@pytest.mark.parametrize("n,window", [(20, 5), (23, 5), (7, 20), (24, 4), (9, 1)])
def test_cooccurrence_equals_the_matrix_product(spark, n, window):
    draw = np.random.default_rng(n)
    positions = draw.random((6, n)) < 0.2
    positions[0, 0] = True
    data = [(int(e), int(s)) for e, s in zip(*np.nonzero(positions))]
    mentions = spark.createDataFrame(data, "entity_id long, seq long").repartition(3)
    expected = shared_windows(positions, window)
    found = np.zeros((6, 6), dtype=int)
    for r in gr.cooccurrence(mentions, window).collect():
        found[r["src"], r["dst"]] = r["shared"]
    assert (found == expected).all()
    edges = gr.adjacency(gr.cooccurrence(mentions, window))
    assert edges.count() == (expected > 0).sum()


def stationary(matrix, damping):
    n = len(matrix)
    out = matrix.sum(axis=1, keepdims=True)
    steps = np.where(out > 0, matrix / np.where(out > 0, out, 1), 1 / n)
    google = damping * steps + (1 - damping) / n
    return np.linalg.matrix_power(google, 400)[0]


def edge_frame(spark, matrix):
    return spark.createDataFrame([(int(a), int(b)) for a, b in zip(*np.nonzero(matrix))], "src long, dst long")


GRAPHS = [
    np.array([[1, 1], [1, 1]]),
    np.array([[1, 1, 0], [1, 1, 1], [0, 1, 1]]),
    np.array([[0, 1, 1, 0], [0, 0, 1, 0], [1, 0, 0, 1], [0, 0, 0, 0]]),
]


@pytest.mark.parametrize("matrix", GRAPHS)
def test_pagerank_is_the_stationary_vector(spark, matrix):
    found = rows(gr.pagerank(edge_frame(spark, matrix), rounds=30))
    assert [r for _, r in found] == pytest.approx(list(stationary(matrix, 0.9)), abs=1e-2)
    assert sum(r for _, r in found) == pytest.approx(1)


def test_pagerank_stops_at_tolerance_and_keeps_lone_nodes(spark):
    lone = spark.createDataFrame([(9,)], "node long")
    found = dict(rows(gr.pagerank(edge_frame(spark, GRAPHS[1]), rounds=175, tolerance=1e-3, nodes=lone)))
    assert set(found) == {0, 1, 2, 9} and sum(found.values()) == pytest.approx(1)
    assert gr.pagerank(edge_frame(spark, GRAPHS[1]).where("false")).count() == 0


def test_pagerank_beyond_the_broadcast_limit(spark, monkeypatch):
    edges = edge_frame(spark, GRAPHS[2])
    expected = [r for _, r in rows(gr.pagerank(edges, rounds=5))]
    monkeypatch.setattr(gr, "BROADCAST_ROWS", 1)
    assert [r for _, r in rows(gr.pagerank(edges, rounds=5))] == pytest.approx(expected)


def test_hits_on_undirected_graph(spark):
    out = rows(gr.hits(edge_frame(spark, GRAPHS[1]), rounds=20, tolerance=1e-10), "node", "hubs", "authorities")
    side = 1 / (2 + 2**0.5)
    for (_, hub, authority), expected in zip(out, [side, 1 - 2 * side, side]):
        assert hub == pytest.approx(expected, abs=1e-6) and authority == pytest.approx(hub, abs=1e-6)


def test_ranks_lookup_query_names_and_types(spark, texts, entities):
    counts = gr.entity_graph(texts, entities, 5)
    edges = gr.adjacency(counts)
    ranks = gr.entity_ranks(entities, gr.pagerank(edges, rounds=5), gr.hits(edges, rounds=5))
    assert ranks.count() == 5
    assert {r["element"] for r in gr.rank_lookup(ranks, "ro").collect()} == {"rostam|rustam"}
    queries = spark.createDataFrame([(1, "sohrabs and rustam"), (2, "nobody"), (3, "zal")], "query_id long, text string")
    found = gr.query_entities(queries, ranks).orderBy("query_id", "position").collect()
    assert [(r["query_id"], r["position"]) for r in found] == [(1, 0), (1, 1)]
    assert {r["name"] for r in found} == {"rostam", "sohrab"}
    assert found[0]["rank"] >= found[1]["rank"]
    typed = gr.typed_query_entities(queries, {"person": ranks, "place": ranks})
    assert rows(typed.groupBy("type").agg(F.count("*"), F.min("position"))) == [("person", 2, 0), ("place", 2, 0)]
    close = gr.close_entities(counts, 1)
    assert all(r["src"] != r["dst"] and r["rank"] == 0 for r in close.collect())


def test_packed_ranks_equal_joined_ranks(spark, monkeypatch):
    pairs = [(i % 13 * 5, (i * i + 3) % 11 * 5) for i in range(80)] + [(200, 0), (0, 0), (0, 0)]
    edges = spark.createDataFrame(pairs, "src long, dst long").repartition(3)
    monkeypatch.setattr(gr, "PACKED_EDGES", 0)
    monkeypatch.setattr(gr, "BLOCK_EDGES", 5)
    packed = rows(gr.pagerank(edges, rounds=10, stride=3)), rows(gr.hits(edges, rounds=5, stride=2))
    monkeypatch.setattr(gr, "_known_nodes", lambda edges, table, n: None)
    joined = rows(gr.pagerank(edges, rounds=10, stride=3)), rows(gr.hits(edges, rounds=5, stride=2))
    for a, b in zip(packed, joined):
        assert len(a) == len(b) and all(x == pytest.approx(y, abs=1e-12) for x, y in zip(a, b))


def test_a_round_shuffles_no_edges(spark, monkeypatch):
    monkeypatch.setattr(gr, "PACKED_EDGES", 0)
    monkeypatch.setattr(gr, "_spread", lambda *a: pytest.fail("edges joined with few ranks"))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    assert all(rank == pytest.approx(1 / 3) for _, rank in rows(gr.pagerank(edges, rounds=4)))
