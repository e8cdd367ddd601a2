"""Counting, weighting and scoring in batches against the same by joins and aggregations."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from textlens.operators import embed as em
from textlens.operators import fuzzy as fz
from textlens.operators import graph as gr
from textlens.operators import postings as ps
from textlens.operators import sentence_vectors as sv
from textlens.operators import sparse_search as ss

TERMS = ps.index_terms(["w1"])
SCHEMA = "doc_id long, text string"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def texts(seed, n, words=12):
    draw = random.Random(seed)
    return [" ".join(f"w{min(draw.randint(0, words), draw.randint(0, words))}" for _ in range(draw.randint(0, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    """Keys that repeat, in texts of one and of several lengths, a null key, null and empty texts."""
    listed = [(i % 23, t) for i, t in enumerate(texts(1, 90))] + [(3, "w2 w3"), (3, "w2 w3"), (None, "w2 w4 w2"), (None, "w3"), (50, None), (51, "")]
    return spark.createDataFrame(listed, SCHEMA)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(list(enumerate(texts(2, 12))), "query_id long, text string")


@pytest.fixture(params=[None, "2"])
def batches(spark, request):
    if request.param:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def same(frame, expected):
    near = [F.round(c, 9).alias(c) if t == "double" else c for c, t in expected.dtypes]
    got, want = (sorted(map(tuple, x.select(*expected.columns).select(*near).collect()), key=str) for x in (frame, expected))
    assert got == want and got


@pytest.mark.parametrize("terms", [TERMS, ps.FULLTEXT, ps.index_terms(high=1), ps.index_terms(low=2, high=3)])
@pytest.mark.parametrize("size", [None, 1, 5, 30, 10_000])
def test_vocabulary_in_batches(docs, terms, size):
    same(ps.corpus_vocabulary(docs, terms, size), ps.vocabulary(ps.term_counts(docs, terms), size))


def test_vocabulary_of_keys_over_several_batches(docs, batches):
    for terms in (TERMS, ps.FULLTEXT):
        same(ps.corpus_vocabulary(docs, terms, 7), ps.vocabulary(ps.term_counts(docs, terms), 7))


def test_searches_in_batches_equal_searches_of_rows(docs, queries, batches):
    vocab = ss.fit_vocabulary(docs, TERMS, 40)
    for weigh in (ps.tfidf_weights, ps.boolean_weights):
        wanted = weigh(queries, TERMS, vocab, "query_id")
        pairs = weigh(docs, TERMS, vocab).join(wanted.withColumnRenamed("w", "q"), "term")
        plain = pairs.groupBy("query_id", "doc_id").agg(F.round(F.sum(F.col("w") * F.col("q")), 6).alias("score"))
        # more than there are documents, so that no tie is cut
        same(ss.cosine_search(queries, docs, vocab, TERMS, weigh, k=100).drop("rank"), plain.select("query_id", "doc_id", "score"))
        same(ss.score_topk(weigh(docs, TERMS, vocab), wanted, 3), ss.cosine_search(queries, docs, vocab, TERMS, weigh, k=3))
    counts = ps.term_counts(docs, ps.FULLTEXT, length="dl")
    same(ss.fulltext_search(queries, docs), ss.fulltext_search(queries, docs, counts=counts))


def test_rows_made_in_batches(docs, batches):
    vocab = ss.fit_vocabulary(docs, TERMS, 40)
    made = ps.document_weights(docs, TERMS, vocab)
    same(made, ps.tfidf_weights(docs, TERMS, vocab))
    same(made.withColumn("w", F.col("flag_w")), ps.boolean_weights(docs, TERMS, vocab))
    same(ps.fulltext_postings(docs), ps.term_counts(docs, ps.FULLTEXT, length="dl"))


def test_search_forms_no_row_per_term(docs, queries):
    plans = [plan_of(ss.cosine_search(queries, docs, ss.fit_vocabulary(docs, TERMS), TERMS)), plan_of(ss.fulltext_search(queries, docs))]
    for plan in plans:
        assert "MapInArrow" in plan and "Generate" not in plan and "BroadcastHashJoin" not in plan
    assert "Generate" not in plan_of(ps.top_terms(docs, 3)) and "Generate" not in plan_of(ps.word_counts(docs, ["text"]))


def test_mean_vectors_of_repeated_keys(spark, batches):
    weighted = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, None])], "term string, vec array<double>")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "a"), (2, "x ."), (3, ""), (4, None)], SCHEMA)
    found = em.mean_word_vectors(docs, weighted, 2).collect()
    # texts of one key and one length share a row whose divisor is their length
    assert sorted((r["doc_id"], r["vec"]) for r in found if r["vec"]) == [(1, [1.0, 2.0]), (1, [5.0, 2.0]), (2, [0.0, 0.0])]
    assert sorted(r["doc_id"] for r in found if r["vec"] is None) == [3, 4]


def test_sentence_vectors_with_few_common_terms(docs, monkeypatch, batches):
    keyed = docs.where("doc_id is not null")
    idf, total = sv.corpus_idf(keyed)
    whole = sv.sentence_vectors(keyed, idf, total).select("doc_id", F.posexplode("vec").alias("dim", "value"))
    whole = whole.sparkSession.createDataFrame(whole.collect(), whole.schema)  # before the number is changed
    for few in (0, 3):
        monkeypatch.setattr(sv, "COMMON_TERMS", few)
        same(sv.sentence_vectors(keyed, idf, total).select("doc_id", F.posexplode("vec").alias("dim", "value")), whole)


@pytest.mark.parametrize("metric", ["levenshtein", "alignment"])
def test_hashed_keys_find_the_pairs_of_joined_keys(spark, monkeypatch, metric):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé\U0001d11e") for _ in range(draw.randint(1, 9))) for _ in range(300)}
    known = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, count long")
    terms = spark.createDataFrame([(w,) for w in draw.sample(sorted(words), 50)] + [("abbaab",), ("",)], "word string")
    hashed = fz.fuzzy_pairs(terms, known, metric)
    assert "MapInArrow" in plan_of(hashed) and "Generate" not in plan_of(hashed)
    monkeypatch.setattr(fz, "LARGEST_TERMS", 0)
    same(hashed, fz.fuzzy_pairs(terms, known, metric))


def test_mentions_by_lookup_equal_mentions_by_join(spark, monkeypatch):
    lines = spark.createDataFrame([(i % 40, t) for i, t in enumerate(texts(3, 60, 30))], "seq long, text string")
    entities = spark.createDataFrame([(1, "w1|w30"), (2, "w2"), (7, "1"), (9, "none")], "entity_id long, regex string")
    found = gr.entity_mentions(lines, entities)
    assert "Generate" not in plan_of(found)
    expected = lines.crossJoin(entities).where("text rlike regex").select("seq", "entity_id").distinct()
    same(found, expected)
    monkeypatch.setattr(gr, "BROADCAST_ROWS", 0)
    same(gr.entity_mentions(lines, entities), expected)
    assert rows(gr.entity_mentions(lines, entities.where("entity_id = 9"))) == []


def test_few_edges_are_ranked_without_joins(spark, monkeypatch):
    pairs = [(i % 13 * 5, (i * i + 3) % 11 * 5) for i in range(80)] + [(200, 0), (0, 0), (0, 0)]
    edges = spark.createDataFrame(pairs, "src long, dst long").repartition(3)

    def ranks():
        return rows(gr.pagerank(edges, rounds=10, stride=3)), rows(gr.hits(edges, rounds=5, stride=2))

    with monkeypatch.context() as patch:
        patch.setattr(gr, "_spread", lambda *a: pytest.fail("edges joined with few ranks"))
        held = ranks()
    monkeypatch.setattr(gr, "_known_nodes", lambda edges, table, n: None)
    for a, b in zip(held, ranks()):
        assert len(a) == len(b) and all(x == pytest.approx(y, abs=1e-12) for x, y in zip(a, b))
