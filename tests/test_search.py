import math

import pytest

from tests.conftest import rows
from textlens.operators import postings as ps
from textlens.operators import sparse_search as ss

DOCS = [(1, "red fish blue fish", "a"), (2, "red bird", "b"), (3, "green bird sings", "b"), (4, "", "c")]
QUERIES = [(10, "red fish"), (11, "unknown words"), (12, "bird bird")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, label string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id long, text string")


def test_vocabulary_counts_occurrences_and_breaks_ties_by_term(docs):
    counts = ps.term_counts(docs, ps.index_terms(high=1))
    top = ps.vocabulary(counts, 3)
    assert rows(top, "term", "tf_total", "df") == [("bird", 2, 2), ("fish", 2, 1), ("red", 2, 2)]


def test_idf_and_unit_length(docs):
    terms = ps.index_terms(high=1)
    vocab = ss.fit_vocabulary(docs, terms, 100)
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    assert idf["red"] == pytest.approx(math.log(5 / 3) + 1)
    assert idf["fish"] == pytest.approx(math.log(5 / 2) + 1)
    weights = {(r["doc_id"], r["term"]): r["w"] for r in ps.tfidf_weights(docs, terms, vocab).collect()}
    red, fish, blue = idf["red"], (1 + math.log(2)) * idf["fish"], idf["blue"]
    length = math.sqrt(red**2 + fish**2 + blue**2)
    assert weights[1, "fish"] == pytest.approx(fish / length)
    assert weights[1, "red"] == pytest.approx(red / length)
    assert not any(d == 4 for d, _ in weights)


def test_boolean_score_is_overlap_over_root_of_sizes(docs, queries):
    out = ss.boolean_search(queries, docs, ps.index_terms(high=1))
    assert rows(out, "query_id", "rank", "doc_id", "score") == [
        (10, 0, 1, round(2 / math.sqrt(6), 6)),
        (10, 1, 2, 0.5),
        (12, 0, 2, round(1 / math.sqrt(2), 6)),
        (12, 1, 3, round(1 / math.sqrt(3), 6)),
    ]


def test_a_document_finds_itself_first(docs, spark):
    own = docs.where("text <> ''").selectExpr("doc_id as query_id", "text")
    out = ss.tfidf_search(own, docs, ps.index_terms()).where("rank = 0")
    assert rows(out, "query_id", "doc_id", "score") == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]


def test_bm25_by_hand(docs, queries):
    out = ss.fulltext_search(queries, docs, fuzzy=False)
    n, average = 4, (4 + 2 + 3) / 4

    def idf(df):
        return math.log(1 + (n - df + 0.5) / (df + 0.5))

    def part(tf, dl):
        return tf / (tf + 1.2 * (0.25 + 0.75 * dl / average))

    expected = {
        (10, 1): idf(2) * part(1, 4) + idf(1) * part(2, 4),
        (10, 2): idf(2) * part(1, 2),
        (12, 2): 2 * idf(2) * part(1, 2),
        (12, 3): 2 * idf(2) * part(1, 3),
    }
    found = {(r["query_id"], r["doc_id"]): r["score"] for r in out.collect()}
    assert found == {key: round(score, 6) for key, score in expected.items()}


def test_fuzzy_search_weighs_by_closeness(docs, spark):
    asked = spark.createDataFrame([(1, "fsih brid")], "query_id long, text string")
    found = {r["doc_id"] for r in ss.fulltext_search(asked, docs).collect()}
    assert found == {1, 2, 3}
    assert ss.fulltext_search(asked, docs, metric="levenshtein").count() == 0


def test_results_do_not_depend_on_partitions_or_blocks(docs, queries):
    terms = ps.index_terms()
    vocab = ss.fit_vocabulary(docs, terms)
    once = rows(ss.cosine_search(queries, docs, vocab, terms))
    assert rows(ss.cosine_search(queries.repartition(3), docs.repartition(7), vocab, terms)) == once
    weights, wanted = ps.tfidf_weights(docs, terms, vocab), ps.tfidf_weights(queries, terms, vocab, "query_id")
    assert rows(ss.score_topk(weights, wanted, ss.VECTOR_LIMIT, block_rows=1)) == once


def test_limits_ranks_and_merge(spark):
    data = [(1, f"word extra{i}") for i in range(2)]
    many = spark.createDataFrame([(i, "word") for i in range(50)], "doc_id long, text string")
    asked = spark.createDataFrame(data[:1], "query_id long, text string")
    full = ss.boolean_search(asked, many, ps.index_terms(high=1))
    assert [r["doc_id"] for r in full.orderBy("rank").collect()] == list(range(ss.VECTOR_LIMIT))
    parts = [ss.boolean_search(asked, many.where(f"doc_id % 2 = {i}"), ps.index_terms(high=1), k=20) for i in (0, 1)]
    merged = ss.merge_topk(parts[0].unionByName(parts[1]), 20)
    assert rows(merged, "query_id", "rank", "doc_id", "score") == rows(full, "query_id", "rank", "doc_id", "score")


def test_united_methods_name_themselves(docs, queries):
    terms = ps.index_terms(high=1)
    hits = ss.unite_methods(
        {"boolean": ss.boolean_search(queries, docs, terms), "fulltext": ss.fulltext_search(queries, docs, fuzzy=False)}
    )
    lists = {r["query_id"]: r["results"] for r in ss.hits_by_method(ss.attach_documents(hits, docs, ["label"])).collect()}
    assert set(lists) == {10, 12}
    assert [(h["rank"], h["doc_id"], h["label"]) for h in lists[10]["fulltext"]] == [(0, 1, "a"), (1, 2, "b")]


def test_plan_keeps_pairs_in_their_task(docs, queries, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    stored = docs.sparkSession.read.parquet(str(tmp_path / "d"))
    terms = ps.index_terms(high=1)
    plan = plan_of(ss.cosine_search(queries, stored, ss.fit_vocabulary(stored, terms), terms))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    # one exchange of documents, one of the best rows per query; the query side is stored
    assert plan.count("Exchange hashpartitioning") == 2


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_vocabulary_size_is_checked(docs):
    with pytest.raises(ValueError):
        ps.vocabulary(ps.term_counts(docs, ps.index_terms()), 0)


def test_terms_are_counted_in_partitions_of_bounded_text(spark, monkeypatch):
    texts = [f"common word{i} other{i % 7} " * 20 for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, ps.term_counts(docs, ps.index_terms()).collect()))
    monkeypatch.setattr(ps, "TASK_BYTES", sum(map(len, texts)) // 30)
    counts = ps.term_counts(docs, ps.index_terms())
    assert counts.rdd.getNumPartitions() >= 30
    assert sorted(map(tuple, counts.collect())) == whole
