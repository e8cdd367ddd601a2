import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from textlens.operators import cluster as cl
from textlens.operators import postings as ps
from textlens.operators import sparse_search as ss
from textlens.session import checkpoint_folder, cut_counted, store
from textlens.sources import store as st
from textlens.sources.corpus import read_corpus_csv, read_entities, read_html, write_corpus_csv
from textlens.sources.vectors import read_word_vectors, write_word_vectors
from textlens.streaming.arrivals import answer_arrivals


def test_corpus_csv_round_trip(spark, tmp_path):
    data = [('a, "quoted" - b', "x"), ("two\nlines - c", "y"), (" kept ", "z")]
    write_corpus_csv(spark.createDataFrame(data, "text string, label string"), str(tmp_path / "c"))
    back = read_corpus_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["text", "label"] and {r["label"] for r in back.collect()} == {"x", "y", "z"}
    assert {r["text"] for r in back.collect()} >= {'a, "quoted" - b', "two\nlines - c"}


def test_html_and_dictionary(spark, tmp_path):
    (tmp_path / "p.htm").write_text("<h2>ی</h2>\n<p>x", encoding="utf-8")
    page = read_html(spark, str(tmp_path / "p.htm")).first()
    assert page["html"] == "<h2>ی</h2>\n<p>x" and page["page_id"].endswith("p.htm")
    (tmp_path / "d.csv").write_text("name,regex\nA,one|two\nB,one|two\nC,three \n", encoding="utf-8")
    assert rows(read_entities(spark, str(tmp_path / "d.csv"), "regex", "person"), "entity_id", "regex", "type") == [
        (0, "one|two", "person"),
        (1, "three ", "person"),
    ]


def test_word_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 3\nsun 1 0.5 -2\nmoon 0 0 1e-3\n", encoding="utf-8")
    loaded = read_word_vectors(spark, str(tmp_path / "v.txt"))
    assert rows(loaded.selectExpr("word", "cast(vec as string) v")) == [("moon", "[0.0, 0.0, 0.001]"), ("sun", "[1.0, 0.5, -2.0]")]
    write_word_vectors(loaded, str(tmp_path / "w"))
    again = read_word_vectors(spark, str(tmp_path / "w"))
    assert rows(again.selectExpr("word", "cast(vec as string) v")) == rows(loaded.selectExpr("word", "cast(vec as string) v"))


def test_table_is_built_once_and_repaired_when_incomplete(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def make():
        calls.append(1)
        return spark.range(len(calls))

    assert st.build_table(spark, path, make).count() == 1
    assert st.build_table(spark, path, make).count() == 1
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert st.build_table(spark, path, make).count() == 2 and len(calls) == 2


def test_model_round_trip(spark, tmp_path):
    vectors = spark.createDataFrame([(i, [float(i), float(i % 3), 1.0]) for i in range(20)], "doc_id long, vec array<double>")
    calls = []

    def fit():
        calls.append(1)
        return cl.fit_projection(vectors, 2)

    first = st.build_pipeline_model(spark, str(tmp_path / "m"), fit)
    again = st.build_pipeline_model(spark, str(tmp_path / "m"), fit)
    assert len(calls) == 1
    text = "doc_id", "cast(vec as string) v"
    assert rows(cl.project(first, vectors).selectExpr(*text)) == rows(cl.project(again, vectors).selectExpr(*text))


def test_clustered_postings_are_searched_without_moving_them(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word w{i % 7} w{i % 5}") for i in range(60)], "doc_id long, text string")
    terms = ps.index_terms(high=1)
    vocab = ss.fit_vocabulary(docs, terms)
    path = str(tmp_path / "weights")

    def read():
        return st.build_clustered_table(spark, path, lambda: ps.tfidf_weights(docs, terms, vocab), "doc_id", "term", 4)

    wanted = ps.tfidf_weights(docs.withColumnRenamed("doc_id", "query_id"), terms, vocab, "query_id")
    expected = rows(ss.cosine_search(docs.withColumnRenamed("doc_id", "query_id"), docs, vocab, terms))
    for _ in range(2):
        hits = ss.score_topk(read(), wanted, ss.VECTOR_LIMIT)
        assert rows(hits) == expected
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(query_id" in plan
        # a later session finds the files, not the catalog entry
        for table in spark.catalog.listTables():
            if table.name.startswith("textlens_"):
                spark.sql(f"DROP TABLE {table.name}")


def test_checkpoints_and_stored_tables(spark):
    assert checkpoint_folder(spark) == checkpoint_folder(spark)
    frame, n = cut_counted(spark.range(5).where("id > 9"))
    assert n == 0 and frame.count() == 0
    assert rows(store(spark.range(3))) == [(0,), (1,), (2,)]


def test_stream_gives_the_batch_answers_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red fish"), (2, "blue bird")], "doc_id long, text string")
    terms = ps.index_terms()
    vocab = ss.fit_vocabulary(docs, terms)
    queries = [(10, "red"), (11, "bird"), (12, "fish bird")]
    for n, row in enumerate(queries):
        spark.createDataFrame([row], "query_id long, text string").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))

    def run():
        source = spark.readStream.schema("query_id long, text string").option("recursiveFileLookup", "true")
        arrivals = source.option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return answer_arrivals(
            arrivals, lambda batch: ss.cosine_search(batch, docs, vocab, terms), str(tmp_path / "out"), str(tmp_path / "cp")
        )

    expected = rows(ss.cosine_search(spark.createDataFrame(queries, "query_id long, text string"), docs, vocab, terms))
    columns = ("query_id", "rank", "doc_id", "score")
    assert rows(run(), *columns) == expected
    # nothing new has arrived: the answers stay as they are
    assert rows(run(), *columns) == expected
    assert run().select(F.countDistinct("batch_id")).first()[0] >= 3


def test_stream_without_arrivals(spark, tmp_path):
    (tmp_path / "in").mkdir()
    arrivals = spark.readStream.schema("query_id long, text string").parquet(str(tmp_path / "in"))
    out = answer_arrivals(arrivals, lambda batch: batch.select("query_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert out.columns == ["query_id", "batch_id"] and out.count() == 0


@pytest.mark.parametrize("word", ["localCheckpoint", "crossJoin", "collectAsList"])
def test_library_avoids(word):
    import pathlib

    sources = pathlib.Path(st.__file__).parents[1].rglob("*.py")
    assert not [s.name for s in sources if f".{word}(" in s.read_text(encoding="utf-8")]


def test_reopened_buckets_lose_no_rows(spark, tmp_path):
    path = str(tmp_path / "postings")
    rows = spark.range(800).select((F.col("id") % 400).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("term"), F.lit(1).alias("tf"))
    st.build_clustered_table(spark, path, lambda: rows, "doc_id", "term", 8)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("textlens_")]:
        spark.sql(f"DROP TABLE {name}")  # as another session would find it
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for asked in (4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(asked))
            opened = st.build_clustered_table(spark, path, lambda: None, "doc_id", "term", asked)
            counted = opened.groupBy("doc_id").agg(F.sum("tf").alias("tf"))
            assert counted.count() == 400 and counted.agg(F.sum("tf")).first()[0] == 800
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_other_arguments_build_anew(spark, tmp_path):
    path = str(tmp_path / "table")
    for arguments, n in (("a", 3), ("a", 5), ("b", 5)):
        got = st.build_table(spark, path, lambda n=n: spark.range(n), arguments).count()
        assert got == (3 if arguments == "a" else 5)


def test_null_groups_stay(spark):
    from textlens.operators.ordering import carry_forward, previous_row

    rows = spark.createDataFrame([(None, 0, "a"), (None, 1, None), (1, 0, "b")], "g int, p int, v string")
    filled = carry_forward(rows, ["g"], "p", F.col("v"), "carried").collect()
    assert sorted((r["g"] or 0, r["p"], r["carried"]) for r in filled) == [(0, 0, "a"), (0, 1, "a"), (1, 0, "b")]
    assert previous_row(rows, ["g"], "p", ["v"], "before").count() == 3


def test_a_late_stream_raises(spark, tmp_path):
    import time

    import pytest

    from textlens.streaming.arrivals import answer_arrivals

    spark.createDataFrame([(1, "x")], "query_id long, text string").write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema("query_id long, text string").parquet(str(tmp_path / "in"))

    def slow(batch):
        time.sleep(20)
        return batch

    with pytest.raises(TimeoutError):
        answer_arrivals(arrivals, slow, str(tmp_path / "out"), str(tmp_path / "state"), timeout=2)
