"""Registered queries: one function per key, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.catalog import inputs
from textlens.functions import text as tx
from textlens.operators import classify as kl
from textlens.operators import cluster as cl
from textlens.operators import embed as em
from textlens.operators import extract as ex
from textlens.operators import graph as gr
from textlens.operators import postings as ps
from textlens.operators import sentence_vectors as sv
from textlens.operators import sparse_search as ss
from textlens.operators.dense_search import cosine_topk
from textlens.operators.expand import correct_words, expand_queries
from textlens.operators.fuzzy import fuzzy_expand
from textlens.operators.joins import measured_join
from textlens.operators.ordering import dense_index
from textlens.operators.rows import unnest
from textlens.plans.index import build_index
from textlens.plans.retrieve import answer_queries
from textlens.session import cut, scratch_path, store
from textlens.sources.vectors import read_word_vectors, write_word_vectors
from textlens.streaming.arrivals import answer_arrivals

ENTRIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Ranks are taken where another round moves them by less than this in all.
RANK_TOLERANCE = 1e-13
PERSON_WINDOW = 5
PLACE_WINDOW = 20


def entry(function):
    ENTRIES[function.__name__.rstrip("_")] = function
    return function


def _r(column, digits: int = 6):
    return F.round(column, digits)


# ---------------------------------------------------------------- extraction


def _segments(spark, sf_dir):
    return ex.flat_segments(inputs.table(spark, sf_dir, "pages"))


@entry
def html_segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@entry
def heading_ffill(spark, sf_dir):
    rows = ex.label_by_heading(_segments(spark, sf_dir), heading="h1")
    return rows.select("page_id", "pos", "text", "label")


@entry
def label_filter(spark, sf_dir):
    kept = ex.keep_labels(inputs.documents(spark, sf_dir), excluded=["src3", "src17"], prefix="src1")
    return kept.select("doc_id", "label")


def _joined(spark, sf_dir):
    return ex.join_fragments(inputs.fragments(spark, sf_dir), ",", ["doc_id"])


@entry
def join_fragments(spark, sf_dir):
    return _joined(spark, sf_dir).select("doc_id", "pos", "text")


def _couplets(spark, sf_dir):
    return ex.split_couplets(_joined(spark, sf_dir), ",")


@entry
def split_couplets(spark, sf_dir):
    return _couplets(spark, sf_dir).select("doc_id", "pos", "half1", "half2", "beyt", "text")


@entry
def corpus_seq(spark, sf_dir):
    return dense_index(_joined(spark, sf_dir).select("doc_id", "pos"), ["doc_id", "pos"])


# ---------------------------------------------------------------- tokens and vocabulary


@entry
def normalize_text(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return docs.select("doc_id", tx.normalize_text(F.col("text")).alias("text"))


@entry
def tokenize(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return unnest(docs, tx.index_tokens(F.col("text")), "token", "pos").select("doc_id", "pos", "token")


def _stop_words(docs: DataFrame, words: DataFrame | None = None) -> list[str]:
    return [row["term"] for row in ps.top_terms(docs, inputs.STOP_WORDS, words=words).collect()]


def _terms(docs: DataFrame, words: DataFrame | None = None):
    return ps.index_terms(_stop_words(docs, words))


@entry
def remove_stopwords(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    kept = tx.drop_stop_words(tx.index_tokens(F.col("text")), _stop_words(docs))
    return unnest(docs, kept, "token", "pos").select("doc_id", "pos", "token")


@entry
def ngrams(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    listed = docs.select("doc_id", tx.index_tokens(F.col("text")).alias("tokens"))
    return unnest(listed, tx.word_ngrams(F.col("tokens")), "term", "pos").select("doc_id", "pos", "term")


@entry
def vocabulary_topn(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return ps.vocabulary(ps.term_counts(docs, _terms(docs)))


@entry
def word_counts(spark, sf_dir):
    return ps.word_counts(_couplets(spark, sf_dir))


@entry
def term_counts(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    terms = _terms(docs)
    vocab = ss.fit_vocabulary(docs, terms)
    return ps.term_counts(docs, terms, within=vocab.select("term")).select("doc_id", "term", "tf")


@entry
def build_postings(spark, sf_dir):
    """Full-text postings with document lengths, as an index stores them."""
    docs = inputs.documents(spark, sf_dir)
    return ps.term_counts(docs, ps.FULLTEXT, length="dl").select("doc_id", "term", "tf", "dl")


# ---------------------------------------------------------------- weights and vectors


@entry
def smoothed_idf(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    vocab = ps.vocabulary(ps.term_counts(docs, _terms(docs)))
    return ps.smoothed_idf(vocab, ps.document_count(docs)).select("term", "df", _r("idf").alias("idf"))


@entry
def tfidf_weights(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    terms = _terms(docs)
    vocab = ss.fit_vocabulary(docs, terms)
    weights = ps.tfidf_weights(docs, terms, vocab)
    return weights.select("doc_id", "term", "tf", _r("w").alias("w"))


def _word_embeddings(docs, vocab):
    weighted = cut(em.weighted_word_vectors(inputs.word_vectors(vocab), vocab))
    return lambda rows, key: em.mean_word_vectors(rows, weighted, inputs.WORD_DIMENSION, key)


@entry
def load_word_vectors(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    path = scratch_path(spark, "word-vectors")
    single = ss.fit_vocabulary(docs, ps.index_terms(high=1), size=None)
    write_word_vectors(inputs.word_vectors(single), path)
    loaded = read_word_vectors(spark, path)
    return loaded.select("word", F.posexplode("vec").alias("dim", "value")).withColumn(
        "value", _r(F.col("value").cast("double"), 4) + 0.0
    )


@entry
def word_embedding_docs(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    embed = _word_embeddings(docs, ss.fit_vocabulary(docs, _terms(docs)))
    vectors = embed(docs, "doc_id")
    return vectors.select("doc_id", F.posexplode("vec").alias("dim", "value")).withColumn("value", _r("value") + 0.0)


@entry
def encode_batches(spark, sf_dir):
    """Hashed sentence vectors of all documents under the corpus idf, one row per component."""
    docs = inputs.documents(spark, sf_dir)
    idf, total = sv.corpus_idf(docs)
    vectors = sv.sentence_vectors(docs, idf, total)
    return vectors.select("doc_id", F.posexplode("vec").alias("dim", "value")).withColumn("value", _r("value") + 0.0)


# ---------------------------------------------------------------- search


def _with_label(hits, docs):
    return ss.attach_documents(hits, docs, ["label"]).select("query_id", "rank", "doc_id", "label", "score")


@entry
def tfidf_search(spark, sf_dir):
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    return _with_label(ss.tfidf_search(queries, docs, _terms(docs)), docs)


@entry
def boolean_search(spark, sf_dir):
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    return _with_label(ss.boolean_search(queries, docs, _terms(docs)), docs)


@entry
def bm25_search(spark, sf_dir):
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    return _with_label(ss.fulltext_search(queries, docs, fuzzy=False), docs)


def _misspelt_queries(spark, sf_dir):
    return inputs.queries(spark, sf_dir).withColumn("text", inputs.misspelt(F.col("text")))


@entry
def fuzzy_search(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return _with_label(ss.fulltext_search(_misspelt_queries(spark, sf_dir), docs), docs)


@entry
def fuzzy_expand_(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    vocab = ss.fulltext_vocabulary(docs)
    terms = ps.term_counts(_misspelt_queries(spark, sf_dir), ps.FULLTEXT, "query_id")
    known = vocab.select(F.col("term").alias("word"), F.col("tf_total").alias("count"))
    found = fuzzy_expand(terms.select(F.col("term").alias("word")).distinct(), known)
    return found.select("term", "match", "edits", "count")


@entry
def cosine_topk_(spark, sf_dir):
    means = inputs.centroids(spark, sf_dir).withColumnRenamed("label", "query_id")
    return cosine_topk(means, inputs.vectors(spark, sf_dir))


@entry
def sentence_embedding_search(spark, sf_dir):
    """Stored sentence vectors searched with the mean vector of each label, documents attached."""
    means = inputs.centroids(spark, sf_dir).withColumnRenamed("label", "query_id")
    docs = inputs.vectors(spark, sf_dir)
    return _with_label(cosine_topk(means, docs), docs)


@entry
def topk_merge(spark, sf_dir):
    """Top lists of four stored batches, merged."""
    means = cut(inputs.centroids(spark, sf_dir).withColumnRenamed("label", "query_id"))
    docs = inputs.vectors(spark, sf_dir)
    lists = [cosine_topk(means, docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == b)) for b in range(4)]
    united = lists[0].unionByName(lists[1]).unionByName(lists[2]).unionByName(lists[3])
    return ss.merge_topk(united, ss.VECTOR_LIMIT).select("query_id", "rank", "doc_id", "score")


@entry
def word_embedding_search(spark, sf_dir):
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    embed = _word_embeddings(docs, ss.fit_vocabulary(docs, _terms(docs)))
    return _with_label(cosine_topk(embed(queries, "query_id"), embed(docs, "doc_id")), docs)


def _all_hits(spark, sf_dir):
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    words = ps.index_words(docs)  # counted once, for the stop words, the vocabulary and the idf
    terms = _terms(docs, words)
    vocab = ss.fit_vocabulary(docs, terms, words=words)
    embed = _word_embeddings(docs, vocab)
    hits = ss.unite_methods(
        {
            "tfidf": ss.cosine_search(queries, docs, vocab, terms, ps.tfidf_weights),
            "boolean": ss.cosine_search(queries, docs, vocab, terms, ps.boolean_weights),
            "word_embedding": cosine_topk(embed(queries, "query_id"), embed(docs, "doc_id")),
            "sentence_embedding": _sentence_search(queries, docs, words),
            "fulltext": ss.fulltext_search(queries, docs),
        }
    )
    return ss.attach_couplets(hits, docs)


def _sentence_search(queries, docs, words):
    """All documents searched with the hashed sentence vector of each query text."""
    doc_vectors, query_vectors = sv.document_and_query_vectors(docs, queries, words=words)
    return cosine_topk(query_vectors, doc_vectors)


@entry
def search_all_methods(spark, sf_dir):
    return _all_hits(spark, sf_dir).select("query_id", "method", "rank", "doc_id", "label", "half1", "half2", "score")


# ---------------------------------------------------------------- query expansion


def _dictionary(spark, sf_dir):
    return ps.word_counts(inputs.documents(spark, sf_dir), ["text"])


@entry
def correct_word(spark, sf_dir):
    words = unnest(_misspelt_queries(spark, sf_dir), tx.whitespace_tokens(F.col("text")), "word")
    return correct_words(words.select("word").distinct(), _dictionary(spark, sf_dir))


@entry
def expand_query(spark, sf_dir):
    queries = _misspelt_queries(spark, sf_dir)
    return expand_queries(queries, _dictionary(spark, sf_dir))


# ---------------------------------------------------------------- clusters


@entry
def pca_project(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir).select("doc_id", "vec")
    return cl.project(cl.fit_projection(vectors), vectors)


@entry
def kmeans_fit(spark, sf_dir):
    vectors = inputs.vectors(spark, sf_dir).select("doc_id", "label", "vec")
    reduced = cl.project(cl.fit_projection(vectors), vectors)
    return cl.predict_clusters(cl.fit_clusters(reduced), reduced).select("doc_id", "label", "cluster_id")


def _assigned(spark, sf_dir):
    means = inputs.centroids(spark, sf_dir).withColumnRenamed("label", "cluster_id")
    return cl.assign_to_centroids(inputs.vectors(spark, sf_dir), means)


@entry
def kmeans_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).select("doc_id", "cluster_id", _r("distance").alias("distance"))


@entry
def cluster_labels(spark, sf_dir):
    return cl.cluster_labels(_assigned(spark, sf_dir)).select("cluster_id", "rank", "label", "count")


@entry
def query_cluster(spark, sf_dir):
    """Cluster of each vector as a query, with the cluster's label list."""
    assigned = _assigned(spark, sf_dir)
    described = cl.describe_queries(
        assigned.withColumnRenamed("doc_id", "query_id"), cl.cluster_labels(assigned)
    )
    listed = F.explode(F.arrays_zip("counts", "labels"))
    flat = described.select("query_id", "cluster_id", listed.alias("_l"))
    return flat.select("query_id", "cluster_id", F.col("_l.labels").alias("label"), F.col("_l.counts").alias("count"))


@entry
def cluster_members(spark, sf_dir):
    return cl.cluster_members(_assigned(spark, sf_dir), 20)


# ---------------------------------------------------------------- classification


def _label_index(docs):
    return cut(kl.label_index(kl.top_labels(docs)))


@entry
def top_labels(spark, sf_dir):
    return kl.top_labels(inputs.documents(spark, sf_dir))


@entry
def label_index(spark, sf_dir):
    return kl.label_index(kl.top_labels(inputs.documents(spark, sf_dir)))


@entry
def label_bucket(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return kl.bucket_labels(docs, _label_index(docs), kl.TOP_LABELS).select("doc_id", "label", "label_id")


@entry
def hash_split(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select("doc_id", kl.split_column(F.col("doc_id")).alias("split"))


@entry
def class_weights(spark, sf_dir):
    weights = kl.class_weights(_label_index(inputs.documents(spark, sf_dir)))
    return weights.select("label", "label_id", _r("weight").alias("weight"))


@entry
def classify_fit(spark, sf_dir):
    """Weighted classifier on stored vectors, measured on its three parts."""
    rows = inputs.vectors(spark, sf_dir).withColumn("label", F.col("label").cast("string"))
    index = _label_index(rows)
    parts = kl.vector_features(kl.bucket_labels(rows, index, kl.TOP_LABELS)).withColumn(
        "split", kl.split_column(F.col("doc_id"))
    )
    model = kl.fit_classifier(kl.vector_classifier(), parts.where("split = 'train'"), kl.class_weights(index))
    return kl.classification_metrics(kl.predict_labels(model, parts, index))


@entry
def classify_predict(spark, sf_dir):
    """Quality of every document, predicted from its text by a classifier fitted on the labelled ones."""
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text").repartition("doc_id")
    docs = store(kl.text_counts(docs), "text-counts")  # texts are normalised and tokenised once, for the fit and the prediction
    labels = inputs.table(spark, sf_dir, "labels")
    labelled = docs.join(labels.select("doc_id", F.col("quality").cast("string").alias("label")), "doc_id")
    index = _label_index(labelled)
    train = kl.bucket_labels(labelled, index, kl.TOP_LABELS).where(kl.split_column(F.col("doc_id")) == "train")
    model = kl.fit_classifier(kl.text_classifier(counted=True), train, kl.class_weights(index))
    return kl.predict_labels(model, docs, index).select("doc_id", "predicted", "confidence")


@entry
def softmax_argmax(spark, sf_dir):
    rows = inputs.vectors(spark, sf_dir).select("doc_id", F.col("vec").alias("logits"))
    return kl.classify_logits(rows).select("doc_id", "label_id", _r("confidence").alias("confidence"))


@entry
def classification_metrics(spark, sf_dir):
    """Metrics of the rule 'longer than average means good' per part of the split."""
    docs, labels = inputs.table(spark, sf_dir, "documents"), inputs.table(spark, sf_dir, "labels")
    mean = docs.agg(F.avg("n_chars")).scalar()
    predicted = docs.select("doc_id", (F.col("n_chars") > mean).cast("int").alias("predicted_id"))
    truth = labels.select("doc_id", F.col("quality").alias("label_id"), kl.split_column(F.col("doc_id")).alias("split"))
    metrics = kl.classification_metrics(predicted.join(truth, "doc_id"))
    return metrics.select("split", "rows", _r("accuracy").alias("accuracy"), _r("f1_micro").alias("f1_micro"))


# ---------------------------------------------------------------- entity graph


def _lines_and_entities(spark, sf_dir):
    lines = inputs.numbered_lines(spark, sf_dir)
    return lines, inputs.entities(lines)


def _named(rows, entities, pairs):
    """Replace entity ids by their regex text: ``pairs`` maps id column to new column."""
    names = entities.select("entity_id", "regex")
    known = names.count()
    for column, name in pairs.items():
        renamed = names.select(F.col("entity_id").alias(column), F.col("regex").alias(name))
        rows = measured_join(rows, renamed, [column], rows=known).drop(column)
    return rows


@entry
def entity_mentions(spark, sf_dir):
    lines, entities = _lines_and_entities(spark, sf_dir)
    mentions = gr.entity_mentions(lines, entities)
    return _named(mentions, entities, {"entity_id": "element"}).select("seq", "element")


@entry
def entity_support(spark, sf_dir):
    """Support of the entities found in at least 5 texts."""
    lines, entities = _lines_and_entities(spark, sf_dir)
    mentions = gr.with_support(cut(gr.entity_mentions(lines, entities)), 5)
    return _named(gr.entity_support(mentions), entities, {"entity_id": "element"}).select("element", "support")


def _counts(spark, sf_dir, window=PERSON_WINDOW, kind=None):
    lines, entities = _lines_and_entities(spark, sf_dir)
    if kind:
        entities = entities.where(F.col("type") == kind)
    return gr.entity_graph(lines, entities, window), entities


@entry
def cooccurrence(spark, sf_dir):
    counts, entities = _counts(spark, sf_dir)
    return _named(counts, entities, {"src": "element", "dst": "other"}).select("element", "other", "shared")


@entry
def adjacency(spark, sf_dir):
    counts, entities = _counts(spark, sf_dir, PLACE_WINDOW)
    return _named(gr.adjacency(counts), entities, {"src": "element", "dst": "other"}).select("element", "other")


@entry
def pagerank(spark, sf_dir):
    counts, entities = _counts(spark, sf_dir)
    ranks = gr.pagerank(gr.adjacency(counts), tolerance=RANK_TOLERANCE)
    return _named(ranks, entities, {"node": "element"}).select("element", _r("rank", 8).alias("rank"))


@entry
def hits(spark, sf_dir):
    counts, entities = _counts(spark, sf_dir)
    ranks = gr.hits(gr.adjacency(counts), tolerance=RANK_TOLERANCE)
    named = _named(ranks, entities, {"node": "element"})
    return named.select("element", _r("hubs", 8).alias("hubs"), _r("authorities", 8).alias("authorities"))


def _ranks(counts, entities):
    edges = gr.adjacency(counts)
    ranks = gr.entity_ranks(
        entities, gr.pagerank(edges, tolerance=RANK_TOLERANCE), gr.hits(edges, tolerance=RANK_TOLERANCE)
    )
    rounded = {c: _r(c, 8) for c in ("rank", "hubs", "authorities")}
    return cut(ranks.withColumns(rounded))


@entry
def entity_ranks(spark, sf_dir):
    ranks = _ranks(*_counts(spark, sf_dir))
    return ranks.select("element", "rank", "hubs", "authorities")


@entry
def rank_lookup(spark, sf_dir):
    ranks = gr.rank_lookup(_ranks(*_counts(spark, sf_dir)), "ti|re")
    return ranks.select("element", "rank", "hubs")


@entry
def query_entities(spark, sf_dir):
    ranks = _ranks(*_counts(spark, sf_dir))
    found = gr.query_entities(inputs.utterances(spark, sf_dir), ranks, F.lower("text"))
    return found.select("query_id", "position", "name", "rank", "hubs")


@entry
def query_entities_typed(spark, sf_dir):
    lines, entities = _lines_and_entities(spark, sf_dir)
    mentions = cut(gr.entity_mentions(lines, entities))
    ranks = {}
    for kind, window in (("person", PERSON_WINDOW), ("place", PLACE_WINDOW)):
        chosen = entities.where(F.col("type") == kind)
        own = mentions.join(F.broadcast(chosen.select("entity_id")), "entity_id")
        ranks[kind] = _ranks(cut(gr.cooccurrence(own, window)), chosen)
    found = gr.typed_query_entities(inputs.utterances(spark, sf_dir), ranks, F.lower("text"))
    return found.select("query_id", "type", "position", "name", "rank", "hubs")


@entry
def close_entities(spark, sf_dir):
    """The five closest entities of each; ids follow regex order, so ties do as well."""
    counts, entities = _counts(spark, sf_dir)
    close = gr.close_entities(counts, 5)
    return _named(close, entities, {"src": "element", "dst": "other"}).select("element", "rank", "other", "shared")


# ---------------------------------------------------------------- composites


@entry
def retrieve(spark, sf_dir):
    """Hit lists by method as the response carries them, flattened for comparison."""
    lists = ss.hits_by_method(_all_hits(spark, sf_dir))
    methods = lists.select("query_id", F.explode("results").alias("method", "_hits"))
    flat = methods.select("query_id", "method", F.explode("_hits").alias("_h"))
    return flat.select("query_id", "method", "_h.rank", "_h.doc_id", "_h.label", "_h.half1", "_h.half2", "_h.score")


@entry
def retrieve_response(spark, sf_dir):
    """Whole response per query, as one nested row, from an index built on the documents."""
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    lines, entities = _lines_and_entities(spark, sf_dir)
    index = build_index(
        spark,
        scratch_path(spark, "index"),
        docs,
        mentions_in=lines,
        entities=entities,
        word_vectors=inputs.word_vectors,
        dimension=inputs.WORD_DIMENSION,
        stop_words=_stop_words(docs),
    )
    return answer_queries(index, queries)


@entry
def score_query_stream(spark, sf_dir):
    """Benchmark texts arriving as a file stream, each batch answered by tf-idf search of stored weights."""
    docs = inputs.documents(spark, sf_dir)
    terms = _terms(docs)
    vocab = ss.fit_vocabulary(docs, terms)
    source = spark.readStream.schema("item_id long, text string").option("pathGlobFilter", "benchmark.parquet")
    arrivals = source.parquet(sf_dir).select(F.col("item_id").alias("query_id"), "text")
    weights = store(ps.tfidf_weights(docs, terms, vocab).select("doc_id", "term", "w"), "weights")

    def answer(batch: DataFrame) -> DataFrame:
        return ss.score_topk(weights, ps.tfidf_weights(batch, terms, vocab, "query_id"), ss.VECTOR_LIMIT)

    answers = answer_arrivals(arrivals, answer)
    return answers.select("query_id", "rank", "doc_id", "score")
