"""Ranked search over long-form weights: tf-idf, boolean and full-text (Q2-Q4, Q11).

One plan scores a whole table of queries. Query weights are stored, counted and broadcast in
blocks of bounded size, and met with the terms of documents in Arrow batches
(:mod:`~textlens.operators.counted`), inside the tasks that already hold the document. Each task keeps its best ``k``
per query, so only ``tasks x queries x k`` rows are shuffled and a frequent term causes no
exchange at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.functions.text import split_halves
from textlens.operators import counted as cn
from textlens.operators import postings as ps
from textlens.operators.fuzzy import fuzzy_expand
from textlens.operators.joins import BROADCAST_ROWS, measured_join, top_per_key
from textlens.session import cut, cut_counted, store

# Result limits of the vector methods and of the full-text method.
VECTOR_LIMIT = 20
FULLTEXT_LIMIT = 10

# Queries searched together at most; a task holds their scores for some documents at a time.
BLOCK_QUERIES = 4096

# Scores are compared after rounding, so ties do not depend on the order of a distributed sum.
SCORE_DIGITS = 6


def score_topk(
    postings: DataFrame,
    query_weights: DataFrame,
    k: int,
    digits: int = SCORE_DIGITS,
    key: str = "doc_id",
    block_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(query_id, rank, key, score)``: best ``k`` documents by the sum of weight products.

    ``postings`` is ``(key, term, w)``, clustered by ``key``; ``query_weights`` is
    ``(query_id, term, w)``. Only documents that share a term with the query are returned. More
    than ``block_rows`` query weights are split by query into blocks, one pass each.
    """
    spark = postings.sparkSession

    def best(wanted: cn.Wanted, kinds: str) -> DataFrame:
        places = spark.createDataFrame(pa.table({"term": wanted.terms, "_place": pa.array(range(len(wanted.terms)), pa.int32())}))
        met = postings.select(key, "term", "w").join(F.broadcast(places), "term").where("w is not null")
        # a group is the query terms of one document
        lists = met.groupBy(key).agg(F.collect_list(F.struct("_place", F.col("w").cast("double"))).alias("found"))
        return cn.best_postings(lists, wanted, k, digits, kinds)

    return _ranked(query_weights, postings, best, k, digits, key, block_rows)


def _ranked(
    query_weights: DataFrame,
    docs: DataFrame,
    best: Callable[[cn.Wanted, str], DataFrame],
    k: int,
    digits: int,
    key: str,
    block_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The ``k`` best of the rows that ``best`` finds for the query weights, which are taken in blocks by query."""
    stored, rows = cut_counted(query_weights.select("query_id", "term", F.col("w").cast("double").alias("w")).where("w is not null"))
    queries = stored.select("query_id").distinct().count() if rows > BLOCK_QUERIES else rows
    blocks = max(1, -(-rows // block_rows), -(-queries // BLOCK_QUERIES))
    kinds = f"query_id {stored.schema['query_id'].dataType.simpleString()}, key {docs.schema[key].dataType.simpleString()}, _sum double"
    hits = None
    for number in range(blocks):
        block = stored if blocks == 1 else stored.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number)
        scores = best(cn.Wanted(block.toArrow()), kinds)
        rounded = scores.select("query_id", F.col("key").alias(key), F.round("_sum", digits).alias("score"))
        top = top_per_key(rounded, ["query_id"], [F.desc("score"), F.asc(key)], k)
        hits = top if hits is None else hits.unionByName(top)
    return hits.select("query_id", "rank", key, "score")


def fit_vocabulary(
    docs: DataFrame, terms: ps.Terms, size: int | None = ps.VOCABULARY_SIZE, key: str = "doc_id", words: DataFrame | None = None
) -> DataFrame:
    """Stored vocabulary ``(term, tf_total, df, idf)`` of a corpus, at most ``size`` terms, or all.

    ``words`` are its :func:`~textlens.operators.postings.index_words`, if they are there already.
    """
    return cut(ps.smoothed_idf(ps.corpus_vocabulary(docs, terms, size, key, words=words), ps.document_count(docs)))


def cosine_search(
    queries: DataFrame,
    docs: DataFrame,
    vocab: DataFrame,
    terms: ps.Terms,
    weigh: Callable[..., DataFrame] = ps.tfidf_weights,
    k: int = VECTOR_LIMIT,
    digits: int = SCORE_DIGITS,
    key: str = "doc_id",
) -> DataFrame:
    """Cosine of query and document vectors; both have unit length, so it is their inner product.

    ``weigh`` is :func:`~textlens.operators.postings.tfidf_weights` (Q3) or
    :func:`~textlens.operators.postings.boolean_weights` (Q4).
    """
    wanted = weigh(queries, terms, vocab, "query_id")
    if weigh not in (ps.tfidf_weights, ps.boolean_weights) or vocab.count() > ps.LARGEST_VOCABULARY:
        return score_topk(weigh(docs, terms, vocab, key), wanted, k, digits, key)
    if weigh is ps.tfidf_weights:
        known = vocab.select("term", "idf").toArrow()
        weights = cn.tfidf_of(known.column("idf").to_numpy())
    else:
        known, weights = vocab.select("term").toArrow(), cn.boolean_of()
    listed, how = ps.listed_terms(docs, terms, key)
    words = known.column("term").combine_chunks()
    lexicon = cn.Lexicon(words, **how)

    def best(asked: cn.Wanted, kinds: str) -> DataFrame:
        return cn.best_documents(listed, lexicon, weights, asked.over(words), k, digits, kinds)

    return _ranked(wanted, docs, best, k, digits, key)


def tfidf_search(
    queries: DataFrame, docs: DataFrame, terms: ps.Terms, size: int | None = ps.VOCABULARY_SIZE, **options
) -> DataFrame:
    """tf-idf search, vocabulary fitted on ``docs``."""
    return cosine_search(queries, docs, fit_vocabulary(docs, terms, size), terms, ps.tfidf_weights, **options)


def boolean_search(
    queries: DataFrame, docs: DataFrame, terms: ps.Terms, size: int | None = ps.VOCABULARY_SIZE, **options
) -> DataFrame:
    """Search by 0/1 vectors, vocabulary fitted on ``docs``."""
    return cosine_search(queries, docs, fit_vocabulary(docs, terms, size), terms, ps.boolean_weights, **options)


def fulltext_vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored ``(term, tf_total, df)`` of all full-text words."""
    return store(ps.corpus_vocabulary(docs, ps.FULLTEXT, None, key, text), "lexicon")


def fulltext_search(
    queries: DataFrame,
    docs: DataFrame,
    fuzzy: bool = True,
    metric: str = "alignment",
    k: int = FULLTEXT_LIMIT,
    digits: int = SCORE_DIGITS,
    key: str = "doc_id",
    vocab: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """BM25 over any query word, each expanded to similar index words when ``fuzzy`` (Q11).

    A word's expansions share the idf of the most frequent of them and are weighted by closeness.
    ``vocab`` and ``counts`` are taken from an index if there is one.
    """
    vocab = fulltext_vocabulary(docs, key) if vocab is None else vocab
    documents = docs.count()
    tokens = vocab.agg(F.sum("tf_total")).first()[0] or 0
    words = ps.term_counts(queries, ps.FULLTEXT, "query_id").withColumnRenamed("term", "word")
    words = cut(words.withColumnRenamed("tf", "n"))
    mean_length = tokens / max(documents, 1)
    if fuzzy:
        known = vocab.select(F.col("term").alias("word"), F.col("tf_total").alias("count"), "df")
        expansions = fuzzy_expand(words.select("word").distinct(), known, metric=metric)
    else:
        exact = measured_join(vocab, words.select(F.col("word").alias("term")).distinct(), ["term"])
        expansions = exact.select("term", F.col("term").alias("match"), F.lit(0).alias("edits"), "df")
    wanted = fulltext_query_weights(words, cut(expansions), documents)
    if counts is not None:
        return score_topk(ps.bm25_weights(counts, mean_length), wanted, k, digits, key)
    # texts of one key but other lengths are weighed by themselves, as in stored counts
    listed, _ = ps.listed_terms(docs, ps.FULLTEXT, key, by_length=True)

    def best(asked: cn.Wanted, kinds: str) -> DataFrame:
        return cn.best_documents(listed, cn.Lexicon(asked.terms), cn.bm25_of(mean_length), asked, k, digits, kinds, by_length=True)

    return _ranked(wanted, docs, best, k, digits, key)


def fulltext_query_weights(words: DataFrame, expansions: DataFrame, documents: int) -> DataFrame:
    """``(query_id, term, w)`` from ``(query_id, word, n)`` and ``(term, match, edits, df)``.

    A match weighs ``n * (1 - edits / shorter length) * idf(greatest df among the word's matches)``.
    """
    greatest = expansions.groupBy("term").agg(F.max("df").alias("_df"))
    closeness = 1 - F.col("edits") / F.least(F.length("term"), F.length("match"))
    boosts = expansions.drop("df").join(greatest, "term").select(
        F.col("term").alias("word"),
        F.col("match").alias("term"),
        (closeness * ps.bm25_idf(F.col("_df"), F.lit(documents))).alias("_boost"),
    )
    return measured_join(words, boosts, ["word"]).groupBy("query_id", "term").agg(F.sum(F.col("n") * F.col("_boost")).alias("w"))


def attach_documents(hits: DataFrame, docs: DataFrame, columns: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Add document columns to the hits (Q8). Hits are stored and counted before they are broadcast."""
    return measured_join(docs.select(key, *columns), hits, [key])


def attach_couplets(hits: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Hits with the document's label and the two halves of its text, which is what a reader sees (Q8)."""
    found = attach_documents(hits, docs, ["label", "text"], key)
    halves = {f"half{n}": split_halves(F.col("text"), n) for n in (1, 2)}
    return found.withColumns(halves).drop("text")


def merge_topk(partial_hits: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """Best ``k`` per query of hit lists from several batches (Q7); documents are keys, not offsets."""
    return top_per_key(partial_hits.drop("rank"), ["query_id"], [F.desc("score"), F.asc(key)], k)


def unite_methods(hits: dict[str, DataFrame]) -> DataFrame:
    """One table of hits, each row naming its method (Q12)."""
    out = None
    for method, rows in hits.items():
        tagged = rows.withColumn("method", F.lit(method))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def hits_by_method(hits: DataFrame) -> DataFrame:
    """``(query_id, results)`` with ``results`` a map from method to its hits in rank order.

    A list holds at most ``k`` hits and there are as many lists as methods, so groups are bounded.
    """
    fields = [c for c in hits.columns if c not in ("query_id", "method")]
    ordered = ["rank", *[c for c in fields if c != "rank"]]
    lists = hits.groupBy("query_id", "method").agg(F.array_sort(F.collect_list(F.struct(*ordered))).alias("_hits"))
    return lists.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("method", "_hits"))).alias("results")
    )
