"""Term counts, vocabularies and weights, all in long form: one row per document and term.

Documents are shuffled once, by id, as raw text. Every later step that works per document or per
(document, term) finds its rows together already, so it needs no further exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions import text as tx
from textlens.operators import counted as cn
from textlens.operators.rows import unnest
from textlens.session import store

# Fixed value: number of vocabulary terms kept.
VOCABULARY_SIZE = 10_000

# Bytes of text whose terms are counted in one task. A text of n words has up to 2 n terms, each an
# entry of some 130 bytes in the task's hash table, so a task holds some 350 MB at most.
TASK_BYTES = 8 << 20

# Vocabularies beyond this many terms are refused: their terms are broadcast.
LARGEST_VOCABULARY = 1_000_000


@dataclass(frozen=True)
class Terms:
    """How a text becomes terms: ``tokens`` of the text, then ``runs`` of the tokens.

    The two are computed as columns of their own, so several uses of the tokens share one
    evaluation. ``span`` says that the runs are :func:`~textlens.functions.text.word_ngrams` of
    tokens without spaces, from the first length to the second; then ``tokens`` are :func:`~textlens.functions.text.index_tokens`
    without the ``dropped`` ones.
    """

    tokens: Callable[[Column], Column] = tx.index_tokens
    runs: Callable[[Column], Column] | None = None
    span: tuple[int, int] | None = None
    dropped: tuple[str, ...] = ()


def index_terms(stop_words: Sequence[str] = (), low: int = 1, high: int = 2) -> Terms:
    """Terms of the vectoriser: tokens, stop words removed, then runs of ``low``..``high`` tokens."""
    return Terms(
        lambda text: tx.drop_stop_words(tx.index_tokens(text), stop_words),
        lambda tokens: tx.word_ngrams(tokens, low, high),
        (low, high),
        tuple(stop_words),
    )


FULLTEXT = Terms(tx.fulltext_tokens)


def spread_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` shuffled by key into as many partitions as the measured bytes of text ask for.

    Spark's own choice follows the bytes shuffled, but a text's terms take many times its size, so
    the memory of a task would grow with the corpus. Little text is left to Spark.
    """
    rows = docs.select(key, text)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = -(-size // TASK_BYTES)
    if parts <= 1:
        return rows.repartition(key)
    return rows.repartition(max(parts, docs.sparkSession.sparkContext.defaultParallelism), key)


def term_counts(
    docs: DataFrame,
    terms: Terms,
    key: str = "doc_id",
    text: str = "text",
    length: str | None = None,
    within: DataFrame | None = None,
) -> DataFrame:
    """``(key, term, tf)`` of all terms (T10); ``length`` names a column for the number of tokens.

    ``within`` is a capped vocabulary ``(term, ...)``: its terms only, with its other columns. It
    is applied before counting, so most rows never reach the aggregation.
    """
    spread = spread_texts(docs, key, text)
    listed = spread.select(key, terms.tokens(F.col(text)).alias("_tokens"))
    kept = [key]
    if length:
        listed = listed.withColumn(length, F.size("_tokens").cast("long"))
        kept.append(length)
    runs = F.col("_tokens") if terms.runs is None else terms.runs(F.col("_tokens"))
    rows = unnest(listed, runs, "term")
    if within is not None:
        rows = rows.join(F.broadcast(within), "term")
        kept.extend(c for c in within.columns if c != "term")
    return rows.groupBy(*kept, "term").agg(F.count("*").alias("tf"))


def _check_size(size: int | None) -> None:
    if size is not None and not 0 < size <= LARGEST_VOCABULARY:
        raise ValueError(f"vocabulary size must lie between 1 and {LARGEST_VOCABULARY}")


def vocabulary(counts: DataFrame, size: int | None = VOCABULARY_SIZE) -> DataFrame:
    """``(term, tf_total, df)``; with ``size``, the terms of greatest corpus frequency.

    Ties go to the smaller term. Counts per document make the input of this step, so a frequent
    word reaches its reducer as one partial sum per task.
    """
    _check_size(size)
    totals = counts.groupBy("term").agg(F.sum("tf").alias("tf_total"), F.count("*").alias("df"))
    return totals if size is None else totals.orderBy(F.desc("tf_total"), "term").limit(size)


def listed_terms(
    docs: DataFrame, terms: Terms, key: str = "doc_id", text: str = "text", by_length: bool = False
) -> tuple[DataFrame, dict]:
    """``(key, tokens)`` placed and sorted for :mod:`~textlens.operators.counted`, and how its lexicons read them.

    Where the terms are neither tokens nor tokens and their pairs, each term is given as a token.
    """
    listed, how = terms.tokens(F.col(text)), {}
    if terms.span in ((1, 1), (1, 2)):
        listed, how = tx.index_tokens(F.col(text)), {"pairs": terms.span == (1, 2), "dropped": terms.dropped}
    elif terms.runs is not None:
        listed = terms.runs(listed)
    return cn.placed_tokens(spread_texts(docs, key, text), listed, key, by_length), how


def index_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored ``(term, tf_total, df, texts)`` of all tokens of the vectoriser; ``texts`` counts rows, ``df`` keys."""
    return store(cn.word_totals(listed_terms(docs, Terms(tx.index_tokens), key, text)[0]), "index-words")


def corpus_vocabulary(
    docs: DataFrame,
    terms: Terms,
    size: int | None = VOCABULARY_SIZE,
    key: str = "doc_id",
    text: str = "text",
    words: DataFrame | None = None,
) -> DataFrame:
    """:func:`vocabulary` of the :func:`term_counts` of ``docs``, counted in batches.

    No pair of tokens is more frequent than either of them. So with ``size`` only pairs of tokens as
    frequent as the last of the ``size`` most frequent tokens are counted; no other can be kept.
    ``words`` are the :func:`index_words` of ``docs``, if they are there already.
    """
    _check_size(size)
    pairs = terms.span == (1, 2)
    if size is None and pairs:
        return vocabulary(term_counts(docs, terms, key, text), size)
    tokens, how = listed_terms(docs, terms, key, text)
    dropped = how.get("dropped", ())
    totals = cn.word_totals(tokens) if words is None or not how else words
    totals = totals.where(~F.col("term").isin(*dropped)) if dropped else totals
    totals = totals.select("term", "tf_total", "df")
    if pairs:
        totals = store(totals, "word-totals")
        counts = totals.orderBy(F.desc("tf_total")).limit(size).agg(F.count("*").alias("n"), F.min("tf_total").alias("least")).first()
        least = counts["least"] if counts["n"] == size else 1
        totals = totals.where(F.col("tf_total") >= F.lit(least))
        if totals.count() > LARGEST_VOCABULARY:
            return vocabulary(term_counts(docs, terms, key, text), size)
        known = totals.select("term").orderBy("term").toArrow().column("term").combine_chunks()
        found = cn.pair_totals(tokens, known, dropped).where(F.col("tf_total") >= F.lit(least))
        names = docs.sparkSession.createDataFrame(pa.table({"place": pa.array(range(len(known)), pa.int64()), "name": known}))
        left, right = (names.select(F.col("place").alias(f"_{n}"), F.col("name").alias(n)) for n in ("a", "b"))
        base = max(len(known), 1)
        named = found.withColumns({"_a": F.expr(f"pair div {base}"), "_b": F.expr(f"pair % {base}")})
        named = named.join(F.broadcast(left), "_a").join(F.broadcast(right), "_b")
        totals = totals.unionByName(named.select(F.concat_ws(" ", "a", "b").alias("term"), "tf_total", "df"))
    return totals if size is None else totals.orderBy(F.desc("tf_total"), "term").limit(size)


def top_terms(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """The ``n`` tokens found in most documents: a stop-word list drawn from the corpus, or from its :func:`index_words`."""
    words = cn.row_totals(docs, tx.index_tokens(F.col(text))) if words is None else words
    frequencies = words.select("term", F.col("texts").alias("df"))
    return frequencies.orderBy(F.desc("df"), "term").limit(n)


def document_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery."""
    return docs.agg(F.count("*")).scalar()


def smoothed_idf(vocab: DataFrame, documents: Column) -> DataFrame:
    """Add ``idf = ln((1 + n) / (1 + df)) + 1``."""
    return vocab.withColumn("idf", F.log((1 + documents) / (1 + F.col("df"))) + 1)


def tfidf_weights(
    docs: DataFrame, terms: Terms, vocab_idf: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, term, tf, w)`` with sublinear tf times idf, unit length per document."""
    counts = term_counts(docs, terms, key, text, within=vocab_idf.select("term", "idf"))
    raw = counts.select(key, "term", "tf", ((1 + F.log("tf")) * F.col("idf")).alias("_raw"))
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return raw.withColumn("w", F.col("_raw") / length).drop("_raw")


def document_weights(docs: DataFrame, terms: Terms, vocab_idf: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, term, tf, w, flag_w)``: the weights of :func:`tfidf_weights` and :func:`boolean_weights`, made in batches."""
    known = vocab_idf.select("term", "idf")
    if known.count() > LARGEST_VOCABULARY:
        flagged = F.sqrt(F.count("*").over(Window.partitionBy(key)))
        return tfidf_weights(docs, terms, vocab_idf, key, text).withColumn("flag_w", 1 / flagged)
    table = known.toArrow()
    listed, how = listed_terms(docs, terms, key, text)
    names = table.column("term").combine_chunks()
    weights = {"w": cn.tfidf_of(table.column("idf").to_numpy()), "flag_w": cn.boolean_of()}
    rows = cn.weight_rows(listed, names, cn.Lexicon(names, **how), weights, docs.schema[key].dataType.simpleString())
    return rows.withColumnRenamed("key", key)


def fulltext_postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, dl, term, tf)`` as :func:`term_counts` gives with the length ``dl``, made in batches."""
    listed, _ = listed_terms(docs, FULLTEXT, key, text, by_length=True)
    rows = cn.term_rows(listed, docs.schema[key].dataType.simpleString())
    return rows.select(F.col("key").alias(key), F.col("length").alias("dl"), "term", "tf")


def boolean_weights(
    docs: DataFrame, terms: Terms, vocab: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, term, tf, w)`` of the 0/1 vector, unit length per document."""
    counts = term_counts(docs, terms, key, text, within=vocab.select("term"))
    terms_found = F.count("*").over(Window.partitionBy(key))
    return counts.select(key, "term", "tf", (1 / F.sqrt(terms_found)).alias("w"))


def bm25_weights(counts: DataFrame, mean_length: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Saturated term frequency ``tf / (tf + k1 (1 - b + b dl / avgdl))`` as ``w`` (F2).

    ``counts`` carries ``dl``. The idf factor belongs to the query side of the product.
    """
    damp = k1 * ((1 - b) + b * F.col("dl") / mean_length)
    return counts.withColumn("w", F.col("tf") / (F.col("tf") + damp))


def bm25_idf(df: Column, documents: Column) -> Column:
    """``ln(1 + (n - df + 0.5) / (df + 0.5))``."""
    return F.log(1 + (documents - df + 0.5) / (df + 0.5))


def word_counts(rows: DataFrame, texts: Sequence[str] = ("half1", "half2")) -> DataFrame:
    """``(word, count)`` of the whitespace tokens of the given columns."""
    tokens = F.flatten(F.array(*[F.coalesce(tx.whitespace_tokens(F.col(c)), F.array()) for c in texts]))
    return cn.row_totals(rows, tokens).select(F.col("term").alias("word"), F.col("tf_total").alias("count"))
