"""The given tables in the roles the operators expect, and tables derived from them.

Each derived table is computed by Spark from whole tables; ``oracles`` derives the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.text import index_tokens
from textlens.operators import postings as ps
from textlens.operators.cluster import mean_vectors
from textlens.operators.graph import distinct_entities
from textlens.operators.ordering import dense_index
from textlens.operators.rows import unnest
from textlens.session import cut

DIMENSION = 64
WORD_DIMENSION = 8
STOP_WORDS = 25
NAME_STEM = 6
NAME_LENGTH = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus ``(doc_id, text, label)``; the source of a document is its label."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("label"))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as queries; ``query_id`` is conversation times 1000 plus turn."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"), F.col("label"))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed centroids: the mean vector of every label."""
    return mean_vectors(vectors(spark, sf_dir), "label", DIMENSION)


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents as ``(doc_id, pos, text, label)``."""
    docs = documents(spark, sf_dir).withColumnRenamed("text", "_text")
    return unnest(docs, F.split("_text", "\n"), "text", "pos").drop("_text")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, text)``: the text axis of the entity graph, stored; entity names match in lower case."""
    lines = fragments(spark, sf_dir).select("doc_id", "pos", F.lower("text").alias("text"))
    return dense_index(lines, ["doc_id", "pos"]).select("seq", "text")


def entities(lines: DataFrame) -> DataFrame:
    """Dictionary drawn from the lines: words of medium frequency, grouped by stem.

    A word has at least 8 characters and occurs in 0.05 to 0.1 times the square root of the number
    of lines, at least 2. Words with the same first 6 characters are alternatives of one entity. The type is taken from a
    hash of the stem.
    """
    stored_lines = lines.count()
    words = ps.Terms(lambda t: F.filter(index_tokens(t), lambda w: F.length(w) >= NAME_LENGTH))
    support = ps.corpus_vocabulary(lines, words, None, "seq")
    low, high = 0.05 * stored_lines**0.5, 0.1 * stored_lines**0.5
    medium = support.where((F.col("df") >= max(low, 2)) & (F.col("df") <= high))
    # a group is the forms of one stem
    stems = medium.groupBy(F.substring("term", 1, NAME_STEM).alias("stem")).agg(
        F.array_join(F.array_sort(F.collect_list("term")), "|").alias("regex")
    )
    kind = F.when(F.substring(F.md5("stem"), 1, 1) < "b", "person").otherwise("place")
    return cut(distinct_entities(stems.select("regex", kind.alias("type"))))


def misspelt(text: Column) -> Column:
    """Every word of 4 or more characters without its second character."""
    return F.regexp_replace(text, r"([\p{L}\p{N}_])[\p{L}\p{N}_]([\p{L}\p{N}_]{2,})", "$1$2")


def word_vectors(vocab: DataFrame) -> DataFrame:
    """Vectors of 8 numbers in [-1, 1] from the md5 of each term."""
    digits = [F.conv(F.substring(F.md5("term"), 4 * i + 1, 4), 16, 10).cast("double") for i in range(WORD_DIMENSION)]
    return vocab.select(F.col("term").alias("word"), F.array(*[d / 32767.5 - 1 for d in digits]).alias("vec"))
