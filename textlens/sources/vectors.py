"""Word vectors in the word2vec text format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vec)`` from lines ``word v1 v2 ...``; the ``count dimension`` header line is dropped.

    A header has two fields and a vector line at least three, so any part of a split file can tell
    them apart.
    """
    parts = spark.read.text(path).select(F.split(F.trim("value"), " +").alias("_p"))
    vectors = parts.where(F.size("_p") > 2)
    numbers = F.slice("_p", F.lit(2), F.size("_p") - 1)
    return vectors.select(F.get("_p", F.lit(0)).alias("word"), numbers.cast("array<float>").alias("vec"))


def write_word_vectors(vectors: DataFrame, path: str) -> None:
    """Write ``(word, vec)`` as text lines in the same format, without a header."""
    numbers = F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")
    vectors.select(F.concat_ws(" ", "word", numbers).alias("value")).write.mode("overwrite").text(path)
