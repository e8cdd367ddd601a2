"""Corpora: HTML pages, couplet CSV files, entity dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textlens.operators.graph import distinct_entities

CORPUS_SCHEMA = StructType([StructField("text", StringType()), StructField("labels", StringType())])

_CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, html)``: one row per UTF-8 file, identified by its path."""
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.col("_metadata.file_path").alias("page_id"), F.col("value").alias("html"))


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(text, label)`` of a couplet CSV with header ``text,labels``."""
    return spark.read.schema(CORPUS_SCHEMA).options(**_CSV_OPTIONS).csv(path).withColumnRenamed("labels", "label")


def write_corpus_csv(couplets: DataFrame, path: str) -> None:
    """Write ``text`` and ``label`` as a CSV folder."""
    rows = couplets.select("text", F.col("label").alias("labels"))
    rows.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def read_entities(spark: SparkSession, path: str, column: str, kind: str) -> DataFrame:
    """``(entity_id, regex, type)`` from one column of a CSV dictionary (S3).

    Values are kept as given, trailing spaces included; equal regexes become one entity.
    """
    options = {**_CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = spark.read.options(**options).csv(path).where(F.col(column).isNotNull())
    return distinct_entities(rows.select(F.col(column).alias("regex"), F.lit(kind).alias("type")))
