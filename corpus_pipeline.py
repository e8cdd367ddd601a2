"""Five stages from raw documents to packed sequences.

Each stage takes the documents that the stage before has kept, written as Parquet and read again, and
calls one operator of :mod:`textlens.llm`. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm import language, mixing, near, packing, suffixes
from textlens.llm.queries import CONTEXT, LANGUAGES, op2_rows, tokenizer_path
from textlens.session import delete_path, scratch_path, scratch_paths, small_arrow_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


_spent: list[str] = []


def _reads_from(docs: DataFrame, paths: list[str]) -> bool:
    """Whether ``docs`` still reads a file under one of ``paths``."""
    try:
        files = docs.inputFiles()
    except Exception:  # a plan without files of its own
        return True
    return any(f.startswith(p.rstrip("/") + "/") or f == p for f in files for p in paths)


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that deletes the scratch tables of the stage called before, once nothing it is given reads them.

    A caller that passes on a result not yet written keeps those tables. :func:`run` deletes its own
    scratch tables itself, stage by stage.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _spent and not _reads_from(docs, _spent):
            for path in _spent:
                delete_path(spark, path)
            _spent.clear()
        small_arrow_batches(spark)  # and it stays so, as the result is not yet computed
        with scratch_paths() as made:
            result = function(spark, docs, sf_dir)
        _spent.extend(made)
        return result

    return run_stage


@_stage
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; the rest go. The text model is fitted on the labels of ``docs``."""
    table = language.fit_trigrams(docs, LANGUAGES)
    rows = language.document_rows(docs).select(*COLUMNS, F.col("text").alias("_text"), *CONTEXT)
    found = language.identify_languages(rows, table, LANGUAGES, text="_text")
    return _documents(found.where("accepted"))


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of the least id."""
    return _documents(near.keep_one_of_each(docs))


@_stage
def without_earlier_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of earlier documents; ``n_chars`` counts what stays.

    A character that loses some of its bytes goes as a whole. A text that loses everything stays as an empty one.
    """
    rows = _documents(docs)
    return _documents(suffixes.remove_earlier_strings(rows, then=suffixes.kept_texts, shape=rows.schema))


@_stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target shares of their sources, in random order."""
    return _documents(mixing.poisson_mix(docs))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1,024 tokens."""
    return op2_rows(packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("near_dedup", without_near_copies),
    ("suffix_dedup", without_earlier_strings),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# The stages sample, hash and tokenize by rules that SQL has no words for; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    A stage's scratch tables go once its result is written, and a stage's result once the next one's is;
    the last result stays, as it is returned.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        with scratch_paths() as made:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
        for spent in made:
            if spent != path and spent in _spent:
                _spent.remove(spent)
            if spent != path:
                delete_path(spark, spent)
        if before is not None:
            delete_path(spark, before)
        before, docs = path, spark.read.parquet(path)
    return docs
