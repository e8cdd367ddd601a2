"""Removal of repeated lines or paragraphs: each distinct unit stays where it first occurs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.operators.joins import measured_join

SEPARATORS = {"line": "\n", "paragraph": "\n\n"}

# Letters of scripts without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def normal_unit(unit: Column) -> Column:
    """Lower case, with every run of other characters than letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))


def _word_count(unit: Column) -> Column:
    """Words of a normal unit; in scripts that put no spaces between words every character is one."""
    return F.size(F.split(unit, " ")) + F.length(unit) - F.length(F.regexp_replace(unit, UNSPACED, ""))


def _kept(key: str, separator: str):
    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                units = row.text.split(separator) if row.text is not None else []
                gone = set(row.gone) if row.gone is not None else set()
                kept, spans, at = [], [], 0
                for number, unit in enumerate(units):
                    if number in gone:
                        spans.append((at, at + len(unit)))
                    else:
                        kept.append(unit)
                    at += len(unit) + len(separator)
                text = separator.join(kept) if row.text is not None else None
                out.append((row.key, text, len(units), len(spans), [s for s, _ in spans], [e for _, e in spans]))
            names = ["key", "text", "n_units", "n_removed", "removed_starts", "removed_ends"]
            yield pd.DataFrame(out, columns=names).rename(columns={"key": key})

    return rebuild


def drop_repeated_units(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line", min_words: int = 1
) -> DataFrame:
    """Documents without the units that occurred before, with the original offsets of what is gone.

    ``unit`` is ``line`` or ``paragraph``. Units are compared by the md5 of :func:`normal_unit`.
    Occurrences rank by ``key`` (null last), then by position; the first of each digest stays,
    the others go, also those within one document. Units without letters and digits always stay; every
    other unit is compared, unless a caller asks for ``min_words`` above 1 (an option, off by default). Returns ``(key, text, n_units, n_removed,
    removed_starts, removed_ends)``, one row per row of ``docs``: offsets count characters of the
    original text from 0, ends exclusive, without the separator; the units that stay are joined by
    the separator. A null text gives a null text and no units, an empty text one empty unit. Rows that
    share a key are the same place: a unit that is first there stays in each of them. Other
    columns are not looked at, and an empty table gives an empty one.

    Digests meet in two steps: first ranks are aggregated (partly before the shuffle), then the
    digests that repeat are stored, counted and joined back, broadcast while they are few and salted beyond.
    Texts move once, at the end.
    """
    separator = SEPARATORS[unit]
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    source = source.withColumn("version", F.xxhash64("text"))
    units = source.select("key", "version", F.posexplode(F.split("text", separator)).alias("pos", "unit"))
    units = units.withColumn("unit", normal_unit(F.col("unit")))
    compared = F.col("unit") != ""
    if min_words > 1:
        compared = compared & (_word_count(F.col("unit")) >= min_words)
    digest = F.unhex(F.md5(F.col("unit")))
    rank = F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key"), F.col("pos").alias("pos"))
    marked = units.where(compared).select("key", "version", "pos", digest.alias("digest"))
    first = marked.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("final")).where("first != final")
    later = measured_join(marked, first.select("digest", "first"), ["digest"]).where(rank != F.col("first"))
    gone = later.groupBy(F.col("key").alias("at"), F.col("version").alias("of")).agg(F.collect_set("pos").alias("gone"))
    met = source.join(gone, source["key"].eqNullSafe(gone["at"]) & (source["version"] == gone["of"]), "left")
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, text string, n_units int, n_removed int"
    schema += ", removed_starts array<int>, removed_ends array<int>"
    return met.select("key", "text", "gone").mapInPandas(_kept(key, separator), schema)
