"""Token ids of documents as ORC files in key order, and their reading."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.llm.tokens import encoder
from textlens.session import store

# Ids in one Arrow batch on the way to the writer.
BATCH_IDS = 1_000_000


def _id_lists(ids: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in ids])]).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _encode(path: str, end_id: int, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, shard, place = encoder(path), TaskContext.get().partitionId(), 0
        last = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys, held, size, begin = batch.column(0), [], 0, 0
            for row in range(batch.num_rows):
                held.append(ids_of.encode(batch.column(1)[row].as_py()) + last)
                size += len(held[-1]) // 4
                if size >= BATCH_IDS or row + 1 == batch.num_rows:
                    n = len(held)
                    shards = pa.array(np.full(n, shard, dtype=np.int32))
                    places = pa.array(np.arange(place, place + n, dtype=np.int64))
                    columns = [keys.slice(begin, n), shards, places, _id_lists(held)]
                    yield pa.RecordBatch.from_arrays(columns, [key, "shard", "place", "ids"])
                    place, begin, held, size = place + n, begin + n, [], 0

    return run


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 16 << 20,
    row_group: int = 1_000,
) -> None:
    """Write ``(key, shard, place, ids)`` as ORC: ids run-length encoded, in ascending order of ``key``.

    Rows are range-partitioned and sorted by ``key`` (null first; rows that share a key follow each other in any
    order); ``shard`` numbers the partitions in key order, ``place`` the rows of a shard. Every document ends with
    ``end_id``, so null and empty texts are written as that id alone. Each stripe has a row index of
    ``row_group`` rows and a Bloom filter of the keys, so a reader that looks for keys skips stripes
    and row groups, and stripes are read in parallel. An empty table leaves no rows; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text")).repartitionByRange(key).sortWithinPartitions(key)
    coded = rows.mapInArrow(_encode(tokenizer, end_id, key), f"{key} {kind}, shard int, place long, ids array<int>")
    writer = coded.write.option("compression", "zstd").option("orc.stripe.size", str(stripe_bytes))
    writer = writer.option("orc.row.index.stride", str(row_group)).option("orc.create.index", "true")
    writer.option("orc.bloom.filter.columns", key).option("orc.bloom.filter.fpp", "0.01").orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; a filter on the key reaches the stripe and row-group statistics and Bloom filters."""
    return spark.read.orc(path)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends = lists.offsets.to_numpy()
        values = np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")
        crcs = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        counts, sums = pa.array(np.diff(ends).astype(np.int64)), pa.array(np.array(crcs, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts, sums], [*batch.schema.names[:-1], "n_tokens", "ids_crc32"])


def token_places(written: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of the rows that :func:`read_token_ids` returns.

    ``start`` counts the ids of all documents before: a running sum inside each shard, which is one
    partition of the writer, plus the sum of the shards before, one row per shard.
    """
    kind = written.schema[key].dataType.simpleString()
    names = f"{key} {kind}, shard int, place long, n_tokens long, ids_crc32 long"
    counted = store(written.select(key, "shard", "place", "ids").mapInArrow(_sums, names), "counts")
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = counted.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    ends = rows.groupBy("shard").agg(F.max(F.col("start") + F.col("n_tokens")).alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("begin"))
    placed = rows.join(begins, "shard").withColumn("start", F.col("start") + F.col("begin"))
    return placed.select(key, "start", "n_tokens", "ids_crc32")
