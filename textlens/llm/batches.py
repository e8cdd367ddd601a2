"""Documents in stored batches, and counting of hashed keys over all batches with an answer to each.

A batch is a record batch of whole rows of about the same amount of text. A task takes a batch at a
time, so keys are pre-aggregated per batch before any shuffle: however often a key occurs,
a batch sends it once, and gets one answer.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.session import scratch_path

# Bytes of text in a batch; a longer text is a batch of its own.
BATCH_BYTES = 2 << 20

# Stands for a null key, after all others.
LAST_KEY = np.iinfo(np.int64).max

# Hashed keys that one group of the exchange should hold.
GROUP_KEYS = 500_000


def release() -> None:
    """Give freed memory back: a Python worker lives on between tasks, beside others in its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text; a longer text is a part of its own."""
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(lengths.astype(np.int64)) // size
    edges = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True]) if len(parts) else np.zeros(0, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield batch.slice(a, b - a)


def pack(array: np.ndarray) -> bytes:
    """Compressed bytes of an array; equal bytes of the numbers stand together."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize).T
    data = planes.tobytes()
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def unpack(data: bytes, dtype: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, dtype=dtype)
    plain = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd"), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(plain.reshape(width, -1).T).view(dtype).ravel()


def pack_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def unpack_bytes(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _to_batches(text: str, size_of_batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")

        def flush() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table)
            number += 1
            columns = [pa.array([part * (1 << 32) + number - 1]), pa.array([size]), pa.array([table.num_rows])]
            columns.append(pa.array([sink.getvalue().to_pybytes()], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, ["batch", "n_bytes", "n_rows", "rows"])

        for batch in batches:
            lengths = pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0).to_numpy(zero_copy_only=False)
            begin = 0
            for row in range(batch.num_rows):
                size += int(lengths[row])
                if size >= size_of_batch:
                    held.append(batch.slice(begin, row + 1 - begin))
                    yield flush()
                    begin, held, size = row + 1, [], 0
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield flush()

    return run


def store_batches(docs: DataFrame, text: str, size_of_batch: int = BATCH_BYTES) -> DataFrame:
    """Stored ``(batch, n_bytes, n_rows, rows)``: all columns of ``docs``, as compressed record batches."""
    packed = docs.mapInArrow(_to_batches(text, size_of_batch), "batch long, n_bytes long, n_rows long, rows binary")
    path = scratch_path(docs.sparkSession, "batches")
    packed.write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(packed.schema).parquet(path)


def rows_of(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all().combine_chunks().to_batches()[0]


def keys_of(rows: pa.RecordBatch, key: str) -> np.ndarray:
    """Keys as 64-bit integers, null as :data:`LAST_KEY`."""
    column = rows.column(rows.schema.get_field_index(key)).cast(pa.int64())
    return column.fill_null(LAST_KEY).to_numpy(zero_copy_only=False)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, null as empty, and their offsets."""
    texts = pa.concat_arrays([column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()).fill_null("")])
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def group_bits(entries: float) -> int:
    """Bits of a hash that name its group, so that groups keep one size at any size of the input."""
    return max(3, int(np.ceil(np.log2(max(entries, 1) / GROUP_KEYS))))


def split_groups(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of ascending hashes that occur, and where each begins and ends."""
    groups = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)
    return groups[begins], np.r_[begins, len(groups)]


def _ask(extract: Callable, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes, docs = extract(rows_of(data.as_buffer()))
                groups, edges = split_groups(hashes, bits)
                # 32 bits below the group: a rare mistaken match makes a count too high, never too low
                low = (hashes >> np.uint64(32 - bits)).astype(np.uint32)
                asked, counts = [], []
                for a, b in zip(edges[:-1], edges[1:]):
                    asked.append(pack(np.diff(low[a:b], prepend=np.uint32(0))))
                    counts.append(pack(docs[a:b].astype(np.uint32)))
                columns = [pa.array(groups, pa.int64()), pa.array([number] * len(groups), pa.int64())]
                columns += [pa.array(asked, pa.binary()), pa.array(counts, pa.binary())]
                del hashes, docs, low
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "batch", "asked", "counts"])
        release()

    return run


def _answer(most: int):
    """Sum of the counts of each hash, no greater than ``most``, for every batch that asked."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(x.as_py(), "<u4"), dtype=np.uint32) for x in table.column("asked")]
        ends = np.cumsum([0] + [len(k) for k in keys])
        everything = np.concatenate(keys)
        order = np.argsort(everything, kind="stable")
        ranked = everything[order]
        begins = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        counts = np.concatenate([unpack(x.as_py(), "<u4") for x in table.column("counts")]).astype(np.int64)
        sums = np.minimum(np.add.reduceat(counts[order], begins), most).astype(np.uint32)
        totals = np.empty(len(everything), dtype=np.uint32)
        totals[order] = np.repeat(sums, np.diff(np.r_[begins, len(ranked)]))
        answers = [pack(totals[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"bucket": table.column("bucket"), "batch": table.column("batch"), "answer": pa.array(answers, pa.binary())})

    return run


def count_keys(batches: DataFrame, extract: Callable, entries: float, most: int = 0xFFFFFFFF) -> DataFrame:
    """``(batch, n_bytes, n_rows, rows, answers)``: batches with the total counts of their hashed keys.

    ``extract`` gives a batch's ascending distinct 64-bit hashes and the number of documents that
    hold each; ``entries`` estimates how many a whole run has. ``answers`` lists ``(bucket, answer)``; see :func:`answers_of`.
    Counts above ``most`` are answered as ``most``, which a caller who asks no more than that needs less room for.
    """
    bits = group_bits(entries)
    asked = batches.select("batch", "rows").mapInArrow(_ask(extract, bits), "bucket long, batch long, asked binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(_answer(most), "bucket long, batch long, answer binary")
    return with_answers(batches, answered)


def with_answers(batches: DataFrame, answered: DataFrame) -> DataFrame:
    """Each batch beside its answers; a batch that asked nothing has null."""
    listed = answered.groupBy("batch").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
    return batches.join(listed, "batch", "left")


def answers_of(listed: list | None, dtype: str = "<u4") -> np.ndarray:
    """Answers in the order of the hashes that were asked."""
    if not listed:
        return np.zeros(0, dtype=dtype)
    return np.concatenate([unpack(x["answer"], dtype) for x in sorted(listed, key=lambda x: x["bucket"])])


def mix(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit numbers."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))
