"""Packing token ids into sequences of one length by solving for repeated combinations of lengths.

Lengths are counted in grains. All combinations of a few lengths that fill a window are listed, the
number of times each is used solves a non-negative least-squares problem against the histogram of
lengths, is rounded down to what the histogram holds, and the rest of the histogram is packed
greedily. Only the histogram, whose size is fixed by the window, reaches the driver; a piece finds
its sequence from its number among the pieces of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.batches import release
from textlens.llm.tokens import encoder
from textlens.operators.joins import measured_join
from textlens.session import scratch_path

# Tables of up to this many writer tasks are broadcast; a row holds one count per length.
BROADCAST_PARTS = 4_096


def combinations(bins: int, depth: int = 3) -> list[tuple[int, ...]]:
    """All descending tuples of at most ``depth`` lengths that sum to ``bins``."""
    found: list[tuple[int, ...]] = []

    def extend(taken: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(taken)
        elif len(taken) < depth:
            for size in range(min(left, taken[-1] if taken else bins), 0, -1):
                if size * (depth - len(taken)) < left:
                    break
                extend((*taken, size), left - size)

    extend((), bins)
    return found


def solve_nonnegative(columns: np.ndarray, target: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Least squares of ``columns @ x = target`` over x >= 0 by the active-set method.

    A variable joins the free set while it has the steepest descent; when the solution on the
    free set leaves the feasible side, the step is cut at the first bound and variables there are fixed at 0.
    """
    n = columns.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    gram, moment = columns.T @ columns, columns.T @ target
    scale = max(float(np.abs(moment).max(initial=0.0)), 1.0)
    for _ in range(10 * columns.shape[0]):
        slope = moment - gram @ x
        slope[free] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance * scale:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            trial = np.zeros(n)
            trial[at] = np.linalg.lstsq(columns[:, at], target, rcond=None)[0]
            below = at[trial[at] <= 0]
            if not len(below):
                x = trial
                break
            if best in below and x[best] == 0:
                free[best] = False
            ratio = x[below] / np.maximum(x[below] - trial[below], 1e-300)
            x = x + ratio.min() * (trial - x)
            free &= x > tolerance
            x[~free] = 0
            if not free.any():
                break
    return x


@dataclass
class Plan:
    """Sequences of each kind: lengths in grains, how many, and the number of the first."""

    kinds: list[tuple[int, ...]]
    counts: list[int]

    def slots(self, bins: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: first piece number, first sequence and place in the sequence of each run of slots."""
        runs: list[list[tuple[int, int, int]]] = [[] for _ in range(bins + 1)]
        used, first = [0] * (bins + 1), 0
        for kind, count in zip(self.kinds, self.counts):
            for place, size in enumerate(kind):
                runs[size].append((used[size], first, place))
                used[size] += count
            first += count
        return [tuple(np.array(column, dtype=np.int64) for column in zip(*r)) if r else (np.zeros(0, np.int64),) * 3 for r in runs]


def plan_sequences(histogram: np.ndarray, depth: int = 3) -> Plan:
    """Kinds of sequences that use every piece of the histogram (index = length in grains) exactly once."""
    bins = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    kinds, counts = [], []
    if left.sum():
        listed = combinations(bins, depth)
        columns = np.zeros((bins + 1, len(listed)))
        for j, kind in enumerate(listed):
            for size in kind:
                columns[size, j] += 1
        times = solve_nonnegative(columns, left.astype(float))
        for j in np.argsort(-times, kind="stable"):
            sizes, needed = np.unique(listed[j], return_counts=True)
            count = int(min(np.floor(times[j] + 1e-6), (left[sizes] // needed).min()))
            if count > 0:
                kinds.append(listed[j])
                counts.append(count)
                left[sizes] -= needed * count
    while left.any():  # the largest piece, then the largest that still fits, as often as the counts allow
        kind, room, trial = [], bins, left.copy()
        while room and trial[1 : room + 1].any():
            size = int(np.flatnonzero(trial[: room + 1])[-1])
            kind.append(size)
            trial[size] -= 1
            room -= size
        sizes, needed = np.unique(kind, return_counts=True)
        count = int((left[sizes] // needed).min())
        kinds.append(tuple(kind))
        counts.append(count)
        left[sizes] -= needed * count
    return Plan(kinds, counts)


_PIECES = "{key} {kind}, start long, length long, doc_tokens long, ids binary, part int, bin int, number long"


def _cut_up(path: str, end_id: int, window: int, grain: int, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, numbers = encoder(path), TaskContext.get().partitionId(), {}
        last = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, size = [], 0
            for row in range(batch.num_rows):
                ids = ids_of.encode(batch.column(1)[row].as_py()) + last
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    bin_ = -(-length // grain)
                    numbers[bin_] = number = numbers.get(bin_, -1) + 1
                    rows.append((row, start, length, total, ids[4 * start : 4 * (start + length)], bin_, number))
                    size += length
                if size and (size > 500_000 or row + 1 == batch.num_rows):
                    at, starts, lengths, totals, blobs, bins, places = zip(*rows)
                    columns = [batch.column(0).take(pa.array(at)), pa.array(starts), pa.array(lengths), pa.array(totals)]
                    columns += [pa.array(blobs, pa.binary()), pa.array([part] * len(at), pa.int32()), pa.array(bins, pa.int32())]
                    columns.append(pa.array(places, pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, [key, "start", "length", "doc_tokens", "ids", "part", "bin", "number"])
                    rows, size = [], 0
        release()

    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int, grain: int, key: str, text: str) -> DataFrame:
    """Stored pieces of at most ``window`` ids: all of a document's full windows, and its rest."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    pieces = rows.mapInArrow(_cut_up(tokenizer, end_id, window, grain, key), _PIECES.format(key=key, kind=kind))
    path = scratch_path(docs.sparkSession, "pieces")
    pieces.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(pieces.schema).parquet(path)


def _placer(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, number = batch.column("bin").to_numpy(), batch.column("number").to_numpy()
            sequence, place = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int32)
            for size in np.unique(bins):
                at = np.flatnonzero(bins == size)
                begins, firsts, places = slots[size]
                run_ = np.searchsorted(begins, number[at], side="right") - 1
                sequence[at] = firsts[run_] + number[at] - begins[run_]
                place[at] = places[run_]
            columns = [*batch.columns[:-2], pa.array(sequence), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "sequence_id", "place"])

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    window: int = 1024,
    grain: int = 8,
    depth: int = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``window`` ids.

    Returns ``(key, start, length, doc_tokens, ids, sequence_id, place)``: ``ids`` holds the piece's
    little-endian unsigned 32-bit ids, ``start`` the ids of its document before it, ``place`` its
    order in the sequence. A document is its tokenizer's ids and ``end_id``; a null or empty text is
    that id alone, a long one as many full windows as it holds and a rest. Rows are packed one by one, so
    repeated rows and rows that share a key are documents of their own; a null key is
    kept. An empty table gives no pieces. Other columns are not read.

    Ids are written once and never shuffled: the number of a piece among those of its length is
    its number in the writer's task plus the counts of the tasks before, one row per task.
    """
    if window % grain:
        raise ValueError("the grain must divide the window")
    bins = window // grain
    pieces = token_pieces(docs, tokenizer, end_id, window, grain, key, text)
    counts = pieces.groupBy("part", "bin").agg(F.count("*").alias("n"))
    counts = counts.withColumn("n", F.col("n").cast("long"))
    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "_before")))
    by_part = before.groupBy("part").agg(filled.alias("_map"))
    sizes = F.sequence(F.lit(0), F.lit(bins))
    by_part = by_part.select("part", F.transform(sizes, lambda b: F.coalesce(F.col("_map")[b], F.lit(0))).alias("before"))
    histogram = np.zeros(bins + 1, dtype=np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # one row per length
        histogram[row["bin"]] = row["n"]
    slots = plan_sequences(histogram, depth).slots(bins)
    met = measured_join(pieces, by_part, ["part"], limit_rows=BROADCAST_PARTS)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, doc_tokens long, ids binary, sequence_id long, place int"
    number = (F.col("number") + F.col("before")[F.col("bin")]).alias("number")
    return met.select(key, "start", "length", "doc_tokens", "ids", "bin", number).mapInArrow(_placer(slots), schema)


def offsets(pieces: DataFrame) -> DataFrame:
    """``offset`` of each piece in its sequence; sequences are short, so a window over one is small."""
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids, lengths)``: the ids of whole sequences, pieces in order, and the pieces' lengths."""
    listed = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("place", "length", "ids"))).alias("p"))
    joined = F.aggregate("p", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"]))
    return listed.select("sequence_id", joined.alias("ids"), F.transform("p", lambda p: p["length"]).alias("lengths"))
