"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide link counts.

Every text is encoded by tokenizer A (byte-level BPE, after a leading space) and by tokenizer B
(sentencepiece, which adds the space itself). Offsets where tokens of both end cut the text into
groups; the last A and the last B token of a group end together and form its link.

Identity-map fast path: an array over A's vocabulary gives the B id with the same bytes. A group of
one A token and one B token that is this id is exact; its link is counted in an A-vocabulary-length
vector per batch and the vectors are summed, so the common case never enters a shuffle keyed by
pairs. Only the links of irregular groups are exploded and counted by ``(a, b)`` with a partial
aggregate, and only they meet the pair counts in a (salted) join; the exact links take their counts
from vocabulary-sized arrays shipped to the tasks.

Odd input, and what it gives:

* null or empty text, and texts whose joined A or B bytes differ from space + text (normalisation,
  unknown pieces), have no tokens: zero counts and an empty ``groups_sha256``;
* special tokens' strings inside a text are ordinary text;
* very long texts are encoded whole; repeated rows, and rows sharing a doc_id, each give their own
  row and each add their links to the corpus counts;
* an empty table gives no rows; extra columns are ignored (only ``doc_id`` and ``text`` are read).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.batches import release, rows_of, slices, store_batches
from textlens.llm import tokens
from textlens.llm.tokens import _byte_letters
from textlens.operators.joins import salted_join
from textlens.session import store

ALIGNED = (
    "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "fast_a array<int>, odd_a array<int>, odd_b array<int>"
)

# Texts are encoded some megabytes at a time, so that a batch of long texts stays within a task's memory.
SLICE_BYTES = 2 << 20

_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str):
    """Both tokenizers, the bytes and lengths of every id, and the identity map from A ids to B ids (-1: none)."""
    # Spark runs one task a core already: the encoders' own thread pools would only add threads, their memory arenas and spinning.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    letters = {chr(v): k for k, v in _byte_letters().items()}
    a_bytes = [b""] * a.get_vocab_size()
    for entry, i in a.get_vocab().items():
        a_bytes[i] = bytes(letters.get(c, ord(c)) for c in entry)
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        single = _BYTE_PIECE.fullmatch(piece)
        b_bytes.append(bytes([int(single.group(1), 16)]) if single else piece.replace("▁", " ").encode())
    first: dict[bytes, int] = {}
    for i, data in enumerate(b_bytes):
        first.setdefault(data, i)
    identity = np.array([first.get(data, -1) for data in a_bytes], np.int64)
    a_len = np.array([len(x) for x in a_bytes], np.int64)
    b_len = np.array([len(x) for x in b_bytes], np.int64)
    a_flat = (np.frombuffer(b"".join(a_bytes), np.uint8), np.r_[0, np.cumsum(a_len)[:-1]])
    b_flat = (np.frombuffer(b"".join(b_bytes), np.uint8), np.r_[0, np.cumsum(b_len)[:-1]])
    return a, b, a_flat, b_flat, a_len, b_len, identity


@lru_cache(maxsize=2)
def _ranked(a_path: str):
    """The by-rank encoder of A's file (same ids as the library's), and A's special strings."""
    encoder = tokens.encoder(a_path)
    return encoder, tuple(encoder.special)


def _a_ids(a, a_path: str, texts: list[str]) -> list:
    """A's ids of space + text: by rank, or by the library where a special string occurs, which must stay plain text."""
    encoder, special = _ranked(a_path)
    return [
        a.encode(" " + t, add_special_tokens=False).ids if any(x in t for x in special) else np.frombuffer(encoder.encode(" " + t), "<u4")
        for t in texts
    ]


def align_text(text: str | None, a_path: str, b_path: str):
    """``(ids_a, ids_b, group_a, group_b)`` of one text: the ids and the group of each token; all empty for a text without tokens."""
    a, b, a_flat, b_flat, a_len, b_len, _ = vocabularies(a_path, b_path)
    return _aligned(text, a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or ""), a_flat, b_flat, a_len, b_len)


def _spells(ids: np.ndarray, flat, lengths: np.ndarray, whole: np.ndarray) -> bool:
    """Whether the tokens' bytes, joined, are ``whole``; by gathers over all tokens' bytes laid end to end."""
    data, starts = flat
    sizes = lengths[ids]
    total = int(sizes.sum())
    if total != len(whole):
        return False
    at = np.repeat(starts[ids] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(total)
    return bool(np.array_equal(data[at], whole))


def _aligned(text, ids_a, ids_b, a_flat, b_flat, a_len, b_len):
    nothing = np.zeros(0, np.int64)
    if not text:
        return nothing, nothing, nothing, nothing
    whole = np.frombuffer((" " + text).encode(), np.uint8)
    ids_a, ids_b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
    if not _spells(ids_a, a_flat, a_len, whole) or not _spells(ids_b, b_flat, b_len, whole):
        return nothing, nothing, nothing, nothing
    ends_a, ends_b = np.cumsum(a_len[ids_a]), np.cumsum(b_len[ids_b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return ids_a, ids_b, np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)


def _decimal_bytes(values: np.ndarray, marks: np.ndarray) -> bytes:
    """Each value (below 2**31) in decimal followed by its mark byte (0: none), as one byte string; vectorised.

    Digits are written right-aligned in a fixed number of columns, the mark in one more; the
    unused leading columns and absent marks are masked out before the bytes are read row by row.
    """
    values = values.astype(np.int32)
    width = np.searchsorted(_TENS, values, side="right").astype(np.int32)
    columns = int(width.max()) if len(values) else 1
    cells = np.empty((len(values), columns + 1), np.uint8)
    rest = values.copy()
    for column in range(columns - 1, -1, -1):
        cells[:, column] = rest % 10 + 48
        rest //= 10
    cells[:, columns] = marks
    keep = np.empty(cells.shape, bool)
    keep[:, :columns] = np.arange(columns)[None, :] >= (columns - width)[:, None]
    keep[:, columns] = marks != 0
    return cells[keep].tobytes()


# 1, 10, 100, ...: the number of them at or below a value is its count of decimal digits (0 has one).
_TENS = np.array([0] + [10**p for p in range(1, 10)], np.int64)


def _groups_digest(ids_a, ids_b, group_a, group_b, chunk: int = 1 << 18) -> str:
    """sha256 of ``a1,a2|b1;a3|b2,b3``: each group's A ids, then its B ids, in decimal."""
    key = np.concatenate([group_a * 2, group_b * 2 + 1])
    order = np.argsort(key, kind="stable")
    ids, key = np.concatenate([ids_a, ids_b])[order], key[order]
    same = np.append(key[1:] == key[:-1], False)
    marks = np.where(same, ord(","), np.where(key % 2 == 0, ord("|"), ord(";"))).astype(np.uint8)
    marks[-1] = 0
    digest = hashlib.sha256()
    for begin in range(0, len(ids), chunk):
        digest.update(_decimal_bytes(ids[begin : begin + chunk], marks[begin : begin + chunk]))
    return digest.hexdigest()


def _align_slice(batch: pa.RecordBatch, a_path: str, a, b, a_flat, b_flat, a_len, b_len, identity) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    present = [t for t in texts if t]
    encoded_a = iter(_a_ids(a, a_path, present))
    encoded_b = iter(b.encode(present, num_threads=1))
    out = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "fast_a", "odd_a", "odd_b")}
    for text in texts:
        ids_a, ids_b = (next(encoded_a), next(encoded_b)) if text else ([], [])
        ids_a, ids_b, group_a, group_b = _aligned(text, ids_a, ids_b, a_flat, b_flat, a_len, b_len)
        n_groups = int(group_a[-1]) + 1 if len(ids_a) else 0
        last_a = np.searchsorted(group_a, np.arange(n_groups), side="right") - 1
        last_b = np.searchsorted(group_b, np.arange(n_groups), side="right") - 1
        sizes_a, sizes_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        link_a, link_b = ids_a[last_a], ids_b[last_b]
        exact = (sizes_a == 1) & (sizes_b == 1) & (identity[link_a] == link_b)
        out["n_a"].append(len(ids_a))
        out["n_b"].append(len(ids_b))
        out["n_groups"].append(n_groups)
        out["n_links"].append(n_groups)
        out["groups_sha256"].append(_groups_digest(ids_a, ids_b, group_a, group_b) if n_groups else "")
        out["fast_a"].append(link_a[exact].astype(np.int32))
        out["odd_a"].append(link_a[~exact].astype(np.int32))
        out["odd_b"].append(link_b[~exact].astype(np.int32))
    columns = [batch.column("_row"), batch.column("doc_id")]
    columns += [pa.array(out[n], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    columns.append(pa.array(out["groups_sha256"], pa.string()))
    columns += [pa.array(out[n], pa.list_(pa.int32())) for n in ("fast_a", "odd_a", "odd_b")]
    return pa.RecordBatch.from_arrays(columns, ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "fast_a", "odd_a", "odd_b"])


def _align_batches(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = vocabularies(a_path, b_path)
        for batch in batches:
            for data in batch.column("rows"):
                rows = rows_of(data.as_buffer())
                for part in slices(rows, rows.schema.get_field_index("text"), SLICE_BYTES):
                    yield _align_slice(part, a_path, *tools)
        release()

    return run


def _vector_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            values = batch.column("fast_a").flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(values, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["a", "n"])

    return run


def _exact_tallies(counts: np.ndarray, best: np.ndarray, identity: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fast = batch.column("fast_a")
            sums, bests = [], []
            for ids in fast.to_numpy(zero_copy_only=False):
                c = counts[ids]
                sums.append(int(c.sum()))
                bests.append(int((c == best[identity[ids]]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(sums, pa.int64()), pa.array(bests, pa.int64())], ["_row", "fast_sum", "fast_best"]
            )

    return run


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A pair's count is the number of links corpus-wide that hold it; ``n_best`` counts the links
    whose count is the highest of any pair with their B id (ties included); ``count_sum`` adds
    the counts of a text's links.
    """
    spark = docs.sparkSession
    _, _, _, _, _, _, identity = vocabularies(a_path, b_path)
    size_a, size_b = len(identity), int(vocabularies(a_path, b_path)[5].shape[0])
    rows = docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    stored = store_batches(rows.select("_row", "doc_id", "text"), "text")
    aligned = store(stored.select("rows").mapInArrow(_align_batches(a_path, b_path), ALIGNED), "alignment")

    # Exact links: one vector of A's vocabulary length per task, summed; bounded by that length.
    vector = aligned.select("fast_a").mapInArrow(_vector_counts(size_a), "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))
    counts = np.zeros(size_a, np.int64)
    for r in vector.collect():
        counts[r["a"]] = r["n"]

    # Irregular links: counted by pair with a partial aggregate.
    links = aligned.select("_row", F.explode(F.arrays_zip("odd_a", "odd_b")).alias("p")).select("_row", F.col("p.odd_a").alias("a"), F.col("p.odd_b").alias("b"))
    pairs = store(links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "alignment-pairs")

    # Highest count of each B id: at most B's vocabulary length of rows.
    best = np.zeros(size_b, np.int64)
    for r in pairs.groupBy("b").agg(F.max("n").alias("n")).collect():
        best[r["b"]] = r["n"]
    mapped = identity >= 0
    np.maximum.at(best, identity[mapped], counts[mapped])

    best_table = spark.createDataFrame(list(enumerate(best.tolist())), "b int, top long")
    judged = pairs.join(F.broadcast(best_table), "b").select("a", "b", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best"))
    odd = salted_join(links, judged, ["a", "b"]).groupBy("_row").agg(F.sum("n").alias("odd_sum"), F.sum("is_best").alias("odd_best"))
    exact = aligned.select("_row", "fast_a").mapInArrow(_exact_tallies(counts, best, identity), "_row long, fast_sum long, fast_best long")
    result = aligned.drop("fast_a", "odd_a", "odd_b").join(exact, "_row").join(odd, "_row", "left")
    return result.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("fast_best") + F.coalesce("odd_best", F.lit(0))).cast("long").alias("n_best"),
        (F.col("fast_sum") + F.coalesce("odd_sum", F.lit(0))).cast("long").alias("count_sum"),
        "groups_sha256",
    )
