"""Phrase collocations: two- and three-word phrases that occur together far more often than their parts.

Every phrase of up to three words is counted twice. First by a 64-bit hash, over batches of texts by the exchange of
:mod:`textlens.llm.batches`: such a count is never too low, so a phrase whose hash is met less than
ten times is no candidate, and no part of one. Then the phrases that are left are counted as the strings they are, so the
counts are exact and only what is met often enough travels as text. These counts are kept as streams of phrases in prefix
order (a phrase and its left parts) and in suffix order (its right parts); the left, right and extension counts of every
candidate come from sort-merge joins of those streams. Every word occurrence of every text is counted; nothing
is sampled or capped before the final per-language report.

Odd input, and what it gives:

* null ``text`` counts as the empty text; null ``lang`` is the language ``und``;
* empty and white-space-only texts, and pieces without words, add no word and no phrase;
* very long texts are batches of their own; phrases never cross piece breaks;
* repeated rows count again (every occurrence is an occurrence);
* ties of score and count are ordered by the phrase in UTF-8 byte order, so the report is
  deterministic; candidates whose cuts score the same take the smallest cut;
* an empty table gives an empty report; extra input columns are ignored (only ``lang`` and
  ``text`` are read).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm import batches as bt
from textlens.operators.joins import top_per_key
from textlens.session import store

# Fixed values of the contract: letters folded to lower case, piece breaks, and what a word is.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
PIECE_BREAKS = ".,;:!?\n\x0B\x0C\r"
SPACES = " \t"

LONGEST = 3

# Bytes of text in a batch: phrases of a batch travel once.
BATCH_BYTES = 4 << 20

# Bytes of text for each hashed phrase of the exchange's groups.
KEY_BYTES = 12

# Bits of a hash below its group's that are compared. Phrases that fall together count as one there, which is never too low.
KEY_BITS = 24

# Bits fewer for the groups that phrases are counted in as strings, as few are left by then.
FEWER_BITS = 3

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[list(UPPER.encode())] = list(LOWER.encode())
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(PIECE_BREAKS.encode())] = True
_IN_WORD = ~_BREAK
_IN_WORD[list(SPACES.encode())] = False

_LETTERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = np.array([pow(0xD6E8FEB86659FD93 | 1, i, 1 << 64) for i in range(256)], dtype=np.uint64)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little")


class _Words:
    """The folded words of a batch's texts, each followed by a space, with the piece and the language of each."""

    def __init__(self, rows: pa.RecordBatch):
        data, offsets = bt.texts_of(rows.column(rows.schema.get_field_index("text")))
        data = data[: offsets[-1]]
        inside = _IN_WORD[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[1:-1]
        borders = borders[borders < len(data)]
        first[borders] = inside[borders]
        at, begins = np.flatnonzero(inside), np.flatnonzero(first)
        starts = np.flatnonzero(first[at])
        self.lengths = np.diff(np.r_[starts, len(at)])
        letters = _FOLD[data[at]]
        self.plain = np.full(len(at) + len(starts), ord(" "), dtype=np.uint8)
        self.begins = starts + np.arange(len(starts))
        self.plain[np.arange(len(at)) + np.repeat(np.arange(len(starts)), self.lengths)] = letters
        doc = np.searchsorted(offsets, begins, side="right") - 1
        # both terms only grow, so words of one sum are in one piece of one text
        self.piece = np.cumsum(_BREAK[data])[begins] + doc
        langs = rows.column(rows.schema.get_field_index("lang")).dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)[doc]
        self.salts = np.array([_lang_hash(x) for x in self.langs.to_pylist()], dtype=np.uint64)
        self.hashes = np.zeros(0, np.uint64)
        if len(starts):
            place = np.arange(len(at)) - np.repeat(starts, self.lengths)
            self.hashes = bt.mix(np.add.reduceat(_LETTERS[letters] * _POWERS[place & 255] + (place >> 8).astype(np.uint64), starts))

    def phrases(self, size: int) -> np.ndarray:
        """The first word of each phrase of ``size`` words."""
        count = max(len(self.piece) - size + 1, 0)
        return np.flatnonzero(self.piece[:count] == self.piece[size - 1 :][:count])

    def keys(self, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words and their languages."""
        at = self.phrases(size)
        sums = self.salts[self.lang[at]] + np.uint64(size)
        for i in range(size):
            sums += self.hashes[at + i] * _POWERS[size - i]
        return bt.mix(sums)

    def counted(self, at: np.ndarray, size: int, groups: np.ndarray) -> pa.Table:
        """``(group, lang, phrase, f)`` of the phrases that begin at the words ``at``."""
        lengths = self.begins[at + size - 1] + self.lengths[at + size - 1] - self.begins[at]
        ends = np.r_[0, np.cumsum(lengths)]
        data = self.plain[np.arange(ends[-1]) + np.repeat(self.begins[at] - ends[:-1], lengths)]
        phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        table = pa.table({"group": groups, "lang": self.lang[at], "phrase": phrases})
        return table.group_by(["group", "lang", "phrase"], use_threads=False).aggregate([([], "count_all")])

    def totals(self) -> pa.Table:
        """The number of words of each language as the count of the empty phrase."""
        found, counts = np.unique(self.lang, return_counts=True)
        columns = [np.zeros(len(found), np.int64), found, pa.array([b""] * len(found), pa.large_binary()), counts]
        return pa.table(columns, ["group", "lang", "phrase", "count_all"])


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """Hashes without the bits that are not compared, where ``bits`` name the group."""
    return keys >> np.uint64(64 - KEY_BITS - bits) << np.uint64(64 - KEY_BITS - bits)


def _distinct_phrases(longest: int, bits: int):
    def extract(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        held = _Words(rows)
        keys = np.concatenate([held.keys(size) for size in range(1, longest + 1)])
        return np.unique(_cut(keys, bits), return_counts=True)

    return extract


_SENT = "lang string, bucket long, lengths binary, phrases binary, counts binary"


def _send(longest: int, least: int, bits: int):
    """Counts within each batch of the phrases whose hash is met ``least`` times in all batches, packed in order by group."""
    few = np.uint64(64 - max(bits - FEWER_BITS, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, listed in zip(batch.column(0), batch.column(1)):
                held = _Words(bt.rows_of(data.as_buffer()))
                keys = [held.keys(size) for size in range(1, longest + 1)]
                _, inverse = np.unique(_cut(np.concatenate(keys), bits), return_inverse=True)
                often = np.split((bt.answers_of(listed.as_py()) >= least)[inverse], np.cumsum([len(k) for k in keys])[:-1])
                del inverse
                tables = [held.totals()]
                for size in range(1, longest + 1):
                    chosen = often[size - 1]
                    tables.append(held.counted(held.phrases(size)[chosen], size, (keys[size - 1][chosen] >> few).astype(np.int64)))
                langs = held.langs.to_pylist()
                del held, keys, often
                table = pa.concat_tables([t.cast(tables[0].schema) for t in tables])
                table = table.sort_by([("lang", "ascending"), ("group", "ascending"), ("phrase", "ascending")]).combine_chunks()
                del tables
                if not table.num_rows:
                    continue
                lang, group, counts = (table.column(n).to_numpy() for n in ("lang", "group", "count_all"))
                phrases = table.column("phrase").chunk(0)
                lengths = pa.compute.binary_length(phrases).to_numpy(zero_copy_only=False).astype(np.uint32)
                ends = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
                plain = np.frombuffer(phrases.buffers()[2] or b"", dtype=np.uint8)
                edges = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (group[1:] != group[:-1]), True])
                rows = [[], [], []]
                for a, b in zip(edges[:-1], edges[1:]):
                    rows[0].append(bt.pack(lengths[a:b]))
                    rows[1].append(bt.pack_bytes(plain[ends[a] : ends[b]].tobytes()))
                    rows[2].append(bt.pack(counts[a:b].astype(np.int64)))
                columns = [pa.array([langs[i] for i in lang[edges[:-1]]], pa.string()), pa.array(group[edges[:-1]], pa.int64())]
                columns += [pa.array(r, pa.binary()) for r in rows]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "lengths", "phrases", "counts"])
        bt.release()

    return run


def _sum(least: int):
    """Counts of the phrases of a group over all batches, from ``least`` on, and the language's number of words."""

    def run(table: pa.Table) -> pa.Table:
        lengths = np.concatenate([bt.unpack(x.as_py(), "<u4") for x in table.column("lengths")])
        counts = np.concatenate([bt.unpack(x.as_py(), "<i8") for x in table.column("counts")])
        plain = b"".join(bt.unpack_bytes(x.as_py()) for x in table.column("phrases"))
        ends = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        phrases = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(plain))
        found = pa.table({"phrase": phrases, "f": counts}).group_by("phrase", use_threads=False).aggregate([("f", "sum")]).combine_chunks()
        phrase, f = found.column("phrase"), found.column("f_sum")
        empty = pa.compute.equal(phrase, "")
        size = pa.compute.if_else(empty, 0, pa.compute.add(pa.compute.count_substring(phrase, " "), 1))
        out = pa.table({"phrase": phrase.cast(pa.string()), "size": size.cast(pa.int32()), "f": f.cast(pa.int64())})
        out = out.filter(pa.compute.or_(empty, pa.compute.greater_equal(f, least)))
        return out.add_column(0, "lang", pa.array([table.column("lang")[0].as_py()] * out.num_rows, pa.string()))

    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = 1) -> DataFrame:
    """``(lang, phrase, size, f)``: phrases of 1 to ``longest`` words met ``f >= least`` times in ``lang`` and ``text`` of ``docs``.

    Words are joined by a space, which no word holds. Rows of size 0 carry each language's number of words in ``f``.
    """
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    batches = bt.store_batches(rows, "text", BATCH_BYTES)
    total = batches.agg(F.sum("n_bytes")).first()[0] or 0
    bits = bt.group_bits(total / KEY_BYTES)
    asked = bt.count_keys(batches, _distinct_phrases(longest, bits), total / KEY_BYTES, least)
    sent = asked.select("rows", "answers").mapInArrow(_send(longest, least, bits), _SENT)
    return sent.groupBy("lang", "bucket").applyInArrow(_sum(least), "lang string, phrase string, size int, f long")


def _exact_score(a, l, r):
    """floor(1,000,000 * a * a / (l * r)) in 38-digit decimals; exact, as the quotient never exceeds 1,000,000."""
    wide = "decimal(38,0)"
    return F.expr(f"(CAST(1000000 AS {wide}) * CAST({a} AS {wide}) * CAST({a} AS {wide})) div (CAST({l} AS {wide}) * CAST({r} AS {wide}))")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, longest: int = LONGEST, keep_percent: int = 50) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words, by the score of their weakest cut.

    A candidate occurs ``a >= least`` times. Cutting it after its first ``k`` words gives the
    counts ``l`` and ``r`` of both parts and the score ``floor(1e6 a^2 / (l r))``; the lowest
    score counts, ties to the smallest ``k``. A candidate is dropped when it lies inside a longer
    candidate (dropped or not) that occurs at least ``keep_percent`` % of ``a`` times. Columns: ``lang, rank``
    (from 1), ``phrase, a, l, r, n`` (all word occurrences of the language) and ``score``.
    """
    stored = store(phrase_counts(docs, longest, least), "phrase-counts")
    totals = stored.where("size = 0").select("lang", F.col("f").alias("n"))
    grams = stored.where("size > 0")
    candidates = grams.where((F.col("size") >= 2) & (F.col("f") >= least)).select("lang", "phrase", "size", F.col("f").alias("a"))

    words = F.split("phrase", " ")
    cuts = candidates.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "*",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("left_part"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right_part"),
    )
    prefix_stream = grams.select("lang", F.col("phrase").alias("left_part"), F.col("f").alias("l"))
    suffix_stream = grams.select("lang", F.col("phrase").alias("right_part"), F.col("f").alias("r"))
    met = cuts.join(prefix_stream.hint("merge"), ["lang", "left_part"]).join(suffix_stream.hint("merge"), ["lang", "right_part"])
    scored = met.withColumn("score", _exact_score("a", "l", "r").cast("long"))
    weakest = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    weakest = weakest.select("lang", "phrase", "size", "a", "m.score", "m.l", "m.r")

    # Every shorter run inside a longer candidate, with the longer one's count, merged on the shorter phrase.
    inner = [(length, begin) for length in range(2, longest) for begin in range(longest - length + 1)]
    longer = candidates.where("size > 2")
    parts = []
    for length, begin in inner:
        part = F.array_join(F.slice(words, begin + 1, length), " ")
        parts.append(longer.where((F.col("size") >= begin + length) & (F.col("size") > length)).select("lang", part.alias("phrase"), F.col("a").alias("longer_f")))
    if parts:
        outer = parts[0]
        for more in parts[1:]:
            outer = outer.unionByName(more)
        outer = outer.groupBy("lang", "phrase").agg(F.max("longer_f").alias("longer_f"))
        kept = weakest.join(outer.hint("merge"), ["lang", "phrase"], "left").where(
            F.col("longer_f").isNull() | (F.col("longer_f") * 100 < F.col("a") * keep_percent)
        )
    else:
        kept = weakest
    kept = kept.join(totals, "lang")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = top_per_key(kept, ["lang"], order, top)
    return ranked.select(
        "lang", (F.col("rank") + 1).cast("long").alias("rank"), "phrase", F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"), F.col("r").cast("long").alias("r"), F.col("n").cast("long").alias("n"), "score",
    )
