"""Near-duplicate texts by consistent weighted sampling of TF-IDF shingles.

Shingles are five words in a row. Their document counts come from all documents by the exchange of
:mod:`textlens.llm.batches`. A text can only have a partner if shingles that occur elsewhere make up
enough of its weight, so the others are done with exactly, before any sampling. The rest is sampled,
banded, and verified by the weighted Jaccard similarity; links join texts to classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm import batches as bt
from textlens.session import cut, store

# Tables of buckets or nodes up to this number of rows are broadcast, some 50 bytes a row.
BROADCAST_ROWS = 100_000

# Texts to be compared are broadcast up to this number of bytes, as every pair would carry one through an exchange otherwise.
BROADCAST_BYTES = 16 << 20

# Rows of a stored table that a task goes on with; a small table in hundreds of partitions costs as many files in each exchange.
PART_ROWS = 25_000

# Tasks that count a stored table.
COUNTING = 16

# Numbers of copies of a text for which its weight beyond them is kept; more count as the last.
COPIES = 16

# Leaders of a bucket in the second round; each further round takes as many times more.
LEADERS = 4

# Entries of the table of random draws.
DRAWS_BITS = 16

_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = np.array([pow(0xD6E8FEB86659FD93 | 1, i, 1 << 64) for i in range(256)], dtype=np.uint64)
_PLACES = [np.uint64(pow(0xA24BAED4963EE407 | 1, i, 1 << 64)) for i in range(64)]

# Bytes of words: ASCII letters and digits, and all bytes of other characters.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the text it is in; a word ends where its text ends."""
    inside = _IN_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    borders = borders[borders < len(data)]
    starts[borders] = inside[borders]
    at = np.flatnonzero(inside)
    first = np.flatnonzero(starts[at])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    letters = _LETTERS[data[at]] * _POWERS[place & 255] + (place >> 8).astype(np.uint64)
    hashes = bt.mix(np.add.reduceat(letters, first))
    return hashes, np.searchsorted(offsets, at[first], side="right") - 1


def shingles(column: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct shingles of each text, how often each occurs in it, and where the texts begin in both.

    Words are compared in lower case. A text of fewer words is one shingle, one without words has none.
    """
    lowered = pa.compute.utf8_lower(column.cast(pa.large_string()))
    data, offsets = bt.texts_of(lowered)
    hashes, texts = _words(data, offsets)
    edges = np.searchsorted(texts, np.arange(len(column) + 1))
    sums = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
    for i in range(words):
        sums += hashes[i : i + len(sums)] * _PLACES[words - i]
    sums = bt.mix(sums)
    found, counts, ends = [], [], [0]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= words:
            own, n = np.unique(sums[a : b - words + 1], return_counts=True)
        elif b > a:
            own = bt.mix(np.array([(hashes[a:b] * np.array(_PLACES[1 : b - a + 1])).sum() + np.uint64(b - a)], dtype=np.uint64))
            n = np.ones(1, dtype=np.int64)
        else:
            own, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        found.append(own)
        counts.append(n)
        ends.append(ends[-1] + len(own))
    return np.concatenate(found), np.concatenate(counts), np.array(ends)


def _distinct_shingles(text: str, words: int):
    def extract(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found, counts = np.unique(shingles(rows.column(rows.schema.get_field_index(text)), words)[0], return_counts=True)
        return found, counts

    return extract


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) draws r, uniform draws and logarithms of Gamma(2, 1) draws."""
    random = np.random.default_rng(23)
    size = 1 << DRAWS_BITS
    return random.gamma(2.0, 1.0, size), random.random(size), np.log(random.gamma(2.0, 1.0, size))


def weighted_samples(found: np.ndarray, weights: np.ndarray, ends: np.ndarray, samples: int) -> np.ndarray:
    """Improved consistent weighted samples, one row per text (none of them empty).

    For shingle x of weight w, t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1), with r, b, c drawn by a
    hash of x and the number of the sample; the sample is the (x, t) of the least a. Two texts agree in a sample with
    the probability of their weighted Jaccard similarity.
    """
    r_of, b_of, c_of = _draws()
    logs, begins, lengths = np.log(weights), ends[:-1], np.diff(ends)
    seeds = np.random.default_rng(29).integers(1, 1 << 63, samples, dtype=np.uint64) | np.uint64(1)
    out = np.empty((len(begins), samples), dtype=np.uint64)
    for h in range(samples):
        at = ((found * seeds[h]) >> np.uint64(64 - DRAWS_BITS)).astype(np.int64)
        r, b = r_of[at], b_of[at]
        t = np.floor(logs / r + b)
        a = c_of[at] - r * (t - b + 1.0)
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, begins), lengths))
        first = least[np.searchsorted(least, begins)]  # ties go to the smaller hash
        out[:, h] = bt.mix(found[first] + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


_SKETCH = "batch long, row int, rank long, node binary, bands array<long>, weight double, beyond array<float>, weighed binary"


def _lists(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as lists."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.ravel()))


def _sketched(number: int, rows: np.ndarray, ranks: np.ndarray, nodes=None, bands=None, sums=None, beyond=None, blobs=None) -> pa.RecordBatch:
    size = len(rows)
    columns = [pa.array(np.full(size, number)), pa.array(rows.astype(np.int32)), pa.array(ranks), pa.array(nodes or [None] * size, pa.binary())]
    columns.append(bands if bands is not None else pa.nulls(size, pa.list_(pa.int64())))
    columns.append(pa.array(sums) if sums is not None else pa.nulls(size, pa.float64()))
    columns.append(beyond if beyond is not None else pa.nulls(size, pa.list_(pa.float32())))
    columns.append(pa.array(blobs or [None] * size, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["batch", "row", "rank", "node", "bands", "weight", "beyond", "weighed"])


def _sketch(key: str, text: str, words: int, documents: int, least: float, share: float, bands: int, rows_per_band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = np.log(1.0 + documents)
        for batch in batches:
            for number, data, listed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                rows = bt.rows_of(data.as_buffer())
                keys = bt.keys_of(rows, key)
                found, counts, ends = shingles(rows.column(rows.schema.get_field_index(text)), words)
                _, inverse = np.unique(found, return_inverse=True)
                held_by = bt.answers_of(listed.as_py()).astype(np.float64)[inverse]
                rarity = np.log((1.0 + documents) / (1.0 + np.minimum(held_by, documents))) / scale
                weights = counts * (1.0 - share + share * rarity)
                chosen = np.flatnonzero(np.diff(ends))
                if len(chosen):  # a link needs shared weight of the least similarity at least
                    common = np.add.reduceat(np.where(held_by > 1, weights, 0.0), ends[chosen])
                    chosen = chosen[common >= (least - 1e-9) * np.add.reduceat(weights, ends[chosen])]
                alone = np.setdiff1d(np.arange(len(keys)), chosen)
                if len(alone):
                    yield _sketched(number, alone, keys[alone])
                if not len(chosen):
                    continue
                lengths = np.diff(ends)[chosen]
                part_ends = np.r_[0, np.cumsum(lengths)]
                at = np.arange(part_ends[-1]) - np.repeat(part_ends[:-1], lengths) + np.repeat(ends[chosen], lengths)
                part, heavy, holders = found[at], weights[at], held_by[at]
                sums = np.add.reduceat(heavy, part_ends[:-1])
                beyond = [np.add.reduceat(np.where(holders > n, heavy, 0.0), part_ends[:-1]) for n in range(1, COPIES + 1)]
                beyond = _lists(np.stack(beyond, axis=1).astype(np.float32))
                drawn = weighted_samples(part, heavy, part_ends, bands * rows_per_band)
                drawn = drawn.reshape(len(chosen), bands, rows_per_band)
                band_keys = np.zeros((len(chosen), bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
                for i in range(rows_per_band):
                    band_keys = bt.mix(band_keys * np.uint64(0x9E3779B97F4A7C15) + drawn[:, :, i])
                nodes, blobs, seen = [], [], set()
                for i in range(len(chosen)):
                    own = slice(part_ends[i], part_ends[i + 1])
                    plain = part[own].tobytes() + counts[at[own]].tobytes()
                    nodes.append(hashlib.md5(plain).digest())
                    new = nodes[-1] not in seen  # copies in a batch need their shingles once
                    seen.add(nodes[-1])
                    blobs.append(pack_weighed(part[own], heavy[own]) if new else None)
                lists = _lists(band_keys.view(np.int64))
                for begin in range(0, len(chosen), 500):
                    part = slice(begin, begin + 500)
                    yield _sketched(number, chosen[part], keys[chosen[part]], nodes[part], lists[part], sums[part], beyond[part], blobs[part])
        bt.release()

    return run


def pack_weighed(found: np.ndarray, weights: np.ndarray) -> bytes:
    """Ascending shingles by their upper 32 bits, which tell two texts' shingles apart well enough, and their weights."""
    upper = bt.pack(np.diff((found >> np.uint64(32)).astype(np.uint32), prepend=np.uint32(0)))
    return len(upper).to_bytes(4, "little") + upper + bt.pack(weights.astype("<f4"))


def _unpack_weighed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = 4 + int.from_bytes(data[:4], "little")
    return np.cumsum(bt.unpack(data[4:size], "<u4"), dtype=np.uint32), bt.unpack(data[size:], "<f4").astype(float)


def weighted_jaccard(left: bytes, right: bytes) -> float:
    """Sum of the smaller weights by the sum of the larger ones."""
    (x, u), (y, v) = _unpack_weighed(left), _unpack_weighed(right)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = y[at] == x
    both = np.minimum(u[same], v[at[same]]).sum()
    return float(both / (u.sum() + v.sum() - both))


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            kept = pa.array([weighted_jaccard(a, b) >= least for a, b in pairs], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept], ["a", "b", "linked"]).filter(kept)

    return run


def _counted(frame: DataFrame) -> tuple[DataFrame, int]:
    """``frame`` stored, in no more partitions than its rows need, and the number of its rows."""
    stored = cut(frame)
    rows = stored.coalesce(COUNTING).count()
    return stored.coalesce(1 + rows // PART_ROWS), rows


def _met(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a table of buckets or nodes, each of some 50 bytes: broadcast while it is small. ``rows`` is given if it is stored."""
    if rows is None:
        small, rows = _counted(small)
    return large.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, keys, how)


def _links(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes whose weighted similarity reaches ``least``; only texts that are in a pair are moved."""
    pairs, rows = _counted(pairs)
    wanted, nodes = _counted(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    held = cut(_met(texts, wanted, ["node"], "left_semi", nodes))
    size = held.coalesce(COUNTING).agg(F.sum(F.length("weighed") + 50)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        pairs, held = pairs.repartition(min(1 + rows // 2_000, pairs.sparkSession.sparkContext.defaultParallelism * 4)), F.broadcast(held)
    left = held.select(F.col("node").alias("a"), F.col("weighed").alias("left"))
    right = held.select(F.col("node").alias("b"), F.col("weighed").alias("right"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return met.mapInArrow(_verify(least), "a binary, b binary, linked boolean").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of all linked nodes: the least node of each connected component.

    Labels go to neighbours and then to the label's own label until nothing changes, so a round halves
    long chains; each round is written to the checkpoint folder.
    """
    both, rows = _counted(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    parts = 1 + rows // PART_ROWS
    labels, nodes = _counted(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).withColumn("label", F.least("node", "label")))
    while True:
        near = _met(both, labels.select(F.col("node").alias("b"), "label"), ["b"], rows=nodes)
        near = near.select(F.col("a").alias("node"), "label", F.lit(None).cast("binary").alias("own"))
        lower = near.union(labels.select("node", "label", F.col("label").alias("own")))
        lower = lower.groupBy("node").agg(F.max("own").alias("before"), F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = _met(lower, jump, ["label"], "left", nodes)
        moved = cut(moved.select("node", "before", F.least("label", F.coalesce("further", "label")).alias("label")).coalesce(parts))
        labels = moved.select("node", "label")
        if moved.where(F.col("before") != F.col("label")).isEmpty():
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` with further links, of which only the labels of both ends go through :func:`components` again."""
    labels, rows = _counted(labels)
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), "label")
        links = _met(links, known, [side], "left", rows).withColumn(side, F.coalesce("label", side)).drop("label")
    over = components(links.where("a != b"))
    upper, n = _counted(over)
    moved = _met(labels, upper.select(F.col("node").alias("label"), F.col("label").alias("upper")), ["label"], "left", n)
    moved = moved.select("node", F.coalesce("upper", "label").alias("label"))
    return cut(moved.union(_met(upper, labels.select("node"), ["node"], "left_anti", rows).select("node", "label")).coalesce(1 + (rows + n) // PART_ROWS))


def _members(named: DataFrame) -> DataFrame:
    """``(bucket, turn, node, weight, shared, buckets)`` of buckets with several nodes.

    ``turn`` orders leaders: first the nodes whose buckets hold most members, as the text that others were copied from
    agrees with each of them in more bands than they do with each other. ``shared`` is the weight of shingles that other
    nodes may hold, all of ``weight`` if it is not given; ``buckets`` are all buckets with several nodes that hold the node.
    """
    if "shared" not in named.columns:
        named = named.withColumn("shared", F.col("weight"))
    several = named.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = _met(named, several, ["bucket"])
    nodes = met.groupBy("node").agg(
        F.first("weight").alias("weight"), F.first("shared").alias("shared"), F.sum("n").alias("n"), F.sort_array(F.collect_list("bucket")).alias("buckets")
    )
    nodes = store(nodes.withColumn("turn", F.struct((-F.col("n")).alias("met"), F.col("node").alias("node"))), "members")
    return nodes.select(F.explode("buckets").alias("bucket"), "turn", "node", "weight", "shared", "buckets")


def _may_link(weight: str, shared: str, own: str, common: str, least: float) -> Column:
    """Whether two weights, and what of them other texts hold, allow the least similarity.

    The similarity is O / (W + V - O) for the weight O that two texts of the weights W and V have in common, and O is at
    most what either shares with any other text.
    """
    return F.least(shared, common) >= (F.col(weight) + F.col(own)) * F.lit(least / (1 + least) * (1 - 1e-6))


def _star(members: DataFrame, least: float) -> DataFrame:
    """Each member of a bucket beside the bucket's first one."""
    first = members.groupBy("bucket").agg(F.min(F.struct("turn", F.col("weight").alias("own"), F.col("shared").alias("common"))).alias("first"))
    first = first.select("bucket", F.col("first.turn.node").alias("a"), F.col("first.own").alias("own"), F.col("first.common").alias("common"))
    met = _met(members.drop("buckets"), first, ["bucket"])
    return met.where((F.col("node") != F.col("a")) & _may_link("weight", "shared", "own", "common", least)).select("a", F.col("node").alias("b")).distinct()


def _open_pairs(
    members: DataFrame, labels: DataFrame, led: DataFrame | None, leaders: int, least: float
) -> tuple[DataFrame, DataFrame]:
    """Next leaders of the buckets that hold several components, and their pairs with members of other components.

    Two members of different components have been compared once either has led the least bucket that holds both, or their
    weights alone rule a link out, so those who led are not met again, and the members of a bucket's largest component need not lead.
    """
    labels, rows = _counted(labels)
    named = _met(members, labels, ["node"], "left", rows).withColumn("label", F.coalesce("label", "node"))
    sizes = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    kinds = sizes.groupBy("bucket").agg(F.count("*").alias("kinds"), F.max_by("label", F.struct("n", "label")).alias("largest"))
    mixed = _met(named, kinds.where("kinds > 1").drop("kinds"), ["bucket"])
    if led is not None:
        mixed = _met(mixed, led, ["bucket", "node"], "left_anti")
    mixed = store(mixed, "mixed")
    order = Window.partitionBy("bucket").orderBy("turn")
    waiting = mixed.where(F.col("label") != F.col("largest")).withColumn("_n", F.row_number().over(order))
    chosen, rows = _counted(waiting.where(F.col("_n") <= leaders).select("bucket", "node", "label", "weight", "shared", "buckets"))
    other = chosen.select(
        "bucket", F.col("node").alias("leader"), F.col("label").alias("of"), F.col("weight").alias("own"),
        F.col("shared").alias("common"), F.col("buckets").alias("places"),
    )
    met = _met(mixed, other, ["bucket"], rows=4 * rows)  # a row with its buckets is some four times as long
    met = met.where((F.col("label") != F.col("of")) & _may_link("weight", "shared", "own", "common", least))
    met = met.where(F.array_min(F.array_intersect("buckets", "places")) == F.col("bucket"))
    pairs = met.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    return chosen.select("bucket", "node"), pairs


def _classes(batches: DataFrame, key: str, text: str, words: int, least: float, bands: int, rows_per_band: int, share: float) -> DataFrame:
    """``(batch, row, rank, class, first)`` of every row in the batches."""
    spark = batches.sparkSession
    facts = batches.agg(F.sum("n_bytes").alias("size"), F.sum("n_rows").alias("rows")).first()
    counted = bt.count_keys(batches, _distinct_shingles(text, words), (facts["size"] or 0) / 6).select("batch", "rows", "answers")
    sketch = _sketch(key, text, words, max(facts["rows"] or 0, 1), least, share, bands, rows_per_band)
    path = bt.scratch_path(spark, "sketches")
    counted.mapInArrow(sketch, _SKETCH).write.option("compression", "zstd").parquet(path)
    sketches = spark.read.schema(_SKETCH).parquet(path)
    # what as many documents hold as there are copies of the text is in no other text
    copies = F.least(F.count("*"), F.lit(COPIES)).cast("int")
    nodes = sketches.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("weight").alias("weight"), F.element_at(F.first("beyond"), copies).cast("double").alias("shared"), F.first("bands").alias("bands")
    )
    named = store(nodes, "nodes").select("node", "weight", "shared", F.explode(F.array_distinct("bands")).alias("bucket"))
    members = _members(named)
    texts = sketches.where(F.col("weighed").isNotNull()).groupBy("node").agg(F.first("weighed").alias("weighed"))
    texts = store(_met(texts, members.select("node").distinct(), ["node"], "left_semi"), "texts")
    labels, led, leaders = components(_links(_star(members, least), texts, least)), None, LEADERS
    while True:
        chosen, pairs = _open_pairs(members, labels, led, leaders, least)
        if chosen.isEmpty():
            break
        led = chosen if led is None else led.union(chosen)
        links = cut(_links(pairs, texts, least))
        if not links.isEmpty():
            labels = _merged(labels, links)
        leaders *= LEADERS
    rows = sketches.select("batch", "row", "rank", "node")
    # a row without a node is a class of its own
    alone = rows.where(F.col("node").isNull()).select("batch", "row", "rank", F.col("rank").alias("class"), F.lit(True).alias("first"))
    named = _met(rows.where(F.col("node").isNotNull()), labels, ["node"], "left")
    named = named.withColumn("label", F.coalesce("label", "node")).drop("node")
    place = F.struct("rank", "batch", "row")
    classes = named.groupBy("label").agg(F.min(place).alias("least"))
    joined = _met(named, classes, ["label"])
    judged = joined.select("batch", "row", "rank", F.col("least.rank").alias("class"), (place == F.col("least")).alias("first"))
    return judged.unionByName(alone)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    least: float = 0.8,
    bands: int = 24,
    rows_per_band: int = 7,
    share: float = 0.25,
) -> DataFrame:
    """``(key long, class_id long, first boolean)``, one row per row of ``docs``: its class, and whether it is the one to keep.

    Texts are linked if the weighted Jaccard similarity of their shingles reaches ``least`` and a band of their samples
    agrees (with 24 bands of 7, all but 0.4 % of the pairs at 0.8). A shingle weighs its count in the text times
    1 - ``share`` + ``share`` * idf, idf being ln((1 + N) / (1 + df)) / ln(1 + N): the share is small so
    that what a large group of copies has in common does not lose its weight. Classes are connected components
    of links; ``class_id`` is the least key of the class. ``first`` is true for exactly one row of a class, of the least key.

    ``key`` is an integer below 2^63 - 1; null ranks last, and a class of null keys alone has a null id. Texts of the same
    shingles are one class without being compared. A null text, and one without words, is a class of its own. Rows that
    share a key but not a text may be in different classes that then have the same id. Other
    columns are not read; an empty table gives an empty one.

    In each bucket all members are compared with one leader, then members of components that remain apart with
    further leaders, until every two members are linked or compared: pairs inside a component are
    not needed, and pairs of which one text shares too little weight with any other text cannot link. A pair is met in one
    bucket. Copies are one node, so a large group of them is one member.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    found = _classes(bt.store_batches(rows, "text"), "key", "text", words, least, bands, rows_per_band, share)
    real = [F.when(F.col(c) != bt.LAST_KEY, F.col(c)) for c in ("rank", "class")]
    return found.select(real[0].alias(key), real[1].alias("class_id"), "first")


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, gone in zip(batch.column(0), batch.column(1)):
            rows = bt.rows_of(data.as_buffer())
            keep = np.ones(rows.num_rows, dtype=bool)
            keep[gone.as_py() or []] = False
            kept = rows.filter(pa.array(keep))
            for begin in range(0, kept.num_rows, 1_000):
                yield kept.slice(begin, 1_000)


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs``, all columns, without the rows that :func:`near_duplicates` marks as not the first of their class."""
    batches = bt.store_batches(docs, text)
    defaults = {"words": 5, "least": 0.8, "bands": 24, "rows_per_band": 7, "share": 0.25}
    found = _classes(batches, key, text, **(defaults | settings))
    gone = found.where(~F.col("first")).groupBy("batch").agg(F.collect_list("row").alias("gone"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return batches.join(gone, "batch", "left").select("rows", "gone").mapInArrow(_kept_rows, shape)
