"""Entities in texts, their co-occurrence graph, and ranks on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.operators import counted as cn
from textlens.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, measured_join, salted_join, stored_bytes, top_per_key
from textlens.operators.ordering import dense_index
from textlens.operators.rows import unnest
from textlens.session import cut, cut_counted, store

# Damping, PageRank rounds for an error below 1e-8 (0.9^175), HITS rounds.
DAMPING = 0.9
PAGERANK_ROUNDS = 175
HITS_ROUNDS = 1000

# Rounds computed in one job before the ranks are stored.
STRIDE = 8

# From this many edges on they are packed: a job a round then costs less than the joins. Fewer edges between whole
# numbers are some 16 MB at most, and a round over them is no job at all.
PACKED_EDGES = 1_000_000

# Edges packed into one row, and edges packed by one task, where the ranks fit a broadcast.
BLOCK_EDGES = 1 << 20
TASK_EDGES = 1 << 22

# Patterns tested per generated expression.
PATTERN_CHUNK = 100

# Runs of word characters; a name made of word characters only lies within one run.
_RUN = r"[\p{L}\p{N}_]+"
PLAIN_NAMES = r"^[\p{L}\p{N}_]+(\|[\p{L}\p{N}_]+)*$"


def distinct_entities(entities: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Give equal regexes one ``entity_id``, their number in regex order, so repeats never multiply rows.

    ``columns`` are kept, the smallest value of a repeated entry.
    """
    keys = ["regex", *(["type"] if "type" in entities.columns else [])]
    kept = [F.min(c).alias(c) for c in columns if c not in keys]
    unique = entities.groupBy(*keys).agg(*kept) if kept else entities.select(*keys).distinct()
    return dense_index(unique, keys, "entity_id", keep=cut)


def _pieces(word: Column, size: int) -> Column:
    """All substrings of one size."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.length(word) - (size - 1)), lambda i: F.substring(word, i, F.lit(size))
    )
    return F.when(F.length(word) >= size, cuts).otherwise(F.array().cast("array<string>"))


def _name_matches(docs: DataFrame, names: DataFrame, key: str, text: Column) -> DataFrame:
    """Names of word characters: found in the distinct words of the corpus, then joined back.

    A name occurs in a text exactly when it is a substring of one of its word runs. Substrings of
    the lengths in use are cut from each distinct word once and equi-joined with the names.
    """
    lengths = [r["n"] for r in names.select(F.length("name").alias("n")).distinct().collect()]
    runs = F.regexp_extract_all(text, F.lit(_RUN), 0)
    if not lengths:
        return docs.where("false").select(key, F.lit(0).cast("long").alias("entity_id"))
    pieces = F.array_distinct(F.flatten(F.array(*[_pieces(F.col("_word"), n) for n in sorted(lengths)])))
    shortest = min(lengths)
    distinct = cn.row_totals(docs, runs).where(F.length("term") >= shortest).select(F.col("term").alias("_word"))
    cuts = unnest(distinct, pieces, "name")
    matched, rows = cut_counted(measured_join(cuts, names, ["name"]).select("_word", "entity_id").distinct())
    # two words of a text may hold the same entity, and two texts may have one key
    if rows <= BROADCAST_ROWS and stored_bytes(matched) <= BROADCAST_BYTES:
        table = matched.select("_word", F.col("entity_id").cast("long")).toArrow()
        listed = docs.select(key, F.filter(runs, lambda w: F.length(w) >= shortest).alias("tokens"))
        words = table.column("_word").combine_chunks()
        found = cn.links_of_words(listed, words, table.column("entity_id").to_numpy(), docs.schema[key].dataType.simpleString())
        return found.select(F.col("key").alias(key), F.col("link").alias("entity_id")).distinct()
    words = unnest(docs, F.array_distinct(runs), "_word").select(key, "_word")
    return measured_join(words, matched, ["_word"], rows=rows).select(key, "entity_id").distinct()


def _pattern_matches(docs: DataFrame, patterns: list[tuple[int, str]], key: str, text: Column) -> DataFrame:
    """General regexes: literal patterns tested in one scan, a chunk per generated expression."""
    tests = []
    for start in range(0, len(patterns), PATTERN_CHUNK):
        chunk = patterns[start : start + PATTERN_CHUNK]
        tests.append(F.array(*[F.when(text.rlike(regex), F.lit(number).cast("long")) for number, regex in chunk]))
    found = F.array_compact(F.flatten(F.array(*tests)))
    return unnest(docs, found, "entity_id").select(key, "entity_id")


def entity_mentions(docs: DataFrame, entities: DataFrame, key: str = "seq", text: Column | None = None) -> DataFrame:
    """``(key, entity_id)`` of every entity whose regex occurs anywhere in the text (L1).

    ``entities`` has ``entity_id`` and ``regex``. Alternatives of plain words go through the
    words of the corpus; only other regexes, which every task has to compile anyway, are read
    by the driver and tested on each text.
    """
    text = F.col("text") if text is None else text
    stored = entities.select("entity_id", "regex")
    plain = F.col("regex").rlike(PLAIN_NAMES)
    names = stored.where(plain).select("entity_id", F.explode(F.split("regex", r"\|")).alias("name")).distinct()
    found = _name_matches(docs, names, key, text)
    others = stored.where(~plain).select("entity_id", "regex").collect()
    if others:
        by_pattern = _pattern_matches(docs, [(r["entity_id"], r["regex"]) for r in others], key, text)
        found = found.unionByName(by_pattern)
    return found


def with_support(mentions: DataFrame, threshold: int = 1) -> DataFrame:
    """Mentions of entities found in at least ``threshold`` texts (L2)."""
    enough = entity_support(mentions).where(F.col("support") >= threshold)
    return measured_join(mentions, enough.select("entity_id"), ["entity_id"], "left_semi")


def entity_support(mentions: DataFrame) -> DataFrame:
    """``(entity_id, support)``: number of texts with the entity."""
    return mentions.groupBy("entity_id").agg(F.count("*").alias("support"))


def cooccurrence(mentions: DataFrame, window: int, key: str = "seq") -> DataFrame:
    """``(src, dst, shared)`` in both directions, ``src = dst`` included (L3).

    Two tilings of the text axis, the second shifted by half a window; ``shared`` counts common
    windows of both. Windows with the same entities are counted together before their pairs are
    formed, and there is no self-join: a window's entities travel as one sorted array, no longer
    than the entities its ``window`` texts mention.
    """
    tiles = F.explode(
        F.array(
            F.struct(F.lit(1).alias("tiling"), F.floor(F.col(key) / window).alias("tile")),
            F.struct(F.lit(2).alias("tiling"), F.floor((F.col(key) + window // 2) / window).alias("tile")),
        )
    )
    placed = mentions.select("entity_id", tiles.alias("_t"))
    sets = placed.groupBy("_t").agg(F.array_sort(F.collect_set("entity_id")).alias("_set"))
    counted = sets.groupBy("_set").agg(F.count("*").alias("_n"))
    first = counted.select("_set", "_n", F.posexplode("_set").alias("_i", "src"))
    # each unordered pair once: partners at or after the own place
    rest = F.slice("_set", F.col("_i") + 1, F.size("_set"))
    half = first.select("src", F.explode(rest).alias("dst"), "_n")
    halves = half.groupBy("src", "dst").agg(F.sum("_n").alias("shared"))
    both = F.when(
        F.col("src") == F.col("dst"), F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")))
    ).otherwise(
        F.array(
            F.struct(F.col("src").alias("a"), F.col("dst").alias("b")),
            F.struct(F.col("dst").alias("a"), F.col("src").alias("b")),
        )
    )
    mirrored = halves.select(F.explode(both).alias("_p"), "shared")
    return mirrored.select(F.col("_p.a").alias("src"), F.col("_p.b").alias("dst"), "shared")


def adjacency(counts: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` of the 0/1 graph, self-loops kept (L4)."""
    return counts.where(F.col("shared") > 0).select("src", "dst")


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node"))


def _spread(edges: DataFrame, values: DataFrame, nodes: int) -> DataFrame:
    """``(node, value)``: sum over in-edges of the source's value times the edge weight.

    The values, one per node, are broadcast while they are few; edges are not shuffled for them,
    and sums are formed in each task before the exchange on the target.
    """
    side = values.select(F.col("node").alias("src"), "value")
    met = edges.join(F.broadcast(side), "src") if nodes <= BROADCAST_ROWS else salted_join(edges, side, ["src"])
    return met.groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("value") * F.col("weight")).alias("value"))


def _known_nodes(edges: DataFrame, table: DataFrame, n: int) -> pa.Array | None:
    """The sorted nodes, where ids are whole numbers and a value each can be broadcast."""
    if n > BROADCAST_ROWS or table.schema["node"].dataType.typeName() not in ("long", "integer"):
        return None
    ids = table.select("node").orderBy("node").toArrow().column("node").combine_chunks()
    return None if ids.null_count else ids


def _edge_blocks(ids: np.ndarray):
    """Edges sorted by target as rows of up to ``BLOCK_EDGES``: targets, in-edges of each, sources; places in ``ids`` as int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            src, dst = (np.concatenate([pair[i] for pair in held]) for i in (0, 1))
            starts = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]]).astype(np.int32)
            values = [dst[starts], starts, src]
            return pa.RecordBatch.from_arrays([pa.array([v.astype(np.int32).tobytes()], pa.binary()) for v in values], ["dst", "starts", "src"])

        for batch in batches:
            if batch.num_rows:
                held.append([np.searchsorted(ids, batch.column(c).to_numpy()) for c in ("src", "dst")])
                size += batch.num_rows
            if size >= BLOCK_EDGES:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    return run


def _spreader(edges: DataFrame, ids: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function from a value per node to the sum over each node's in-edges of the source's value.

    Edges are stored once, packed by target, and stay where they are: a call broadcasts the
    values and brings back one sum per target and block. Fewer than ``PACKED_EDGES`` edges are held by the driver.
    """
    spark = edges.sparkSession
    whole = edges.where("src is not null and dst is not null").select(F.col("src").cast("long"), F.col("dst").cast("long"))
    stored = store(whole, "edges")
    count = stored.count()
    if count < PACKED_EDGES:
        few = stored.toArrow()
        src, dst = (np.searchsorted(ids, few.column(c).to_numpy()) for c in ("src", "dst"))
        return lambda values: np.bincount(dst, values[src], len(ids))
    parts = max(-(-count // TASK_EDGES), spark.sparkContext.defaultParallelism)
    placed = stored.repartition(parts, "dst").sortWithinPartitions("dst")
    packed = store(placed.mapInArrow(_edge_blocks(ids), "dst binary, starts binary, src binary"), "packed-edges")

    def spread(values: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dst, starts, src in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                    met = shared.value[np.frombuffer(src, np.int32)]
                    sums = np.add.reduceat(met, np.frombuffer(starts, np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([dst]), pa.array([sums.tobytes()])], ["dst", "sums"])

        out = np.zeros(len(ids))
        for row in packed.mapInArrow(run, "dst binary, sums binary").toArrow().to_pylist():
            out[np.frombuffer(row["dst"], np.int32)] += np.frombuffer(row["sums"])
        shared.destroy()
        return out

    return spread


def _node_values(table: DataFrame, ids: pa.Array, values: dict[str, np.ndarray]) -> DataFrame:
    kind = table.schema["node"].dataType
    frame = table.sparkSession.createDataFrame(pa.table({"node": ids, **{k: pa.array(v) for k, v in values.items()}}))
    return frame.select(F.col("node").cast(kind).alias("node"), *values)


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / (values.sum() or 1.0)


def _packed_pagerank(edges, table, ids, rounds, damping, tolerance, stride) -> DataFrame:
    """:func:`pagerank` where the ranks fit a broadcast."""
    n, places = len(ids), ids.to_numpy()
    known = table.where("degree is not null").select(F.col("node").cast("long"), F.col("degree").cast("double")).toArrow()
    degree = np.ones(n)
    degree[np.searchsorted(places, known.column("node").to_numpy())] = known.column("degree").to_numpy()
    spread = _spreader(edges, places)
    values = before = np.full(n, 1.0 / n)
    for number in range(1, rounds + 1):
        values = (1 - damping) / n + damping * spread(values / degree)
        if number % stride == 0 or number == rounds:
            if tolerance is not None and np.abs(values - before).sum() < tolerance:
                break
            before = values
    return _node_values(table, ids, {"rank": _scaled(values) if known.num_rows < n else values})


def _packed_hits(edges, table, ids, rounds, tolerance, stride) -> DataFrame:
    """:func:`hits` where the ranks fit a broadcast."""
    n, places = len(ids), ids.to_numpy()
    forward = _spreader(edges, places)
    backward = _spreader(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), places)
    hubs = before = np.full(n, 1.0 / n)
    authorities, done = hubs, 0
    while done < rounds:
        steps = min(stride, rounds - done)
        for _ in range(steps):
            authorities = forward(hubs)
            hubs = backward(authorities)
        hubs = _scaled(hubs)
        done += steps
        if tolerance is not None and np.abs(hubs - before).sum() < tolerance:
            break
        before = hubs
    return _node_values(table, ids, {"hubs": hubs, "authorities": _scaled(authorities)})


def pagerank(
    edges: DataFrame,
    rounds: int = PAGERANK_ROUNDS,
    damping: float = DAMPING,
    tolerance: float | None = None,
    nodes: DataFrame | None = None,
    stride: int = STRIDE,
) -> DataFrame:
    """``(node, rank)`` with uniform teleport, summing to 1.

    Runs ``rounds`` rounds, or stops at a stored round once ranks moved by less than ``tolerance``
    (L1) since the one before. Ranks of whole numbers that fit a broadcast meet the
    edges in :func:`_spreader`; others are joined, and stored every ``stride`` rounds, which keeps plans short
    and lets a lost executor be replaced. ``nodes`` adds nodes without edges. Nodes without out-edges spread
    their rank evenly: that adds the same to every node, so the ranks are those of the rounds without
    it, scaled to the sum of 1.
    """
    named = _ends(edges) if nodes is None else _ends(edges).union(nodes.select("node"))
    degrees = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    table, n = cut_counted(named.distinct().join(degrees, "node", "left"))
    if n == 0:
        return table.select("node", F.lit(0.0).alias("rank"))
    ids = _known_nodes(edges, table, n)
    if ids is not None:
        return _packed_pagerank(edges, table, ids, rounds, damping, tolerance, stride)
    shares = degrees.select(F.col("node").alias("src"), (1 / F.col("degree")).alias("weight"))
    weighted = measured_join(edges, shares, ["src"])
    # an edge of weight 0 to itself keeps a node without in-edges in every round
    anchors = table.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("weight"))
    stored = cut(weighted.select("src", "dst", "weight").unionByName(anchors))
    dangling = table.where("degree is null").limit(1).count()
    values = table.select("node", F.lit(1.0 / n).alias("value"))
    before = values
    for number in range(1, rounds + 1):
        values = _spread(stored, values, n).select("node", (F.lit((1 - damping) / n) + damping * F.col("value")).alias("value"))
        if number % stride == 0 or number == rounds:
            values = cut(values)
            if tolerance is not None and _moved(before, values) < tolerance:
                break
            before = values
    if dangling:
        values = _unit_sum(values)
    return values.select("node", F.col("value").alias("rank"))


def _moved(before: DataFrame, after: DataFrame) -> float:
    both = before.select("node", F.col("value").alias("_old")).join(after, "node")
    return both.agg(F.sum(F.abs(F.col("value") - F.col("_old")))).first()[0] or 0.0


def hits(
    edges: DataFrame, rounds: int = HITS_ROUNDS, tolerance: float | None = None, stride: int = STRIDE
) -> DataFrame:
    """``(node, hubs, authorities)``, each summing to 1.

    One round: authorities are the sums of hubs along edges, hubs the sums of authorities against
    them. Scaling commutes with both, so it is applied once per stored stride.
    """
    table, n = cut_counted(_ends(edges).distinct())
    if n == 0:
        return table.select("node", F.lit(0.0).alias("hubs"), F.lit(0.0).alias("authorities"))
    ids = _known_nodes(edges, table, n)
    if ids is not None:
        return _packed_hits(edges, table, ids, rounds, tolerance, stride)
    anchors = table.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("weight"))
    forward = cut(edges.select("src", "dst", F.lit(1.0).alias("weight")).unionByName(anchors))
    backward = forward.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    hubs = table.select("node", F.lit(1.0 / n).alias("value"))
    before, done = hubs, 0
    while done < rounds:
        steps = min(stride, rounds - done)
        for _ in range(steps - 1):
            hubs = _spread(backward, _spread(forward, hubs, n), n)
        authorities = cut(_spread(forward, hubs, n))
        hubs = _unit_sum(cut(_spread(backward, authorities, n)))
        done += steps
        if tolerance is not None and _moved(before, hubs) < tolerance:
            break
        before = hubs
    return hubs.select("node", F.col("value").alias("hubs")).join(
        _unit_sum(authorities).select("node", F.col("value").alias("authorities")), "node"
    )


def _unit_sum(values: DataFrame) -> DataFrame:
    total = values.agg(F.sum("value")).first()[0] or 1.0
    return values.select("node", (F.col("value") / total).alias("value"))


def entity_ranks(entities: DataFrame, pageranks: DataFrame, hits_ranks: DataFrame) -> DataFrame:
    """``(entity_id, element, rank, hubs, authorities)``, joined by id."""
    return (
        entities.select("entity_id", F.col("regex").alias("element"))
        .join(pageranks.withColumnRenamed("node", "entity_id"), "entity_id")
        .join(hits_ranks.withColumnRenamed("node", "entity_id"), "entity_id")
    )


def rank_lookup(ranks: DataFrame, pattern: str) -> DataFrame:
    """Ranks of entities whose regex text matches ``pattern``."""
    return ranks.where(F.col("element").rlike(pattern))


def display_name(element: Column) -> Column:
    """Text before the first ``|``."""
    return F.split_part(element, F.lit("|"), F.lit(1))


def query_entities(
    queries: DataFrame, ranks: DataFrame, text: Column | None = None, digits: int = 10
) -> DataFrame:
    """``(query_id, position, name, rank, hubs)`` of the entities in each query, best rank first."""
    dictionary = ranks.select("entity_id", F.col("element").alias("regex"))
    mentions = entity_mentions(queries, dictionary, "query_id", text)
    placed = measured_join(mentions, ranks, ["entity_id"]).withColumn("rank", F.round("rank", digits))
    order = Window.partitionBy("query_id").orderBy(F.desc("rank"), F.asc("element"))
    return placed.select(
        "query_id",
        (F.row_number().over(order) - 1).alias("position"),
        display_name(F.col("element")).alias("name"),
        "rank",
        "hubs",
    )


def typed_query_entities(
    queries: DataFrame, ranks_by_type: dict[str, DataFrame], text: Column | None = None, digits: int = 10
) -> DataFrame:
    """:func:`query_entities` per type, positions starting at 0 in each."""
    out = None
    for kind, ranks in ranks_by_type.items():
        found = query_entities(queries, ranks, text, digits).withColumn("type", F.lit(kind))
        out = found if out is None else out.unionByName(found)
    return out


def close_entities(counts: DataFrame, k: int) -> DataFrame:
    """``(src, rank, dst, shared)``: the ``k`` entities sharing most windows with each."""
    others = counts.where(F.col("src") != F.col("dst"))
    best = top_per_key(others, ["src"], [F.desc("shared"), F.asc("dst")], k)
    return best.select("src", "rank", "dst", "shared")


def entity_graph(
    docs: DataFrame,
    entities: DataFrame,
    window: int,
    threshold: int = 1,
    key: str = "seq",
    text: Column | None = None,
) -> DataFrame:
    """Stored co-occurrence counts of the entities with enough support."""
    mentions = entity_mentions(docs, entities, key, text)
    if threshold > 1:
        mentions = with_support(mentions, threshold)
    return cut(cooccurrence(mentions, window, key))
