"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.operators.joins import measured_join
from textlens.session import cut

# Sources up to this number are broadcast: a row holds some dozens of doubles, so a few MB at most.
BROADCAST_SOURCES = 10_000


def source_key(source: Column) -> Column:
    """Text key of a source; a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def unit_hash(seed: int, *parts: Column) -> Column:
    """Uniform number in [0, 1) from 52 bits of an md5 over the seed and the parts."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def repetition_rates(
    docs: DataFrame, weights: DataFrame | None = None, source: str = "source", alpha: float = 0.7, budget: float = 1.0
) -> DataFrame:
    """``(_key, rate)``: mean number of copies per document of each source.

    A source of n documents whose target share is p gets the rate p * budget * N / n, N being
    the number of all documents. ``weights`` has ``(source, weight)``, of which the shares are
    taken over the sources present; a source without a positive weight gets the rate 0. Without
    ``weights`` the weight is n to the power ``alpha``. Null and negative weights count as 0,
    weights of a repeated source add up; if no weight is positive, all rates are 0.
    """
    counts = docs.groupBy(source_key(F.col(source)).alias("_key")).agg(F.count("*").alias("_n"))
    if weights is None:
        weighed = counts.withColumn("_weight", F.pow(F.col("_n").cast("double"), F.lit(alpha)))
    else:
        given = weights.groupBy(source_key(F.col("source")).alias("_key")).agg(
            F.sum(F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))).alias("_weight")
        )
        weighed = counts.join(given, "_key", "left").fillna(0.0, ["_weight"])
    stored = cut(weighed)
    total = stored.agg(F.sum("_weight").alias("weight"), F.sum("_n").alias("n")).first()
    if not total["weight"]:
        return stored.select("_key", F.lit(0.0).alias("rate"))
    rate = F.col("_weight") / F.lit(total["weight"]) * F.lit(budget * total["n"]) / F.col("_n")
    return stored.select("_key", rate.alias("rate"))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``(_key, steps)``: the Poisson distribution function of each rate at 0, 1, 2, ... as an array.

    The probabilities are summed in logarithms, so large rates do not underflow; the array ends
    where the rest is below the 52 bits of :func:`unit_hash`.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 24).cast("int")
    rows = rates.where("rate > 0").select("_key", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    upto = Window.partitionBy("_key").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log(F.col("rate") / F.greatest(F.col("k"), F.lit(1))))
    logs = rows.withColumn("_log", F.sum(step).over(upto))
    sums = logs.withColumn("_cdf", F.sum(F.exp("_log")).over(upto))
    return sums.groupBy("_key").agg(F.array_sort(F.collect_list("_cdf")).alias("steps"))


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    source: str = "source",
    key: str = "doc_id",
    seed: int = 17,
    alpha: float = 0.7,
    budget: float = 1.0,
) -> DataFrame:
    """Each document repeated a Poisson number of times, all copies in one global random order.

    The number of copies inverts the Poisson distribution of the source's rate
    (:func:`repetition_rates`) at a hash of seed and ``key``, so a rerun or a retried task repeats it,
    and rows that share a key share the number. Copies are numbered from 1 in ``copy``;
    ``mix_key`` is the md5 that orders the result: rows are dealt by it to partitions and sorted
    in each. A null text, an empty or a very long one is a document like any other, a null key
    hashes as the word ``null``, an empty table stays empty. Columns of ``docs`` named ``copy``
    or ``mix_key`` are replaced.
    """
    if key not in docs.columns or source not in docs.columns:
        raise ValueError(f"documents need the columns {key} and {source}")
    steps = poisson_steps(repetition_rates(docs, weights, source, alpha, budget))
    kept = [c for c in docs.columns if c not in ("copy", "mix_key")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        source_key(F.col(source)).alias("_key"),
        unit_hash(seed, F.col(key)).alias("_unit"),
    )
    met = measured_join(rows, steps, ["_key"], limit_rows=BROADCAST_SOURCES)
    counted = met.withColumn("_copies", F.size(F.filter("steps", lambda c: c <= F.col("_unit")))).where("_copies > 0")
    copies = counted.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    texts = [F.coalesce(F.col("_row").getField(key).cast("string"), F.lit("null")), F.col("copy").cast("string")]
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), *texts)))
    mixed = keyed.repartition("mix_key").sortWithinPartitions("mix_key")
    return mixed.select(*[F.col("_row").getField(c).alias(c) for c in kept], "copy", "mix_key")
