"""Language of texts: the text's likelihood fused with declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.batches import release, slices
from textlens.operators.joins import measured_join
from textlens.session import cut, store

# Hashed trigrams of bytes.
TRIGRAM_BITS = 15

# Bytes of the texts that are lower-cased together.
SLICE = 4 << 20

# Bytes scored at once.
CHUNK = 1 << 18

# The class of what is none of the languages: every trigram is as likely as any other.
UNKNOWN = "und"

# Context tables of up to this many rows are broadcast: some hundred bytes a row.
BROADCAST_CONTEXTS = 20_000


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts, null as empty, and where each begins and ends."""
    texts = pc.fill_null(pc.utf8_lower(column.cast(pa.large_string())), "")
    texts = pa.concat_arrays([texts])  # offsets from 0
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that begins at each byte but the last two."""
    wide = data.astype(np.uint32)
    codes = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(slices(b, 1, SLICE) for b in batches):
        data, offsets = _lowered(batch.column(1))
        found = {}
        for row, label in enumerate(batch.column(0).to_pylist()):
            part = data[offsets[row] : offsets[row + 1]]
            if len(part) >= 3:
                sums = np.bincount(_trigrams(part), minlength=1 << TRIGRAM_BITS)
                found[label] = found[label] + sums if label in found else sums
        for label, sums in found.items():
            at = np.flatnonzero(sums)
            columns = [pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "bucket", "n"])


def fit_trigrams(
    labelled: DataFrame, languages: Sequence[str], key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = 500
) -> np.ndarray:
    """Log-probabilities of the trigram buckets, one row per language and a last one for :data:`UNKNOWN`.

    Fitted on at most ``per_language`` labelled rows of each language, the ones with the smallest hash of
    their key. Counts are smoothed by a half; a language without rows gets even probabilities.
    """
    rows = labelled.where(F.col(label).isin(*languages) & F.col(text).isNotNull())
    ranked = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    chosen = rows.select(key, label).withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= per_language)
    chosen = F.broadcast(cut(chosen.select(key, label).distinct()))  # per_language rows a language
    sample = rows.join(chosen, [key, label], "left_semi").select(F.col(label).alias("label"), F.col(text).alias("text"))
    counts = sample.mapInArrow(_counted, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages) + 1, 1 << TRIGRAM_BITS), 0.5)
    for row in counts.collect():  # at most one row per language and bucket
        table[languages.index(row["label"]), row["bucket"]] += row["n"]
    table[-1] = 1.0
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _posterior(logs: np.ndarray) -> np.ndarray:
    parts = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-np.inf))
    return parts / parts.sum(axis=1, keepdims=True)


def _lists(matrix: np.ndarray) -> pa.Array:
    size = matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, size, dtype=np.int32)), pa.array(matrix.ravel()))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column, a null one as missing numbers."""
    out = np.full((len(column), size), np.nan)
    real = column.is_valid().to_numpy(zero_copy_only=False)
    out[real] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return out


def _likelihood(table: np.ndarray, power: float):
    """Evidence and posterior of a column of texts."""

    def part(column: pa.Array) -> pa.StructArray:
        data, offsets = _lowered(column)
        count = np.maximum(np.diff(offsets) - 2, 0)
        evidence = np.zeros((len(column), len(table)))
        for begin in range(0, len(data) - 2, CHUNK):  # texts of any length, some bytes at a time
            buckets = _trigrams(data[begin : begin + CHUNK + 2])
            first = np.clip(offsets[:-1] - begin, 0, len(buckets))
            last = np.clip(offsets[:-1] + count - begin, first, len(buckets))
            held = np.flatnonzero(last > first)
            if not len(held):
                continue
            # sums over [first, last) of each text; the trigrams across texts fall between
            edges = np.stack([first[held], last[held]], axis=1).ravel()
            edges = edges[:-1] if edges[-1] == len(buckets) else edges
            for i, row in enumerate(table):
                evidence[held, i] += np.add.reduceat(row[buckets], edges, dtype=np.float64)[::2]
        evidence *= (np.maximum(count, 1.0) ** (power - 1.0))[:, None]
        return pa.StructArray.from_arrays([_lists(evidence), _lists(_posterior(evidence))], ["evidence", "soft"])

    def run(texts: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [part(batch.column(0)) for batch in slices(whole, 0, SLICE)]
        release()
        return pa.concat_arrays(parts or [part(texts)])

    return F.arrow_udf(run, "struct<evidence: array<double>, soft: array<double>>")


def _fuse(names: list[str], totals: np.ndarray, pull: float, least: float):
    general = (totals + 1.0) / (totals.sum() + len(names))

    def share(held: np.ndarray, own: np.ndarray, prior: np.ndarray) -> np.ndarray:
        others = np.maximum(held - own, 0.0)
        drawn = (others + pull * prior) / (others.sum(axis=1, keepdims=True) + pull)
        return np.where(np.isnan(held), prior, drawn)

    def frequency(held: np.ndarray) -> np.ndarray:
        even = held.sum(axis=1, keepdims=True) / max(totals.sum(), 1e-9)
        return np.where(np.isnan(held), 0.0, np.log((held + pull * even) / (totals + pull)))

    def run(evidence: pa.Array, soft: pa.Array, declared: pa.Array, suffix: pa.Array, domain: pa.Array, host: pa.Array) -> pa.Array:
        own, declared, suffix, domain, host = (_matrix(c, len(names)) for c in (soft, declared, suffix, domain, host))
        prior = share(host, own, share(domain, own, np.broadcast_to(general, own.shape)))
        logs = _matrix(evidence, len(names)) + np.log(prior) + frequency(declared) + frequency(suffix)
        found = _posterior(logs)
        best = found.argmax(axis=1)
        sure = found[np.arange(len(best)), best]
        kept = (best < len(names) - 1) & (sure >= least)
        columns = [pa.array(names, pa.string()).take(pa.array(best)), pa.array(sure), pa.array(kept)]
        return pa.StructArray.from_arrays(columns, ["language", "confidence", "accepted"])

    return F.arrow_udf(run, "struct<language: string, confidence: double, accepted: boolean>")


def _context_key(*columns: str) -> Column:
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in columns])


def identify_languages(
    rows: DataFrame,
    table: np.ndarray,
    languages: Sequence[str],
    text: str = "text",
    declared: str = "declared",
    host: str = "host",
    domain: str = "domain",
    suffix: str = "suffix",
    power: float = 0.7,
    pull: float = 10.0,
    least: float = 0.5,
) -> DataFrame:
    """All columns of ``rows`` but the text, with ``language``, ``confidence`` and ``accepted``.

    Four kinds of evidence are multiplied for every language and for :data:`UNKNOWN`:

    * the text: the trigram likelihood of ``table``, to the power n^(``power`` - 1) for n trigrams, as they overlap;
    * ``declared``: how often rows that the text gives to the language declare the same;
    * ``suffix`` of the address: the same;
    * the host's prior: languages of the host's other rows, drawn by ``pull`` imaginary rows towards those of its
      domain, which are drawn in the same way towards those of all rows.

    The frequencies are sums of the text's posteriors over all rows, by grouped aggregation. A null
    context column is no evidence. Null, empty and one- or two-byte texts speak through the other evidence alone.
    ``accepted`` needs a language other than :data:`UNKNOWN` and a ``confidence`` of ``least``; ties go to the earlier language. Rows are
    judged one by one, so repeated rows get the same answer; an empty table gives an empty one. Columns named like the results
    are replaced.
    """
    names = [*languages, UNKNOWN]
    size = range(len(names))
    kept = [c for c in rows.columns if c not in (text, "language", "confidence", "accepted")]
    if not kept:
        raise ValueError("rows need a column beside the text")
    carried = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(text).alias("text"))
    # Only the texts go through Python; the other columns, which may hold the text again, stay beside it.
    scored = carried.select("row", _likelihood(table, power)("text").alias("found")).select("row", "found.evidence", "found.soft")
    contexts = [(n, c) for n, c in (("declared", declared), ("host", host), ("domain", domain), ("suffix", suffix))]
    fields = [(F.col("row").getField(c) if c in kept else F.lit(None)).cast("string").alias(n) for n, c in contexts]
    scored = store(scored.select("row", "evidence", "soft", *fields), "evidence")
    marked = scored.withColumn("context", _context_key("declared", "host", "domain", "suffix"))

    def sums(frame: DataFrame, keys: Sequence[str], source: str, to: str) -> DataFrame:
        added = frame.groupBy(*keys).agg(*[F.sum(F.col(source)[i]).alias(f"_{i}") for i in size])
        return added.select(*keys, F.array(*[f"_{i}" for i in size]).alias(to))

    groups = store(sums(marked, ["context", "declared", "host", "domain", "suffix"], "soft", "sums"), "contexts")
    overall = groups.agg(*[F.sum(F.col("sums")[i]).alias(f"_{i}") for i in size]).first()
    totals = np.array([overall[i] or 0.0 for i in size])
    known = groups
    for name, keys in (("declared", ["declared"]), ("suffix", ["suffix"]), ("domain", ["domain"]), ("host", ["host", "domain"])):
        part = sums(groups.where(F.col(name).isNotNull()), keys, "sums", f"{name}_sums")
        part = part.withColumn("_at", _context_key(*keys)).drop(*keys)
        known = measured_join(known.withColumn("_at", _context_key(*keys)), part, ["_at"], "left", BROADCAST_CONTEXTS).drop("_at")
    held = [f"{n}_sums" for n in ("declared", "suffix", "domain", "host")]
    met = measured_join(marked, known.select("context", *held), ["context"], limit_rows=BROADCAST_CONTEXTS)
    fused = met.select("row", _fuse(names, totals, pull, least)("evidence", "soft", *held).alias("found"))
    return fused.select(*[F.col("row").getField(c).alias(c) for c in kept], "found.language", "found.confidence", "found.accepted")


def page_rows(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages with ``text`` (markup removed), ``declared`` language, ``host``, ``domain`` and ``suffix``.

    What a page doesn't say is null: no ``lang`` on its ``html`` element, no host in its address.
    """
    address = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    spoken = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1))
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    found = pages.withColumn("text", F.regexp_replace(bare, r"&#?\w+;", " ")).withColumn("declared", F.when(spoken != "", spoken))
    found = found.withColumn("host", F.when(address != "", address))
    labels = F.split("host", r"\.")
    found = found.withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))
    return found.withColumn("suffix", F.element_at(labels, -1)).drop(html)


def document_rows(docs: DataFrame, label: str = "lang", source: str = "source") -> DataFrame:
    """Documents with their label as declared language and their source as host, without an address."""
    nothing = F.lit(None).cast("string")
    return docs.withColumns({"declared": F.lower(label), "host": F.col(source), "domain": nothing, "suffix": nothing})
