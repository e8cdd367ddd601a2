"""Registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm import collision_search, inner_products, language, licenses, mixing, near, packing, suffixes, token_files, units
from textlens.session import scratch_path

ENTRIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def entry(function):
    ENTRIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@entry
def op1_line_dedup(spark, sf_dir):
    """Repeated lines of all documents removed, short ones as well; the spans as text, ``start-end`` joined by commas."""
    kept = units.drop_repeated_units(_table(spark, sf_dir, "documents"))
    pairs = F.transform(F.arrays_zip("removed_starts", "removed_ends"), lambda p: F.concat_ws("-", p["removed_starts"], p["removed_ends"]))
    return kept.select("doc_id", "text", "n_units", "n_removed", F.array_join(pairs, ",").alias("removed_spans"))


ORACLES["op1_line_dedup"] = r"""WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)),
placed AS MATERIALIZED (
  SELECT *, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS unit,
    coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM lines),
judged AS (
  SELECT *, unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, pos) > 1 AS gone FROM placed)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
  count(*)::INT AS n_units, (count(*) FILTER (WHERE gone))::INT AS n_removed,
  coalesce(string_agg(begins::BIGINT || '-' || (begins + length(line))::BIGINT, ',' ORDER BY pos) FILTER (WHERE gone), '') AS removed_spans
FROM judged GROUP BY doc_id"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def crc32_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        sums = pa.array([zlib.crc32(blob.as_buffer()) for blob in batch.column(at)], pa.int64())
        yield batch.remove_column(at).append_column("ids_crc32", sums)


@entry
def op2_histogram_packing(spark, sf_dir):
    """All documents in sequences of 1,024 tokens, one row per piece."""
    return op2_rows(packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op2_rows(pieces: DataFrame) -> DataFrame:
    """A row per piece, with its offset in the sequence and the checksum of its ids."""
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, place int, ids_crc32 long"
    placed = packing.offsets(pieces.mapInArrow(crc32_of_ids, schema))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@entry
def op3_poisson_mixing(spark, sf_dir):
    """All documents mixed, the share of a source going with its number of documents to the power 0.7."""
    return mixing.poisson_mix(_table(spark, sf_dir, "documents"))


def poisson_sql(documents: str, columns: str, alpha: float = 0.7, seed: int = 17) -> str:
    """SQL of :func:`mixing.poisson_mix` over the table expression ``documents``."""
    return f"""counted AS MATERIALIZED (
  SELECT source, count(*) AS n, power(count(*)::DOUBLE, {alpha}) AS weight FROM {documents} GROUP BY source),
rates AS MATERIALIZED (
  SELECT source, weight / (SELECT sum(weight) FROM counted) * (SELECT sum(n) FROM counted) / n AS rate FROM counted),
logs AS (
  SELECT source, k, sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END) OVER (PARTITION BY source ORDER BY k) AS p
  FROM (SELECT *, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS k FROM rates)),
steps AS MATERIALIZED (SELECT source, k, sum(exp(p)) OVER (PARTITION BY source ORDER BY k) AS upto FROM logs),
stepped AS MATERIALIZED (SELECT source, list(upto ORDER BY k) AS upto FROM steps GROUP BY source),
units AS (
  SELECT d.*, ('0x' || substr(md5('{seed}:' || d.doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM {documents} d),
copies AS (
  SELECT u.*, unnest(range(1, len(list_filter(s.upto, lambda x: x <= u.u)) + 1))::INT AS copy
  FROM units u JOIN stepped s USING (source)),
mixed AS (
  SELECT {columns}, copy, md5('{seed}:order:' || doc_id || ':' || copy) AS mix_key FROM copies)"""


ORACLES["op3_poisson_mixing"] = "WITH " + poisson_sql("documents", "doc_id, text, lang, source, n_chars") + " SELECT * FROM mixed"


LANGUAGES = ("de", "en", "es", "fr")


@entry
def op4_language_id(spark, sf_dir):
    """Language of all documents and all pages; the text model is fitted on labelled documents."""
    docs = _table(spark, sf_dir, "documents")
    table = language.fit_trigrams(docs, LANGUAGES)
    texts = language.document_rows(docs).select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", *CONTEXT)
    pages = language.page_rows(_table(spark, sf_dir, "pages"))
    pages = pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", "text", *CONTEXT)
    found = language.identify_languages(texts.unionByName(pages), table, LANGUAGES)
    return found.select("doc_id", "page_id", "declared", "host", "language", "confidence", "accepted")


CONTEXT = ("declared", "host", "domain", "suffix")


@entry
def op5_inner_products(spark, sf_dir):
    """Ten largest integer inner products of every hundredth vector."""
    return inner_products.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@entry
def op6_near_duplicates(spark, sf_dir):
    """Class of near-duplicates of every document."""
    return near.near_duplicates(_table(spark, sf_dir, "documents"))


def _removal_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index
        first, last = batch.column(at("_starts")), batch.column(at("_ends"))
        gone = [sum(b) - sum(a) for a, b in zip(first.to_pylist(), last.to_pylist())]
        columns = [batch.column(at("doc_id")), batch.column(at("_n_bytes")), pa.array(gone, pa.int64())]
        columns += [pa.compute.list_value_length(first).cast(pa.int64()), suffixes.digest(batch)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


@entry
def op7_suffix_dedup(spark, sf_dir):
    """Strings of 50 bytes that start in an earlier document removed from all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffixes.remove_earlier_strings(docs)
    return kept.mapInArrow(_removal_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@entry
def op8_license_scan(spark, sf_dir):
    """Licences of all documents."""
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


@entry
def op9_token_orc(spark, sf_dir):
    """Token ids of all documents written as ORC and read back."""
    path = scratch_path(spark, "token-ids")
    token_files.write_token_ids(_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return token_files.token_places(token_files.read_token_ids(spark, path))


@entry
def op10_collision_search(spark, sf_dir):
    """Twenty nearest vectors of every twentieth vector, by counted collisions."""
    return collision_search.nearest_by_collisions(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _license_sql() -> str:
    found = " || ".join(
        f"CASE WHEN regexp_matches(s, {_quoted(p)}) THEN '<{i}>' ELSE '' END" for i, p in licenses.SENTENCES
    )
    reduced = "sentence_ids"
    for name, pattern in licenses.RULES:
        reduced = f"regexp_replace({reduced}, {_quoted(pattern)}, '[{name}]', 'g')"
    return rf"""WITH parted AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''),
    '\r?\n[ \t\r]*\n', chr(1), 'g'), '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') AS parts FROM documents),
placed AS (SELECT doc_id, parts[i] AS part, i FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM parted)),
normal AS (
  SELECT doc_id, i, regexp_replace(trim(regexp_replace(regexp_replace(lower(part), '["''`()*#;]', '', 'g'), '[\s:-]+', ' ', 'g')),
    '[.!? ]+$', '') AS s FROM placed WHERE regexp_matches(lower(part), {_quoted(licenses.KEYWORDS)})),
named AS (SELECT doc_id, string_agg({found}, '' ORDER BY i) AS ids FROM normal GROUP BY doc_id),
listed AS (
  SELECT doc_id, len(parts)::INT AS n_sentences, coalesce(ids, '') AS sentence_ids FROM parted LEFT JOIN named USING (doc_id)),
reduced AS (SELECT *, {reduced} AS r FROM listed),
split AS (
  SELECT doc_id, n_sentences, sentence_ids, array_to_string(regexp_extract_all(r, '\[([^\]]*)\]', 1), ',') AS licenses,
    regexp_replace(r, '\[[^\]]*\]', '', 'g') AS left_over FROM reduced)
SELECT *, CASE WHEN sentence_ids = '' THEN 'none'
  WHEN licenses = '' THEN CASE WHEN regexp_replace(left_over, {_quoted(licenses.NEUTRAL)}, '', 'g') <> '' THEN 'unknown' ELSE 'none' END
  WHEN regexp_replace(left_over, {_quoted(licenses.NEUTRAL)}, '', 'g') <> '' THEN 'partly' ELSE 'known' END AS verdict
FROM split"""


ORACLES["op5_inner_products"] = """WITH cells AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM cells q JOIN cells c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 10"""

ORACLES["op8_license_scan"] = _license_sql()


@entry
def op12_phrase_collocations(spark, sf_dir):
    """Each language's 2,000 strongest collocations of two and three words over all documents."""
    from textlens.llm import collocations

    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_collocations"] = r"""WITH words AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
    FROM documents)),
grams AS MATERIALIZED (
  SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM words, (VALUES (1), (2), (3)) t(s))
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE s = 1 GROUP BY lang),
cands AS MATERIALIZED (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE s >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.s, c.a, k, lg.f AS l, rg.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (lg.f::HUGEINT * rg.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, s)) AS k FROM cands) c
  JOIN grams lg ON lg.lang = c.lang AND lg.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams rg ON rg.lang = c.lang AND rg.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
outer_f AS (
  SELECT lang, phrase, max(a) AS longer_f FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cands WHERE s = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' ') AS phrase, a FROM cands WHERE s = 3) GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN outer_f o USING (lang, phrase)
  WHERE o.longer_f IS NULL OR o.longer_f * 100 < w.a * 50)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
  FROM kept k JOIN totals USING (lang)) WHERE rank <= 2000"""


@entry
def op11_token_alignment(spark, sf_dir):
    """Groups and links of two tokenizers' tokens over every document, with corpus-wide link counts."""
    from textlens.llm import alignment

    docs = _table(spark, sf_dir, "documents")
    return alignment.align_tokenizers(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@entry
def op13_language_model(spark, sf_dir):
    """log10 probability of every document under a recurrent model learnt from nine tenths of them."""
    from textlens.llm import language_model

    return language_model.score_documents(_table(spark, sf_dir, "documents"))
