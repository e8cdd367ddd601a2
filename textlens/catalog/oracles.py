"""DuckDB SQL for the registered queries, composed from shared common table expressions.

The SQL states each result from its definition (positions by window functions, pairs by joins),
not by the steps the Spark plans take.
"""

from __future__ import annotations

from textlens.catalog import inputs
from textlens.functions.text import SPACING_RULES, UNIFIED_CHARACTERS

ORACLES: dict[str, str] = {}

# Rounds after which the compared digits no longer change; the Spark side stops by itself.
_PAGERANK_ROUNDS = 175
_HITS_ROUNDS = 1000


def _with(*tables: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(tables) + "\n" + select


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---------------------------------------------------------------- extraction

_SEGMENTS = r"""elements AS MATERIALIZED (
  SELECT page_id, unnest(x) AS e, generate_subscripts(x, 1) - 1 AS pos FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(html, '</?(b|i|br)(\s[^>]*)?/?>', '', 'g'), '<(?:h1|p)(?:\s[^>]*)?>[^<]*') AS x
    FROM pages)),
segments AS (
  SELECT page_id, pos::INT AS pos, regexp_extract(e, '^<([^>\s]*)', 1) AS kind,
    replace(replace(replace(replace(replace(list_reduce(list_prepend(regexp_replace(e, '^<[^>]*>', ''),
      regexp_extract_all(e, '&#[0-9]+;')), lambda t, r: replace(t, r, chr(r[3:-2]::INT))),
      '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&apos;', chr(39)), '&amp;', '&') AS text FROM elements)"""

ORACLES["html_segments"] = _with(_SEGMENTS, select="SELECT page_id, pos, kind, text FROM segments")

ORACLES["heading_ffill"] = _with(
    _SEGMENTS,
    select="""SELECT page_id, pos, text, label FROM (
  SELECT *, last_value(CASE WHEN kind = 'h1' THEN text END IGNORE NULLS)
    OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS label FROM segments)
WHERE label IS NOT NULL AND kind <> 'h1'""",
)

ORACLES["label_filter"] = """SELECT doc_id, source AS label FROM documents
WHERE source NOT IN ('src3', 'src17') AND source LIKE 'src1%'"""

_FRAGMENTS = """fragments AS MATERIALIZED (
  SELECT doc_id, unnest(x) AS text, (generate_subscripts(x, 1) - 1)::INT AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))"""

_JOINED = """paired AS (
  SELECT doc_id, pos, text, contains(text, ',') AS whole,
         lag(text) OVER w AS before, lag(contains(text, ',')) OVER w AS before_whole
  FROM fragments WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
joined AS MATERIALIZED (
  SELECT doc_id, pos, CASE WHEN NOT before_whole AND before <> '' THEN before || ' ' || text ELSE text END AS text
  FROM paired WHERE whole)"""

ORACLES["join_fragments"] = _with(_FRAGMENTS, _JOINED, select="SELECT doc_id, pos, text FROM joined")

_HALVES = r"""halves AS MATERIALIZED (
  SELECT doc_id, pos, x[1] AS half1, x[2] AS half2,
    array_to_string(list_transform(x, lambda t: regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), ' - ') AS text
  FROM (SELECT doc_id, pos, string_split(text, ',') AS x FROM joined))"""

ORACLES["split_couplets"] = _with(
    _FRAGMENTS,
    _JOINED,
    _HALVES,
    select="SELECT doc_id, pos, half1, half2, half1 || ' ' || half2 AS beyt, text FROM halves",
)

ORACLES["corpus_seq"] = _with(
    _FRAGMENTS, _JOINED, select="SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) - 1 AS seq FROM joined"
)

# ---------------------------------------------------------------- tokens and vocabulary


def _normalized(column: str) -> str:
    sources = "".join(a for a, _ in UNIFIED_CHARACTERS)
    targets = "".join(b for _, b in UNIFIED_CHARACTERS)
    out = f"translate({column}, {_quote(sources)}, {_quote(targets)})"
    for pattern, replacement in SPACING_RULES:
        out = f"regexp_replace({out}, {_quote(pattern)}, {_quote(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return out


ORACLES["normalize_text"] = f"SELECT doc_id, {_normalized('text')} AS text FROM documents"


def _tokens(name: str, source: str, key: str, pattern: str = r"[\p{L}\p{N}_]{2,}", text: str = "lower(text)") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, unnest(x) AS t, generate_subscripts(x, 1) AS p
  FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS x FROM {source}))"""


_TOK = _tokens("tok", "documents", "doc_id")

_STOP = f"""stop AS MATERIALIZED (
  SELECT t FROM (SELECT t, count(DISTINCT doc_id) AS df FROM tok GROUP BY t) ORDER BY df DESC, t LIMIT {inputs.STOP_WORDS})"""


def _grams(name: str, tokens: str, key: str, stop: bool = True) -> str:
    """Counts of 1- and 2-grams over tokens without stop words."""
    where = "WHERE t NOT IN (SELECT t FROM stop)" if stop else ""
    return f"""{name}_kept AS MATERIALIZED (SELECT * FROM {tokens} {where}),
{name} AS MATERIALIZED (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, t AS term FROM {name}_kept
    UNION ALL
    SELECT {key}, t || ' ' || t2 FROM (
      SELECT *, lead(t) OVER (PARTITION BY {key} ORDER BY p) AS t2 FROM {name}_kept) WHERE t2 IS NOT NULL)
  GROUP BY {key}, term)"""


_TF = _grams("tf", "tok", "doc_id")

_VOCAB = """vocab AS MATERIALIZED (
  SELECT term, tf_total, df, ln((1 + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1 AS idf FROM (
    SELECT term, sum(tf)::BIGINT AS tf_total, count(*) AS df FROM tf GROUP BY term)
  ORDER BY tf_total DESC, term LIMIT 10000)"""

_FIT = [_TOK, _STOP, _TF, _VOCAB]

ORACLES["tokenize"] = _with(_TOK, select="SELECT doc_id, (p - 1)::INT AS pos, t AS token FROM tok")

ORACLES["remove_stopwords"] = _with(
    _TOK,
    _STOP,
    select="""SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1)::INT AS pos, t AS token
FROM tok WHERE t NOT IN (SELECT t FROM stop)""",
)

ORACLES["ngrams"] = _with(
    _TOK,
    select="""SELECT doc_id, (p - 1)::INT AS pos, t AS term FROM tok
UNION ALL
SELECT doc_id, (n + p - 1)::INT, t || ' ' || t2 FROM (
  SELECT *, lead(t) OVER (PARTITION BY doc_id ORDER BY p) AS t2, count(*) OVER (PARTITION BY doc_id) AS n FROM tok)
WHERE t2 IS NOT NULL""",
)

ORACLES["vocabulary_topn"] = _with(*_FIT, select="SELECT term, tf_total, df FROM vocab")

ORACLES["word_counts"] = _with(
    _FRAGMENTS,
    _JOINED,
    _HALVES,
    select=r"""SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(h, '[\s\p{Z}]+')) AS word
  FROM (SELECT half1 AS h FROM halves UNION ALL SELECT half2 FROM halves))
WHERE word <> '' GROUP BY word""",
)

ORACLES["term_counts"] = _with(*_FIT, select="SELECT doc_id, term, tf FROM tf JOIN vocab USING (term)")

_WORD = r"[\p{L}\p{N}\p{M}\x{200c}_]+"

_FULLTEXT = [
    _tokens("words", "documents", "doc_id", _WORD),
    """ft AS MATERIALIZED (
  SELECT doc_id, t AS term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY doc_id)::BIGINT AS dl
  FROM words GROUP BY doc_id, t)""",
    """known AS MATERIALIZED (SELECT term, sum(tf)::BIGINT AS count, count(*) AS df FROM ft GROUP BY term)""",
    """corpus AS MATERIALIZED (
  SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words)::DOUBLE / (SELECT count(*) FROM documents) AS avgdl)""",
]

ORACLES["build_postings"] = _with(*_FULLTEXT, select="SELECT doc_id, term, tf, dl FROM ft")

# ---------------------------------------------------------------- weights and vectors

ORACLES["smoothed_idf"] = _with(*_FIT, select="SELECT term, df, round(idf, 6) AS idf FROM vocab")


def _tfidf(name: str, counts: str, key: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS w FROM (
    SELECT {key}, term, tf, (1 + ln(tf)) * idf AS raw FROM {counts} JOIN vocab USING (term)))"""


def _boolean(name: str, counts: str, key: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, term, 1 / sqrt(count(*) OVER (PARTITION BY {key})) AS w FROM {counts} JOIN vocab USING (term))"""


ORACLES["tfidf_weights"] = _with(
    *_FIT, _tfidf("weights", "tf", "doc_id"), select="SELECT doc_id, term, tf, round(w, 6) AS w FROM weights"
)

_VEC_COLUMNS = ", ".join(
    f"('0x' || substr(md5(term), {4 * i + 1}, 4))::BIGINT / 32767.5::DOUBLE - 1 AS v{i}" for i in range(inputs.WORD_DIMENSION)
)
_WORD_VECTORS = f"wv AS MATERIALIZED (SELECT term, idf, {_VEC_COLUMNS} FROM vocab)"

_UNIGRAM_VOCAB = """tf AS MATERIALIZED (SELECT doc_id, t AS term, count(*) AS tf FROM tok GROUP BY doc_id, t)"""

ORACLES["load_word_vectors"] = _with(
    _TOK,
    _UNIGRAM_VOCAB,
    _VOCAB.replace("LIMIT 10000", ""),
    _WORD_VECTORS,
    select=" UNION ALL ".join(
        f"SELECT term AS word, {i}::INT AS dim, round(v{i}::FLOAT::DOUBLE, 4) + 0.0 AS value FROM wv"
        for i in range(inputs.WORD_DIMENSION)
    ),
)


def _mean_vectors(name: str, source: str, key: str) -> str:
    """Mean of vector times idf over all tokens, one row per key and dimension."""
    dims = ", ".join(f"coalesce(sum(v{i} * idf), 0) / count(*) AS m{i}" for i in range(inputs.WORD_DIMENSION))
    pairs = " UNION ALL ".join(
        f"SELECT {key}, {i}::INT AS dim, m{i} AS value FROM {name}_wide" for i in range(inputs.WORD_DIMENSION)
    )
    tokens = _tokens(f"{name}_tok", source, key, r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]", "text")
    return f"""{tokens},
{name}_wide AS MATERIALIZED (SELECT {key}, {dims} FROM {name}_tok LEFT JOIN wv ON t = term GROUP BY {key}),
{name} AS MATERIALIZED ({pairs})"""


ORACLES["word_embedding_docs"] = _with(
    *_FIT,
    _WORD_VECTORS,
    _mean_vectors("dv", "documents", "doc_id"),
    select="SELECT doc_id, dim, round(value, 6) + 0.0 AS value FROM dv",
)

# ---------------------------------------------------------------- search

_QUERIES = "queries AS MATERIALIZED (SELECT item_id AS query_id, text FROM benchmark)"
_QUERY_TF = [_QUERIES, _tokens("qtok", "queries", "query_id"), _grams("qtf", "qtok", "query_id")]


def _ranked(name: str, scores: str, k: int, key: str = "doc_id") -> str:
    """First ``k`` documents of each query by rounded score."""
    return f"""{name} AS MATERIALIZED (
  SELECT query_id, rank - 1 AS rank, {key}, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS rank FROM (
      SELECT query_id, {key}, round(s, 6) AS score FROM ({scores})))
  WHERE rank <= {k})"""


_DOT = "SELECT query_id, doc_id, sum(q.w * d.w) AS s FROM {q} q JOIN {d} d USING (term) GROUP BY query_id, doc_id"

_TFIDF_HITS = [
    _tfidf("dw", "tf", "doc_id"),
    _tfidf("qw", "qtf", "query_id"),
    _ranked("tfidf_hits", _DOT.format(q="qw", d="dw"), 20),
]
_BOOLEAN_HITS = [
    _boolean("dbool", "tf", "doc_id"),
    _boolean("qbool", "qtf", "query_id"),
    _ranked("boolean_hits", _DOT.format(q="qbool", d="dbool"), 20),
]


def _hits_with_label(name: str) -> str:
    return f"""SELECT query_id, rank::INT AS rank, doc_id, source AS label, score
FROM {name} JOIN documents USING (doc_id)"""


ORACLES["tfidf_search"] = _with(*_FIT, *_QUERY_TF, *_TFIDF_HITS, select=_hits_with_label("tfidf_hits"))
ORACLES["boolean_search"] = _with(*_FIT, *_QUERY_TF, *_BOOLEAN_HITS, select=_hits_with_label("boolean_hits"))
ORACLES["score_query_stream"] = _with(
    *_FIT, *_QUERY_TF, *_TFIDF_HITS, select="SELECT query_id, rank::INT AS rank, doc_id, score FROM tfidf_hits"
)

_TF_PART = "tf / (tf + 1.2 * (0.25 + 0.75 * dl / (SELECT avgdl FROM corpus)))"
_IDF_PART = "ln(1 + ((SELECT n FROM corpus) - df + 0.5) / (df + 0.5::DOUBLE))"


def _query_words(source: str) -> list[str]:
    return [
        _tokens("qwtok", source, "query_id", _WORD),
        "qwords AS MATERIALIZED (SELECT query_id, t AS word, count(*) AS n FROM qwtok GROUP BY query_id, t)",
    ]


_BM25_HITS = [
    *_query_words("queries"),
    f"bm25w AS MATERIALIZED (SELECT query_id, term, n * {_IDF_PART} AS w FROM qwords JOIN known ON word = term)",
    _ranked(
        "bm25_hits",
        f"SELECT query_id, doc_id, sum(q.w * {_TF_PART}) AS s FROM bm25w q JOIN ft USING (term) GROUP BY query_id, doc_id",
        10,
    ),
]

ORACLES["bm25_search"] = _with(*_FULLTEXT, _QUERIES, *_BM25_HITS, select=_hits_with_label("bm25_hits"))

_MISSPELT = r"""queries AS MATERIALIZED (
  SELECT item_id AS query_id,
    regexp_replace(text, '([\p{L}\p{N}_])[\p{L}\p{N}_]([\p{L}\p{N}_]{2,})', '\1\2', 'g') AS text
  FROM benchmark)"""

# DuckDB's levenshtein compares bytes: the test texts' letters beyond ASCII become one byte each.
_WIDE = "ßäçèéêíñóöüÄÇÈÉÊÍÑÓÖÜ"
_BYTES = "".join(chr(c) for c in [*range(1, 9), *range(14, 27)])


def _expanded(terms: str, words: str) -> list[str]:
    """Matches ``(term, match, edits, count)`` of distinct terms in a word table, at most 50 each."""
    narrow = f"translate({{}}, '{_WIDE}', '{_BYTES}')"
    return [
        f"""budget AS MATERIALIZED (
  SELECT word AS term, {narrow.format('word')} AS a, length(word) AS la,
    CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END AS k
  FROM (SELECT DISTINCT word FROM {terms}))""",
        f"lexicon AS MATERIALIZED (SELECT *, {narrow.format('word')} AS b, length(word) AS lb FROM {words})",
        # swaps of neighbours cost one: the distance of the beginnings, one, and that of the ends around a swap; or two swaps
        """loose AS MATERIALIZED (
  SELECT term, k, a, b, la, lb, levenshtein(a, b) AS plain, l.word AS match, l.* EXCLUDE (word, b, lb)
  FROM budget JOIN lexicon l ON abs(la - lb) <= k AND levenshtein(a, b) <= 2 * k)""",
        """swapped AS MATERIALIZED (
  SELECT term, match, min(levenshtein(a[:i - 1], b[:j - 1]) + 1 + levenshtein(a[i + 2:], b[j + 2:])) AS cost
  FROM (SELECT *, unnest(range(1, la)) AS i FROM loose WHERE plain > 1), (SELECT unnest([-1, 0, 1]) AS shift), LATERAL (SELECT i + shift AS j)
  WHERE j >= 1 AND j < lb AND a[i] = b[j + 1] AND a[i + 1] = b[j] GROUP BY term, match)""",
        """twice AS MATERIALIZED (
  SELECT DISTINCT term, match FROM (
    SELECT *, a[:i - 1] || a[i + 1] || a[i] || a[i + 2:] AS c
    FROM (SELECT *, unnest(range(1, la)) AS i FROM loose WHERE k = 2 AND la = lb AND plain BETWEEN 3 AND 4) WHERE a[i] = b[i + 1] AND a[i + 1] = b[i])
  JOIN LATERAL (SELECT unnest(range(1, la)) AS n) ON c[:n - 1] || c[n + 1] || c[n] || c[n + 2:] = b)""",
        """near AS MATERIALIZED (
  SELECT * EXCLUDE (k) FROM (
    SELECT l.* EXCLUDE (a, b, la, lb, plain),
      least(plain, coalesce(cost, 99), CASE WHEN t.term IS NULL THEN 99 ELSE 2 END) AS edits
    FROM loose l LEFT JOIN swapped s ON s.term = l.term AND s.match = l.match
      LEFT JOIN twice t ON t.term = l.term AND t.match = l.match) WHERE edits <= k)""",
        """expanded AS MATERIALIZED (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY term ORDER BY edits, count DESC, match) AS place FROM near)
  WHERE place <= 50)""",
    ]


_LEXICON = "known_words AS (SELECT term AS word, count, df FROM known)"

ORACLES["fuzzy_expand"] = _with(
    *_FULLTEXT,
    _MISSPELT,
    *_query_words("queries"),
    _LEXICON,
    *_expanded("qwords", "known_words"),
    select="SELECT term, match, edits::INT AS edits, count FROM expanded",
)

_FUZZY_HITS = [
    *_query_words("queries"),
    _LEXICON,
    *_expanded("qwords", "known_words"),
    f"""boosts AS MATERIALIZED (
  SELECT term AS word, match, (1 - edits::DOUBLE / least(length(term), length(match))) * {_IDF_PART} AS boost
  FROM (SELECT e.* EXCLUDE (df), max(df) OVER (PARTITION BY term) AS df FROM expanded e))""",
    _ranked(
        "fuzzy_hits",
        f"""SELECT query_id, doc_id, sum(n * boost * {_TF_PART}) AS s
  FROM qwords JOIN boosts USING (word) JOIN ft ON match = ft.term GROUP BY query_id, doc_id""",
        10,
    ),
]

ORACLES["fuzzy_search"] = _with(*_FULLTEXT, _MISSPELT, *_FUZZY_HITS, select=_hits_with_label("fuzzy_hits"))

_DIMENSIONS = "generate_series(1, 64)"
_MEANS = f"""parts AS MATERIALIZED (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS MATERIALIZED (SELECT label, i, avg(x) AS c FROM parts GROUP BY label, i)"""

_COSINE = """SELECT m.label AS query_id, p.vec_id AS doc_id,
    sum(c * x) / (sqrt(sum(c * c)) * sqrt(sum(x * x)) + 1e-10) AS s
  FROM parts p JOIN means m USING (i) GROUP BY m.label, p.vec_id"""

_VECTOR_HITS = [_MEANS, _ranked("vector_hits", _COSINE, 20)]

ORACLES["cosine_topk"] = _with(
    *_VECTOR_HITS, select="SELECT query_id, rank::INT AS rank, doc_id, score FROM vector_hits"
)
ORACLES["topk_merge"] = ORACLES["cosine_topk"]
ORACLES["sentence_embedding_search"] = _with(
    *_VECTOR_HITS,
    select="""SELECT query_id, rank::INT AS rank, doc_id, label, score
FROM vector_hits JOIN embeddings ON vec_id = doc_id""",
)

_WORD_EMBEDDING_HITS = [
    _WORD_VECTORS,
    _mean_vectors("dv", "documents", "doc_id"),
    _mean_vectors("qv", "queries", "query_id"),
    _ranked(
        "embedding_hits",
        """SELECT query_id, doc_id,
    sum(q.value * d.value) / (sqrt(sum(q.value * q.value)) * sqrt(sum(d.value * d.value)) + 1e-10) AS s
  FROM qv q JOIN dv d USING (dim) GROUP BY query_id, doc_id""",
        20,
    ),
]

ORACLES["word_embedding_search"] = _with(
    *_FIT, _QUERIES, *_WORD_EMBEDDING_HITS, select=_hits_with_label("embedding_hits")
)

def _sentence_vectors(name: str, tokens: str, key: str) -> str:
    """Hashed sentence vectors (W6) of the texts of ``tokens`` under the documents' idf, one row per component."""
    return f"""{name}_w AS MATERIALIZED (
  SELECT {key} AS k, t AS term, count(*) * coalesce(min(i.idf), ln(1 + (SELECT count(*) FROM documents)) + 1) AS w
  FROM {tokens} LEFT JOIN sv_idf i ON i.term = t GROUP BY ALL),
{name}_s AS MATERIALIZED (
  SELECT k, i, sum(w * (CASE WHEN v >= 8 THEN 1.0 ELSE -1.0 END) * ((v % 8) + 1) / 8.0) AS s FROM (
    SELECT k, w, i, ('0x' || substr(md5(term || '#' || (i // 32)), i % 32 + 1, 1))::INT AS v
    FROM (SELECT k, term, w, unnest(range(0, 64)) AS i FROM {name}_w)) GROUP BY k, i),
{name} AS MATERIALIZED (
  SELECT k AS {key}, i, x FROM (SELECT k, i, s / sqrt(sum(s * s) OVER (PARTITION BY k)) AS x, sum(s * s) OVER (PARTITION BY k) AS nn FROM {name}_s)
  WHERE nn > 0)"""


_SV_IDF = """sv_idf AS MATERIALIZED (
  SELECT t AS term, ln((1 + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(DISTINCT doc_id))) + 1 AS idf FROM tok GROUP BY t)"""

ORACLES["encode_batches"] = _with(
    _TOK, _SV_IDF, _sentence_vectors("sv_doc", "tok", "doc_id"),
    select="SELECT doc_id, (i)::INT AS dim, round(x, 6) AS value FROM sv_doc",
)

_STORED_VECTOR_HITS = [
    _SV_IDF,
    _sentence_vectors("sv_doc", "tok", "doc_id"),
    _sentence_vectors("sv_query", "qtok", "query_id"),
    _ranked(
        "stored_hits",
        """SELECT query_id, doc_id, sum(q.x * d.x) / (sqrt(sum(q.x * q.x)) * sqrt(sum(d.x * d.x)) + 1e-10) AS s
  FROM sv_query q JOIN sv_doc d USING (i) GROUP BY query_id, doc_id""",
        20,
    ),
]

_HALF = r"regexp_replace(split_part(text, ' - ', {}), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS half{}"

ORACLES["search_all_methods"] = _with(
    *_FIT,
    *_QUERY_TF,
    *_TFIDF_HITS,
    *_BOOLEAN_HITS,
    *_WORD_EMBEDDING_HITS,
    *_STORED_VECTOR_HITS,
    *_FULLTEXT,
    *_FUZZY_HITS,
    """united AS (
  SELECT 'tfidf' AS method, * FROM tfidf_hits UNION ALL SELECT 'boolean', * FROM boolean_hits
  UNION ALL SELECT 'word_embedding', * FROM embedding_hits UNION ALL SELECT 'sentence_embedding', * FROM stored_hits
  UNION ALL SELECT 'fulltext', * FROM fuzzy_hits)""",
    select=f"""SELECT query_id, method, rank::INT AS rank, doc_id, source AS label, {_HALF.format(1, 1)}, {_HALF.format(2, 2)}, score
FROM united JOIN documents USING (doc_id)""",
)
ORACLES["retrieve"] = ORACLES["search_all_methods"]

# ---------------------------------------------------------------- query expansion

_SPLIT = r"regexp_split_to_array({}, '[\s\p{{Z}}]+')"

_CORRECTION = [
    _MISSPELT,
    f"""dictionary AS MATERIALIZED (
  SELECT word, count(*) AS count FROM (SELECT unnest({_SPLIT.format('text')}) AS word FROM documents)
  WHERE word <> '' GROUP BY word)""",
    f"""asked AS MATERIALIZED (
  SELECT query_id, t AS word, p FROM (
    SELECT query_id, unnest(x) AS t, generate_subscripts(x, 1) AS p
    FROM (SELECT query_id, {_SPLIT.format('text')} AS x FROM queries)) WHERE t <> '')""",
    *_expanded("asked", "dictionary"),
    """corrected AS MATERIALIZED (
  SELECT term AS word, match AS corrected, score FROM (
    SELECT *, row_number() OVER (PARTITION BY term ORDER BY score DESC, match) AS place FROM (
      SELECT term, match, round((1 - edits::DOUBLE / least(length(term), length(match))) * count
        / (count + 1.2 * (0.25 + 0.75 * count / (SELECT avg(count) FROM dictionary))), 6) AS score FROM expanded))
  WHERE place = 1)""",
]

ORACLES["correct_word"] = _with(*_CORRECTION, select="SELECT word, corrected, score FROM corrected")

ORACLES["expand_query"] = _with(
    *_CORRECTION,
    """answers AS (
  SELECT query_id, string_agg(corrected, ' ' ORDER BY p) AS expanded
  FROM asked JOIN corrected USING (word) GROUP BY query_id)""",
    select="""SELECT query_id, text, coalesce(expanded, '') AS expanded, 1.0::DOUBLE AS confidence,
  coalesce(expanded, '') <> text AS did_you_mean FROM queries LEFT JOIN answers USING (query_id)""",
)

# ---------------------------------------------------------------- clusters

_ASSIGNED = [
    _MEANS,
    """distances AS MATERIALIZED (
  SELECT p.vec_id AS doc_id, p.label, m.label AS cluster_id, sum((x - c) * (x - c)) AS distance
  FROM parts p JOIN means m USING (i) GROUP BY p.vec_id, p.label, m.label)""",
    """assigned AS MATERIALIZED (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, cluster_id) AS place FROM distances)
  WHERE place = 1)""",
    "histogram AS MATERIALIZED (SELECT cluster_id, label, count(*) AS count FROM assigned GROUP BY cluster_id, label)",
]

ORACLES["kmeans_assign"] = _with(
    *_ASSIGNED, select="SELECT doc_id, cluster_id, round(distance, 6) AS distance FROM assigned"
)
ORACLES["cluster_labels"] = _with(
    *_ASSIGNED,
    select="""SELECT cluster_id, (row_number() OVER (PARTITION BY cluster_id ORDER BY count DESC, label) - 1)::INT AS rank,
  label, count FROM histogram""",
)
ORACLES["query_cluster"] = _with(
    *_ASSIGNED,
    select="""SELECT a.doc_id AS query_id, a.cluster_id, h.label, h.count
FROM assigned a JOIN histogram h USING (cluster_id)""",
)
ORACLES["cluster_members"] = _with(
    *_ASSIGNED,
    select="""SELECT cluster_id, (place - 1)::INT AS rank, doc_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY distance, doc_id) AS place FROM (
    SELECT cluster_id, doc_id, round(distance, 6) AS distance FROM assigned))
WHERE place <= 20""",
)

# ---------------------------------------------------------------- classification

_TOP = """chosen AS MATERIALIZED (
  SELECT source AS label, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, label LIMIT 10),
indexed AS MATERIALIZED (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS label_id, count FROM chosen)"""

ORACLES["top_labels"] = _with(_TOP, select="SELECT label, count FROM chosen")
ORACLES["label_index"] = _with(_TOP, select="SELECT label, label_id, count FROM indexed")
ORACLES["label_bucket"] = _with(
    _TOP,
    select="""SELECT doc_id, source AS label, coalesce(label_id, 10) AS label_id
FROM documents LEFT JOIN indexed ON source = label""",
)
ORACLES["class_weights"] = _with(
    _TOP,
    select="""SELECT label, label_id, round((1 / count) / (SELECT sum(1 / count) FROM indexed), 6) AS weight FROM indexed""",
)

_SPLIT_CASE = """CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 100 < 10 THEN 'test'
  WHEN ('0x' || substr(md5('43:' || doc_id), 1, 8))::BIGINT % 100 < 20 THEN 'validation' ELSE 'train' END"""

ORACLES["hash_split"] = f"SELECT doc_id, {_SPLIT_CASE} AS split FROM documents"

ORACLES["softmax_argmax"] = """SELECT doc_id, label_id::INT AS label_id, round(1 / total, 6) AS confidence FROM (
  SELECT vec_id AS doc_id, list_position(embedding, list_max(embedding)) - 1 AS label_id,
    list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE))) AS total FROM embeddings)"""

ORACLES["classification_metrics"] = f"""SELECT split, count(*) AS rows, round(avg(hit), 6) AS accuracy,
  round(2 * sum(hit)::DOUBLE / (2 * sum(hit) + 2 * (count(*) - sum(hit))), 6) AS f1_micro
FROM (
  SELECT {_SPLIT_CASE} AS split, (quality = (n_chars > (SELECT avg(n_chars) FROM documents))::INT)::INT AS hit
  FROM documents JOIN labels USING (doc_id))
GROUP BY split"""

# ---------------------------------------------------------------- entity graph

_LINES = r"""lines AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS seq, lower(text) AS text FROM fragments),
line_words AS MATERIALIZED (
  SELECT DISTINCT seq, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]{2,}')) AS t FROM lines)"""

_ENTITIES = f"""medium AS MATERIALIZED (
  SELECT t FROM line_words WHERE length(t) >= {inputs.NAME_LENGTH} GROUP BY t
  HAVING count(*) BETWEEN greatest(2, 0.05 * sqrt((SELECT count(*) FROM lines))) AND 0.1 * sqrt((SELECT count(*) FROM lines))),
dictionary AS MATERIALIZED (
  SELECT string_agg(t, '|' ORDER BY t) AS element, list(t) AS names,
    CASE WHEN substr(md5(left(t, {inputs.NAME_STEM})), 1, 1) < 'b' THEN 'person' ELSE 'place' END AS type
  FROM medium GROUP BY left(t, {inputs.NAME_STEM})),
names AS MATERIALIZED (SELECT element, type, unnest(names) AS name FROM dictionary)"""

_MENTIONS = """mentions AS MATERIALIZED (
  SELECT DISTINCT seq, element, type FROM lines JOIN names ON contains(text, name))"""

_GRAPH = [_FRAGMENTS, _LINES, _ENTITIES, _MENTIONS]


def _counts(name: str, mentions: str, window: int) -> str:
    return f"""{name}_tiles AS MATERIALIZED (
  SELECT DISTINCT element, 1 AS tiling, seq // {window} AS tile FROM {mentions}
  UNION ALL SELECT DISTINCT element, 2, (seq + {window // 2}) // {window} FROM {mentions}),
{name} AS MATERIALIZED (
  SELECT a.element, b.element AS other, count(*) AS shared
  FROM {name}_tiles a JOIN {name}_tiles b ON a.tiling = b.tiling AND a.tile = b.tile GROUP BY a.element, b.element)"""


def _pagerank(name: str, counts: str, rounds: int = _PAGERANK_ROUNDS) -> str:
    """Damping 0.9; self-loops leave no node without out-edges."""
    nodes = f"(SELECT count(DISTINCT element) FROM {counts})"
    return f"""{name}_edges AS MATERIALIZED (
  SELECT element, other, 1.0::DOUBLE / count(*) OVER (PARTITION BY element) AS weight FROM {counts}),
{name}_rounds AS (
  SELECT 0 AS r, element, 1.0::DOUBLE / {nodes} AS rank FROM (SELECT DISTINCT element FROM {counts})
  UNION ALL
  SELECT any_value(r) + 1, other, 0.1::DOUBLE / {nodes} + 0.9::DOUBLE * sum(rank * weight)
  FROM {name}_rounds JOIN {name}_edges USING (element) WHERE r < {rounds} GROUP BY other),
{name} AS MATERIALIZED (SELECT element, round(rank, 8) AS rank FROM {name}_rounds WHERE r = {rounds})"""


def _hits(name: str, counts: str, rounds: int = _HITS_ROUNDS) -> str:
    """Authorities are sums of hubs along edges, hubs sums of authorities against them."""
    return f"""{name}_edges AS MATERIALIZED (SELECT element, other FROM {counts}),
{name}_rounds AS (
  SELECT 0 AS r, element, 1.0::DOUBLE AS h FROM (SELECT DISTINCT element FROM {counts})
  UNION ALL
  SELECT r + 1, element, h / sum(h) OVER () FROM (
    SELECT any_value(r) AS r, e.element, sum(a) AS h FROM {name}_edges e JOIN (
      SELECT any_value(r) AS r, c.other AS node, sum(h) AS a
      FROM {name}_rounds p JOIN {name}_edges c ON c.element = p.element WHERE r < {rounds} GROUP BY c.other) ON e.other = node
    GROUP BY e.element)),
{name}_last AS MATERIALIZED (SELECT element, h FROM {name}_rounds WHERE r = {rounds}),
{name}_along AS MATERIALIZED (
  SELECT c.other AS element, sum(h) AS a FROM {name}_last p JOIN {name}_edges c ON c.element = p.element GROUP BY c.other),
{name} AS MATERIALIZED (
  SELECT element, round(h, 8) AS hubs, round(a / (SELECT sum(a) FROM {name}_along), 8) AS authorities
  FROM {name}_last JOIN {name}_along USING (element))"""


ORACLES["entity_mentions"] = _with(*_GRAPH, select="SELECT seq, element FROM mentions")
ORACLES["entity_support"] = _with(
    *_GRAPH, select="SELECT element, count(*) AS support FROM mentions GROUP BY element HAVING count(*) >= 5"
)
ORACLES["cooccurrence"] = _with(
    *_GRAPH, _counts("pairs", "mentions", 5), select="SELECT element, other, shared FROM pairs"
)
ORACLES["adjacency"] = _with(*_GRAPH, _counts("pairs", "mentions", 20), select="SELECT element, other FROM pairs")
ORACLES["pagerank"] = _with(
    *_GRAPH, _counts("pairs", "mentions", 5), _pagerank("pr", "pairs"), select="SELECT element, rank FROM pr"
)
ORACLES["hits"] = _with(
    *_GRAPH, _counts("pairs", "mentions", 5), _hits("hr", "pairs"), select="SELECT element, hubs, authorities FROM hr"
)

_RANKS = [
    *_GRAPH,
    _counts("pairs", "mentions", 5),
    _pagerank("pr", "pairs"),
    _hits("hr", "pairs"),
    "ranks AS MATERIALIZED (SELECT element, rank, hubs, authorities FROM pr JOIN hr USING (element))",
]

ORACLES["entity_ranks"] = _with(*_RANKS, select="SELECT element, rank, hubs, authorities FROM ranks")
ORACLES["rank_lookup"] = _with(
    *_RANKS, select="SELECT element, rank, hubs FROM ranks WHERE regexp_matches(element, 'ti|re')"
)

_UTTERANCES = "utterances AS MATERIALIZED (SELECT conv_id * 1000 + turn AS query_id, lower(text) AS text FROM conversations)"


def _found(ranks: str, where: str = "true") -> str:
    return f"""SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY rank DESC, element) - 1)::INT AS position,
  string_split(element, '|')[1] AS name, rank, hubs FROM (
    SELECT DISTINCT query_id, element FROM utterances JOIN names ON contains(text, name) WHERE {where})
  JOIN {ranks} USING (element)"""


ORACLES["query_entities"] = _with(*_RANKS, _UTTERANCES, select=_found("ranks"))


def _typed(kind: str, window: int) -> list[str]:
    return [
        f"{kind}_mentions AS MATERIALIZED (SELECT * FROM mentions WHERE type = '{kind}')",
        _counts(f"{kind}_pairs", f"{kind}_mentions", window),
        _pagerank(f"{kind}_pr", f"{kind}_pairs"),
        _hits(f"{kind}_hr", f"{kind}_pairs"),
        f"{kind}_ranks AS MATERIALIZED (SELECT * FROM {kind}_pr JOIN {kind}_hr USING (element))",
    ]


ORACLES["query_entities_typed"] = _with(
    *_GRAPH,
    *_typed("person", 5),
    *_typed("place", 20),
    _UTTERANCES,
    select=f"""SELECT 'person' AS type, * FROM ({_found('person_ranks', "type = 'person'")})
UNION ALL SELECT 'place', * FROM ({_found('place_ranks', "type = 'place'")})""",
)

ORACLES["close_entities"] = _with(
    *_GRAPH,
    _counts("pairs", "mentions", 5),
    select="""SELECT element, (place - 1)::INT AS rank, other, shared FROM (
  SELECT *, row_number() OVER (PARTITION BY element ORDER BY shared DESC, other) AS place FROM pairs WHERE element <> other)
WHERE place <= 5""",
)
