"""Normalisation, tokenizers, n-grams and couplet splitting as column expressions.

Everything here is built-in Spark functions, so it runs inside the JVM next to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token shapes. INDEX_WORD is the vectoriser's (two or more word characters),
# SPLIT_WORD keeps single characters and punctuation, FULLTEXT_WORD keeps combining marks and
# the half-space (U+200C) inside a word.
INDEX_WORD = r"[\p{L}\p{N}_]{2,}"
SPLIT_WORD = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
FULLTEXT_WORD = r"[\p{L}\p{N}\p{M}\x{200c}_]+"

# Letters and digits unified by the normaliser, written as (from, to).
UNIFIED_CHARACTERS = [
    ("ي", "ی"),  # Arabic yeh -> Persian yeh
    ("ى", "ی"),  # alef maksura -> Persian yeh
    ("ك", "ک"),  # Arabic kaf -> Persian kaf
    ("٠", "۰"),  # Arabic-Indic digits -> Persian digits
    ("١", "۱"),
    ("٢", "۲"),
    ("٣", "۳"),
    ("٤", "۴"),
    ("٥", "۵"),
    ("٦", "۶"),
    ("٧", "۷"),
    ("٨", "۸"),
    ("٩", "۹"),
    ("\u00a0", " "),  # no-break space
    ("“", '"'),  # curly quotes
    ("”", '"'),
    ("‘", "'"),
    ("’", "'"),
]

# Fixed values: (pattern, replacement) applied in this order after the letters are unified.
SPACING_RULES = [
    (r"[\x{064b}-\x{0652}\x{0670}\x{0640}]", ""),  # short vowels, superscript alef, tatweel
    (r"[ \t]*\x{200c}+[ \t]*", "\u200c"),  # one half-space, no spaces around it
    (r"[ \t]{2,}", " "),
    (r" +([.,:;!?\x{060c}\x{061b}\x{061f}])", "$1"),  # no space before punctuation
    (r"^[ \t]+|[ \t]+$", ""),
]

# Fixed value: edge white space removed by strip().
EDGE_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def normalize_text(text: Column, replacements: Sequence[tuple[str, str]] = ()) -> Column:
    """Unify letters and digits, drop short vowels, repair spaces and half-spaces.

    ``replacements`` adds (pattern, replacement) rules of a language's lexicon; none by default.
    """
    sources = "".join(a for a, _ in UNIFIED_CHARACTERS)
    targets = "".join(b for _, b in UNIFIED_CHARACTERS)
    out = F.translate(text, sources, targets)
    for pattern, replacement in [*SPACING_RULES, *replacements]:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces included."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def _find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def index_tokens(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return _find_all(F.lower(text), INDEX_WORD)


def split_tokens(text: Column) -> Column:
    """Words and single punctuation marks, case kept."""
    return _find_all(text, SPLIT_WORD)


def whitespace_tokens(text: Column) -> Column:
    """Pieces between white space (T4)."""
    return F.filter(F.split(text, r"[\s\p{Z}]+"), lambda t: t != "")


def fulltext_tokens(text: Column) -> Column:
    """Lower-case words with their marks and half-spaces (T5)."""
    return _find_all(F.lower(text), FULLTEXT_WORD)


def drop_stop_words(tokens: Column, stop_words: Column | Sequence[str]) -> Column:
    """Tokens not in the list; the list is a Python sequence or an array column."""
    if isinstance(stop_words, Column):
        return F.filter(tokens, lambda t: ~F.array_contains(stop_words, t))
    listed = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(listed)) if listed else tokens


def word_ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """Space-joined runs of ``low``..``high`` tokens, shorter runs first."""
    if not 1 <= low <= high:
        raise ValueError("n-gram range needs 1 <= low <= high")
    size = F.size(tokens)
    runs = []
    for n in range(low, high + 1):
        count = F.greatest(size - (n - 1), F.lit(0))
        run = F.slice(tokens, F.lit(1), count)
        for shift in range(1, n):
            # start beyond the end is legal for an empty slice, so clamp only the length
            run = F.zip_with(run, F.slice(tokens, F.lit(shift + 1), count), lambda a, b: F.concat_ws(" ", a, b))
        runs.append(run)
    return runs[0] if len(runs) == 1 else F.concat(*runs)


def split_halves(text: Column, number: int) -> Column:
    """Half ``number`` (1 or 2) of a couplet stored as ``'half1 - half2'``."""
    return strip(F.split_part(text, F.lit(" - "), F.lit(number)))


def couplet_parts(text: Column, separator: str) -> Column:
    """Pieces of a couplet around a literal separator."""
    return F.split(text, re.escape(separator))


# Named character references of markup; the ampersand comes last, so nothing is decoded twice.
NAMED_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")]


def unescape_markup(text: Column) -> Column:
    """Text with its named and numeric character references decoded."""
    out = text
    for name, character in NAMED_REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(character))

    def decoded(done: Column, reference: Column) -> Column:
        digits = F.substring(reference, F.lit(3), F.length(reference) - 3)
        spelt = F.when(
            F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)
        ).otherwise(digits)
        code = spelt.cast("long")
        real = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(real, F.replace(done, reference, character)).otherwise(done)

    numeric = F.array_distinct(F.regexp_extract_all(out, F.lit("&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), F.lit(0)))
    out = F.when(F.contains(out, F.lit("&#")), F.aggregate(numeric, out, decoded)).otherwise(out)
    return F.replace(out, F.lit("&amp;"), F.lit("&"))
