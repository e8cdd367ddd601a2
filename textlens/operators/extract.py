"""From HTML pages to labelled couplets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.functions.text import couplet_parts, strip, unescape_markup
from textlens.operators.ordering import CHUNK_ROWS, carry_forward, previous_row
from textlens.operators.rows import unnest

# Labels of the book's front matter, the prefix of story labels, and the mark
# between the halves of a couplet.
FRONT_MATTER_LABELS = ["مشخصات کتاب", "معرفی"]
STORY_PREFIX = "داستان"
HALF_SEPARATOR = "****"

HEADING = "heading"
BODY = "body"

# Elements of the book, as (tag, class, kind).
BOOK_ELEMENTS = [("h2", "content_h2", HEADING), ("span", "content_text", BODY)]

_VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())


def flat_segments(
    pages: DataFrame,
    heading_tag: str = "h1",
    body_tag: str = "p",
    inline_tags: Sequence[str] = ("b", "i", "br"),
    key: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Headings and paragraphs of pages whose elements do not nest, in page order.

    Inline tags are removed first; an element ends at the next tag. Tags may have attributes, and
    character references are decoded. Output: key, ``pos``, ``kind`` (the tag) and ``text``. No shuffle: a page yields
    its own rows.
    """
    inline = "|".join(inline_tags)
    plain = F.regexp_replace(html, rf"</?({inline})(\s[^>]*)?/?>", "") if inline_tags else F.col(html)
    found = F.regexp_extract_all(plain, F.lit(rf"<(?:{heading_tag}|{body_tag})(?:\s[^>]*)?>[^<]*"), 0)
    rows = unnest(pages.select(key, html), found, "_element", "pos")
    return rows.select(
        key,
        "pos",
        F.regexp_extract("_element", r"^<([^>\s]*)", 1).alias("kind"),
        unescape_markup(F.regexp_replace("_element", r"^<[^>]*>", "")).alias("text"),
    )


class _ElementText(HTMLParser):
    """Collects the text of the wanted elements, nested markup included."""

    def __init__(self, wanted: Sequence[tuple[str, str, str]]):
        super().__init__(convert_charrefs=True)
        self._wanted = wanted
        self._open: list[tuple[str, int | None]] = []
        self.found: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID_TAGS:
            return
        classes = (dict(attrs).get("class") or "").split()
        slot = None
        for name, wanted_class, kind in self._wanted:
            if tag == name and wanted_class in classes:
                slot = len(self.found)
                self.found.append([kind, ""])
        self._open.append((tag, slot))

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                del self._open[depth:]
                return

    def handle_data(self, data):
        for _, slot in self._open:
            if slot is not None:
                self.found[slot][1] += data


def class_segments(
    pages: DataFrame,
    elements: Sequence[tuple[str, str, str]] = tuple(BOOK_ELEMENTS),
    key: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Elements picked by tag and class token, nested markup and entities resolved."""
    wanted = list(elements)
    key_type = pages.schema[key].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, text in zip(batch[key], batch[html]):
                parser = _ElementText(wanted)
                parser.feed(text or "")
                parser.close()
                rows.extend((page, pos, kind, body) for pos, (kind, body) in enumerate(parser.found))
            yield pd.DataFrame(rows, columns=[key, "pos", "kind", "text"])

    schema = f"{key} {key_type}, pos int, kind string, text string"
    return pages.select(key, html).mapInPandas(parse, schema)


def label_by_heading(
    segments: DataFrame,
    heading: str = HEADING,
    key: str = "page_id",
    keep_headings: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Give each body row the last heading before it; rows before any heading go.

    ``section`` is the position of that heading: equal labels may head several sections.
    """
    value = F.when(F.col("kind") == heading, F.struct(F.col("pos").alias("section"), F.col("text").alias("label")))
    carried = carry_forward(segments, [key], "pos", value, "_heading", chunk_rows)
    labelled = carried.where("_heading is not null").select(*segments.columns, "_heading.section", "_heading.label")
    return labelled if keep_headings else labelled.where(F.col("kind") != heading)


def keep_labels(
    rows: DataFrame,
    excluded: Sequence[str] = (),
    prefix: str | None = None,
    label: str = "label",
) -> DataFrame:
    """Drop excluded labels and, with a prefix, all labels that do not start with it."""
    if excluded:
        rows = rows.where(~F.col(label).isin(list(excluded)))
    if prefix is not None:
        rows = rows.where(F.col(label).startswith(prefix))
    return rows


def join_fragments(
    rows: DataFrame,
    separator: str = HALF_SEPARATOR,
    group: Sequence[str] = ("page_id", "section"),
    position: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Prefix a fragment without separator to the next one that has it.

    Of several held fragments only the last counts, and an empty one adds nothing, so a row
    needs just the row before it.
    """
    marked = rows.withColumn("_whole", F.contains(F.col("text"), F.lit(separator)))
    paired = previous_row(marked, group, position, ["text", "_whole"], "_before", chunk_rows)
    held = ~F.col("_before._whole") & (F.col("_before.text") != "")
    joined = F.when(held, F.concat_ws(" ", F.col("_before.text"), F.col("text"))).otherwise(F.col("text"))
    return paired.where("_whole").withColumn("text", joined).drop("_whole", "_before")


def couplet_columns(text: Column, separator: str = HALF_SEPARATOR) -> list[Column]:
    """Columns ``half1``, ``half2``, ``beyt`` (as written) and ``text`` (stripped, ' - ')."""
    parts = couplet_parts(text, separator)
    half1, half2 = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return [
        half1.alias("half1"),
        half2.alias("half2"),
        F.concat_ws(" ", half1, half2).alias("beyt"),
        F.array_join(F.transform(parts, strip), " - ").alias("text"),
    ]


def split_couplets(rows: DataFrame, separator: str = HALF_SEPARATOR) -> DataFrame:
    """Split joined fragments into their halves; all other columns are kept."""
    others = [c for c in rows.columns if c != "text"]
    return rows.select(*others, *couplet_columns(F.col("text"), separator))


def extract_couplets(
    segments: DataFrame,
    heading: str = HEADING,
    separator: str = HALF_SEPARATOR,
    excluded: Sequence[str] = tuple(FRONT_MATTER_LABELS),
    prefix: str | None = None,
    heading_as_fragment: bool = False,
    key: str = "page_id",
) -> DataFrame:
    """Whole extraction of a segment table: label, filter, join, split.

    With ``heading_as_fragment`` the heading itself is held like a fragment, so the first couplet
    below it starts with its text.
    """
    labelled = label_by_heading(segments, heading, key, keep_headings=heading_as_fragment)
    if heading_as_fragment:
        body = keep_labels(labelled.where(F.col("kind") != heading), excluded, prefix)
        labelled = body.unionByName(labelled.where(F.col("kind") == heading))
        joined = join_fragments(labelled, separator, [key])
    else:
        joined = join_fragments(keep_labels(labelled, excluded, prefix), separator, [key, "section"])
    return split_couplets(joined, separator).drop("kind")
