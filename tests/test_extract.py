import random

import pytest

from tests.conftest import rows
from textlens.operators import extract as ex
from textlens.operators.ordering import carry_forward, dense_index, previous_row
from textlens.session import cut


def test_flat_segments(spark):
    pages = spark.createDataFrame([(1, "<h1>A<b>b</b></h1><p>x<br/>y<p>z</p>"), (2, "<div>no</div>")], "page_id long, html string")
    assert rows(ex.flat_segments(pages)) == [(1, 0, "h1", "Ab"), (1, 1, "p", "xy"), (1, 2, "p", "z")]


def test_class_segments_resolve_nesting_and_entities(spark):
    html = (
        '<h2 class="x content_h2">One &amp; <i>two</i></h2><h2>other</h2>'
        '<div><span class="content_text">a <b>b<br></b>&lt;</span></div><span class="content_textual">no</span>'
    )
    pages = spark.createDataFrame([("p", html)], "page_id string, html string")
    assert rows(ex.class_segments(pages)) == [("p", 0, "heading", "One & two"), ("p", 1, "body", "a b<")]


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_carry_and_previous_equal_a_loop(spark, chunk):
    draw = random.Random(7)
    data = [(g, p, draw.choice([None, None, f"v{p}"])) for g in (1, 2) for p in range(25) if draw.random() < 0.8]
    frame = spark.createDataFrame(data, "g int, p int, v string").repartition(3)
    expected_carry, expected_before = [], []
    last, before = {}, {}
    for g, p, v in data:
        last[g] = v if v is not None else last.get(g)
        expected_carry.append((g, p, last[g] or ""))
        expected_before.append((g, p, before.get(g, -1)))
        before[g] = p
    carried = carry_forward(frame, ["g"], "p", frame["v"], "c", chunk).na.fill("", ["c"])
    assert rows(carried, "g", "p", "c") == sorted(expected_carry)
    paired = previous_row(frame, ["g"], "p", ["p"], "b", chunk).selectExpr("g", "p", "coalesce(b.p, -1) AS before")
    assert rows(paired) == sorted(expected_before)


@pytest.mark.parametrize("parts", [1, 5])
def test_dense_index_numbers_a_hot_key_across_partitions(spark, parts):
    data = [(0, i) for i in range(300)] + [(i, 0) for i in range(1, 100)]
    frame = spark.createDataFrame(data, "a int, b int").repartition(parts)
    assert rows(dense_index(frame, ["a", "b"]), "a", "b", "seq") == [(a, b, i) for i, (a, b) in enumerate(sorted(data))]
    assert dense_index(frame.where("a < 0"), ["a", "b"], keep=cut).count() == 0


SEGMENTS = [
    (1, 0, "body", "lost ** before"),
    (1, 1, "heading", "story A"),
    (1, 2, "body", "held"),
    (1, 3, "body", "kept"),
    (1, 4, "body", "x ** y"),
    (1, 5, "body", "z ** w"),
    (1, 6, "body", "early"),
    (1, 7, "body", ""),
    (1, 8, "body", "p ** q "),
    (1, 9, "body", "open end"),
    (1, 10, "heading", "story A"),
    (1, 11, "body", "r ** s ** t"),
    (1, 12, "heading", "intro"),
    (1, 13, "body", "i ** j"),
]


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame(SEGMENTS, "page_id int, pos int, kind string, text string").repartition(4)


def test_couplets_of_a_page(segments):
    out = ex.extract_couplets(segments, separator="**", excluded=["intro"], prefix="story")
    assert rows(out, "pos", "label", "half1", "half2", "beyt", "text") == [
        (4, "story A", "kept x ", " y", "kept x   y", "kept x - y"),
        (5, "story A", "z ", " w", "z   w", "z - w"),
        (8, "story A", "p ", " q ", "p   q ", "p - q"),
        (11, "story A", "r ", " s ", "r   s ", "r - s - t"),
    ]


def test_label_filter_is_optional(segments):
    out = ex.extract_couplets(segments, separator="**", excluded=[])
    assert {r["label"] for r in out.collect()} == {"story A", "intro"}


def test_heading_as_fragment_prefixes_the_first_couplet(segments):
    out = ex.extract_couplets(segments, separator="**", excluded=["intro"], heading_as_fragment=True)
    texts = {r["pos"]: r["text"] for r in out.collect()}
    assert texts[11] == "story A r - s - t"
    assert texts[4] == "kept x - y"


def test_references_and_attributes(spark):
    html = '<h1 class="x">A &amp;lt; B</h1><p id=1>&lt;b&gt; &#65;&#x42;&#8364; <b class="y">&quot;q&quot;</b> &#38;lt; &#0; &unknown;</p>'
    got = ex.flat_segments(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert [(r["kind"], r["text"]) for r in got] == [("h1", "A &lt; B"), ("p", '<b> AB\u20ac "q" &lt; &#0; &unknown;')]
