"""Language, near-duplicates, suffix removal and the pipeline against plain versions."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlens.llm import batches as bt
from textlens.llm import language, near, suffixes

SYLLABLES = {"en": "the and ing tion er st wh ou".split(), "de": "sch ein ung keit er ch au z".split(), "es": "ción ado mente os la el que ra".split()}


def _prose(rng, words, kind="en"):
    return " ".join("".join(rng.choice(SYLLABLES[kind]) for _ in range(rng.randint(1, 4))) for _ in range(words))


# ---------------------------------------------------------------- language


def test_languages(spark):
    rng = random.Random(1)
    kinds = list(SYLLABLES)
    rows = [(i, _prose(rng, rng.randint(3, 60), kinds[i % 3]), kinds[i % 3], f"s{i % 7}") for i in range(600)]
    rows += [(700, None, "en", "s1"), (701, "", None, None), (702, "q", "de", "only-de"), (703, "7Ω#%8 $$@ ~~ ÿ¿x9!!zzqqx" * 40, None, None)]
    rows += [(800 + i, _prose(rng, 40, "de"), "de", "only-de") for i in range(30)] + [(5, rows[5][1], rows[5][2], rows[5][3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    table = language.fit_trigrams(docs.where("doc_id < 300"), kinds, per_language=40)
    clash = language.document_rows(docs).withColumn("language", F.lit("x")).withColumn("evidence", F.lit(1)).withColumn("row", F.lit(2))
    got = language.identify_languages(clash, table, kinds)
    assert {"doc_id", "language", "confidence", "accepted", "evidence", "row"} <= set(got.columns) and "text" not in got.columns
    found = collections.defaultdict(list)
    for r in got.collect():
        found[r["doc_id"]].append(r)
    held_out = [(i, k) for i, _, k, _ in rows if 300 <= i < 600]
    assert np.mean([found[i][0]["language"] == k for i, k in held_out]) > 0.97
    assert found[702][0]["language"] == "de"  # by its host and what it declares
    assert found[703][0]["language"] == language.UNKNOWN and not found[703][0]["accepted"]
    assert found[700][0]["language"] == "en" and 701 in found
    assert len(found[5]) == 2 and found[5][0] == found[5][1]
    assert language.identify_languages(clash.limit(0), table, kinds).count() == 0


def test_fit_is_bounded_and_repeats(spark):
    rows = [(i, "aaa" if i % 2 else "bbb", "en") for i in range(50)] + [(None, None, "en"), (60, "zzz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = (language.fit_trigrams(docs.repartition(n), ["en", "de"], per_language=10) for n in (1, 4))
    assert np.array_equal(one, two) and np.allclose(np.exp(one.astype(float)).sum(axis=1), 1, atol=1e-3)


def test_page_rows(spark):
    html = '<!DOCTYPE html><html dir="ltr" lang="FR-ca"><head><script>var t="</p>";</script></head><body><p>Bon&amp;jour</p></body></html>'
    rows = [(1, "https://u@www.Mon.Example.fr:80/a?b", html), (2, None, None), (3, "no address", "<html><p>x</p>")]
    got = {r["page_id"]: r for r in language.page_rows(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1]["declared"], got[1]["host"], got[1]["domain"], got[1]["suffix"]) == ("fr", "www.mon.example.fr", "example.fr", "fr")
    assert got[1]["text"].split() == ["Bon", "jour"]
    assert got[2]["text"] is None and got[2]["host"] is None and got[2]["suffix"] is None
    assert got[3]["host"] is None and got[3]["declared"] is None


# ---------------------------------------------------------------- near-duplicates


def _changed(rng, text, share):
    return " ".join(_prose(rng, 1) + "x" if rng.random() < share else w for w in text.split())


def _near_rows():
    rng = random.Random(2)
    rows = [(i, _prose(rng, rng.randint(20, 120))) for i in range(1, 60)]
    base = _prose(rng, 150)
    rows += [(100 + i, _changed(rng, base, 0.01)) for i in range(25)]
    rows += [(200 + i, _changed(rng, base, 0.08)) for i in range(10)]
    chain = _prose(rng, 100)
    for i in range(8):  # each near the next, the ends far apart
        chain = _changed(rng, chain, 0.02)
        rows.append((300 + i, chain))
    rows += [(400, rows[3][1].upper() + "!!"), (401, rows[3][1]), (402, rows[3][1])]
    rows += [(500, None), (501, ""), (502, "..."), (503, "two words"), (504, "Two  words."), (505, "two other words"), (None, rows[8][1]), (9, rows[8][1])]
    rows += [(600, "w " * 100_000)]
    return rows


def _plain_classes(rows, share=0.25, least=0.8):
    held = []
    for _, text in rows:
        words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
        parts = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        held.append(collections.Counter(parts))
    df = collections.Counter(x for c in held for x in c)
    n = len(rows)
    weighed = [{x: k * (1 - share + share * math.log((1 + n) / (1 + df[x])) / math.log(1 + n)) for x, k in c.items()} for c in held]
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = weighed[i], weighed[j]
            both = sum(min(a[x], b[x]) for x in a.keys() & b.keys())
            if both and both / (sum(a.values()) + sum(b.values()) - both) >= least:
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(n):
        groups[find(i)].append(rows[i][0])
    last = 1 << 62
    out = collections.Counter()
    for keys in groups.values():
        first = min(last if k is None else k for k in keys)
        out.update((k, None if first == last else first) for k in keys)
    return out


def test_near_duplicates_equal_brute_force(spark):
    rows = _near_rows()
    docs = spark.createDataFrame([(*r, "b", 1) for r in rows], "doc_id long, text string, batch string, node int").repartition(3)
    got = near.near_duplicates(docs)
    found = got.collect()
    assert collections.Counter((r["doc_id"], r["class_id"]) for r in found) == _plain_classes(rows)
    assert sum(r["first"] for r in found) == len({(r["class_id"], r["doc_id"] if r["class_id"] is None else 0) for r in found})
    kept = near.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted((r["doc_id"] or 0) for r in found if r["first"])


def test_near_duplicates_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(docs).count() == 0 and near.keep_one_of_each(docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert sorted((r[0] or 0, r[1] or 0, r[2]) for r in near.near_duplicates(blank).collect()) == [(0, 0, True), (1, 1, True), (2, 2, True)]


def test_samples_estimate_the_similarity():
    rng = np.random.default_rng(3)
    shared, one, two = (rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in (400, 100, 100))
    a, b = np.sort(np.r_[shared, one]), np.sort(np.r_[shared, two])
    weights = {x: w for x, w in zip(np.r_[shared, one, two].tolist(), (rng.random(600) + 0.5).tolist())}
    wa, wb = (np.array([weights[x] for x in s.tolist()]) for s in (a, b))
    drawn = near.weighted_samples(np.r_[a, b], np.r_[wa, wb], np.array([0, 500, 1000]), 600)
    exact = near.weighted_jaccard(near.pack_weighed(a, wa), near.pack_weighed(b, wb))
    assert abs((drawn[0] == drawn[1]).mean() - exact) < 0.06


def test_leaders_find_what_the_first_misses(spark):
    name = lambda i: bytes([i]) * 16
    members = near._members(spark.createDataFrame([(1, name(i), 1.0) for i in range(5)] + [(2, name(9), 1.0)], "bucket long, node binary, weight double"))
    labels = spark.createDataFrame([(name(0), name(0)), (name(1), name(0))], "node binary, label binary")
    compared, led, leaders = {(name(0), name(i)) for i in range(1, 5)}, None, 1
    for _ in range(10):
        chosen, pairs = near._open_pairs(members, labels, led, leaders, 0.8)
        if not chosen.count():
            break
        compared |= {(bytes(r["a"]), bytes(r["b"])) for r in pairs.collect()}
        led, leaders = chosen if led is None else led.union(chosen), leaders * 2
    assert compared == {(name(i), name(j)) for i in range(5) for j in range(i + 1, 5)}  # 0 and 1 are linked, and were compared first


def test_texts_that_share_too_little_are_not_met(spark):
    name = lambda i: bytes([i]) * 16
    rows = [(bucket, name(i), 1.0, 0.95 if i < 3 else 0.85) for bucket in (1, 2, 3) for i in range(40)]
    members = near._members(spark.createDataFrame(rows, "bucket long, node binary, weight double, shared double"))
    labels = spark.createDataFrame([], "node binary, label binary")
    _, pairs = near._open_pairs(members, labels, None, 40, 0.8)
    assert {(bytes(r["a"]), bytes(r["b"])) for r in pairs.collect()} == {(name(0), name(1)), (name(0), name(2)), (name(1), name(2))}


def test_families_with_own_parts_equal_brute_force(spark):
    rng = random.Random(11)
    passage = _prose(rng, 80)
    rows = [(i, passage + " " + _prose(rng, rng.randint(2, 25))) for i in range(1, 61)]
    rows += [(100 + i, _changed(rng, passage, 0.03)) for i in range(40)]
    rows += [(200 + i, rows[i][1]) for i in range(0, 100, 7) for _ in range(2)]  # copies: what only they hold is shared with no other text
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near.near_duplicates(docs)
    assert collections.Counter((r["doc_id"], r["class_id"]) for r in got.collect()) == _plain_classes(rows)


def test_components_of_a_chain(spark):
    name = lambda i: i.to_bytes(2, "big")
    links = spark.createDataFrame([(name(i), name(i + 1)) for i in range(12)] + [(name(50), name(60)), (name(70), name(60))], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["label"]) for r in near.components(links).collect()}
    assert got == {**{name(i): name(0) for i in range(13)}, **{name(i): name(50) for i in (50, 60, 70)}}


def test_further_links_join_components(spark):
    name = lambda i: i.to_bytes(2, "big")
    frame = lambda pairs: spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "a binary, b binary")
    labels = near.components(frame([(5, 6), (6, 7), (20, 21), (30, 31)]))
    got = near._merged(labels, frame([(7, 21), (40, 41), (3, 6), (5, 7)]))
    assert sorted((r["node"][1], r["label"][1]) for r in got.collect()) == [
        (3, 3), (5, 3), (6, 3), (7, 3), (20, 3), (21, 3), (30, 30), (31, 30), (40, 40), (41, 40)
    ]


# ---------------------------------------------------------------- suffixes


def _plain_removal(rows, length):
    last = 1 << 62
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            first[part] = min(first.get(part, last), last if key is None else key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (last if key is None else key):
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone, 0]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((-1 if key is None else key, len(data), kept, edges[::2].tolist(), edges[1::2].tolist()))
    return sorted(out)


@pytest.mark.parametrize("size", [300, bt.BATCH_BYTES])
def test_suffix_removal_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(bt, "BATCH_BYTES", size)
    rng = random.Random(6)
    passages = [_prose(rng, 14) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [_prose(rng, rng.randint(0, 20), rng.choice(list(SYLLABLES))) for _ in range(3)]
        parts.insert(1, rng.choice(passages)[rng.randint(0, 20) :])
        rows.append((rng.randint(0, 70), " ".join(parts)))
    rows += [(80, None), (81, ""), (82, "short"), (83, "a" * 400), (84, "a" * 49), (85, "b" + "a" * 60), (None, passages[0]), (86, "ab" * 300), (87, "ba" * 100)]
    rows += [rows[0], (90, rows[1][1]), (91, "é" * 80), (92, "xé" + "é" * 40), (93, "\x00" * 70), (94, "\x00" * 60 + "z")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, answers int, _kept string").repartition(2)
    got = suffixes.remove_earlier_strings(docs)
    assert [c for c in got.columns if c[0] != "_"] == ["doc_id", "text", "answers"]
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["_n_bytes"], bytes(r["_kept"]), r["_starts"], r["_ends"]) for r in got.collect())
    assert found == _plain_removal(rows, 50)
    assert suffixes.remove_earlier_strings(docs.limit(0)).count() == 0


def test_collection_transform_sorts_all_suffixes():
    rng = random.Random(7)
    for _ in range(60):
        strings = [bytes(rng.choice(b"abc\x00") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 15))]
        owner, size, common = suffixes.transform(strings)
        expected = sorted(([c + 1 for c in s[len(s) - j :]] + [0], i, j) for i, s in enumerate(strings) for j in range(len(s) + 1))
        assert [(i, j) for _, i, j in expected] == list(zip(owner.tolist(), size.tolist()))
        for k in range(1, len(expected)):
            a, b = expected[k - 1][0][:-1], expected[k][0][:-1]
            shared = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
            assert common[k] == shared


def test_packed_arrays_round_trip():
    for array in (np.zeros(0, np.uint32), np.arange(1000, dtype=np.uint32), np.array([bt.LAST_KEY, -1], dtype=np.int64)):
        assert np.array_equal(bt.unpack(bt.pack(array), array.dtype.str), array)
    assert bt.unpack_bytes(bt.pack_bytes(b"")) == b"" and bt.unpack_bytes(bt.pack_bytes(b"abc")) == b"abc"


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as cp

    rng = random.Random(8)
    rows = [(i, _prose(rng, rng.randint(30, 90), "en"), "en", f"src{i % 3}") for i in range(80)]
    rows += [(200, rows[4][1], "en", "src0"), (201, _changed(rng, rows[5][1], 0.01), "en", "src1"), (202, rows[6][1] + " " + _prose(rng, 300), "en", "src2")]
    rows += [(300, None, "en", None), (301, "", None, "src0"), (302, "7Ω#%8 $$@ ~~ ÿ¿x9!!zzqqx" * 60, None, "odd")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    held, seen = docs, {}
    for name, stage in cp.STAGES:
        out = stage(spark, held, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
        seen[name] = held.collect()
        if name != "packing":
            assert set(held.columns) == set(docs.columns)
    ids = {n: {r["doc_id"] for r in seen[n]} for n in seen}
    assert 302 not in ids["language_id"] and set(range(80)) <= ids["language_id"]
    assert ids["near_dedup"] == ids["language_id"] - {200, 201}
    assert ids["suffix_dedup"] == ids["near_dedup"]
    before = [(r["doc_id"], r["text"]) for r in seen["near_dedup"]]
    kept = {k: t.decode("utf-8", "ignore") for k, _, t, _, _ in _plain_removal(before, 50)}
    assert {r["doc_id"]: r["text"] for r in seen["suffix_dedup"]} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in seen["suffix_dedup"])
    assert ids["mixing"] <= ids["suffix_dedup"] and ids["packing"] == ids["mixing"]
    copies = collections.Counter(r["doc_id"] for r in seen["mixing"])
    assert collections.Counter(r["doc_id"] for r in seen["packing"] if r["start"] == 0) == copies
    assert cp.run(spark, str(tmp_path)).count() == len(seen["packing"])


def test_only_texts_and_evidence_go_through_python(spark):
    docs = spark.createDataFrame([(i, _prose(random.Random(i), 20, "de"), "de", "s") for i in range(9)], "doc_id long, text string, lang string, source string")
    kinds = list(SYLLABLES)
    table = language.fit_trigrams(docs, kinds)
    rows = language.document_rows(docs).withColumn("_text", F.col("text"))
    found = language.identify_languages(rows, table, kinds, text="_text")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {r["doc_id"]: r["text"] for r in docs.collect()}


def test_stages_keep_arrow_batches_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    import corpus_pipeline as cp
    from textlens.session import small_arrow_batches

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "67108864b")
        docs = spark.range(1_500).selectExpr("id AS doc_id", "repeat('word ', 4000) AS text", "'en' AS lang", "'a' AS source", "20000L AS n_chars").coalesce(1)
        cp.mixed_sources(spark, docs, "")
        found = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 30_000_000 and max(found) < 5_000_000
        spark.conf.set(name, "1m")
        small_arrow_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


def test_suffix_stage_takes_one_python_step(spark):
    import corpus_pipeline as cp

    text = "one passage of more than fifty bytes that stands in two texts "
    docs = spark.createDataFrame([(1, text + "é", "en", "a", 1), (2, text + "b", "en", "a", 1), (3, None, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    found = cp.without_earlier_strings(spark, docs, "")
    plain = suffixes.remove_earlier_strings(docs).mapInArrow(suffixes.kept_texts, docs.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    steps = [frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for frame in (found, plain)]
    assert steps[0] == steps[1] - 1
