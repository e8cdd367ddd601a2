"""Phrase collocations against a plain recomputation."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute

from textlens.llm import batches as bt
from textlens.llm import collocations


def _brute(rows, least=10, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = (text or "").translate(str.maketrans(collocations.UPPER, collocations.LOWER))
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(w)
            for s in (1, 2, 3):
                for i in range(len(w) - s + 1):
                    counts.setdefault(lang, Counter())[" ".join(w[i : i + s])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if p.count(" ") >= 1 and a >= least}
        kept = []
        for p, a in cands.items():
            w = p.split(" ")
            if len(w) == 2 and any(len(q.split(" ")) == 3 and p in (" ".join(q.split(" ")[:2]), " ".join(q.split(" ")[1:])) and 100 * b >= 50 * a for q, b in cands.items()):
                continue
            best = min(((10**6 * a * a) // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w)))
            k = best[1]
            kept.append((lang, p, a, f[" ".join(w[:k])], f[" ".join(w[k:])], totals[lang], best[0]))
        kept.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (lang, p, a, l, r, n, s) in enumerate(kept[:top])]
    return sorted(out)


def test_collocations_match_a_plain_count(spark):
    rows = [("en", "New York is big. NEW york, new york!\tnew  york")] * 6
    rows += [("en", "the cat sat. the cat sat on the mat; the dog"), (None, "of the of the of the"), ("en", None), ("en", ""), ("de", "   \t ")]
    rows += [("en", "the cat sat") for _ in range(9)] + [("und", "ab cd ef " * 20)] + [("en", "x " * 50_000)]
    frame = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", __import__("pyspark.sql.functions").sql.functions.lit("clash"))
    got = sorted(tuple(r) for r in collocations.collocations(frame, least=3, top=5).collect())
    assert got == _brute(rows, least=3, top=5)
    assert any(r[2] == "new york" for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "lang string, text string, doc_id long")
    assert collocations.collocations(empty).count() == 0


def test_only_phrases_met_often_travel():
    rows = pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": ["Big cats, big\tcats! rare words here", None]})
    data = pa.BufferOutputStream()
    with pa.ipc.new_stream(data, rows.schema) as writer:
        writer.write_batch(rows)
    keys, counts = collocations._distinct_phrases(3, 3)(rows)
    assert len(keys) == 9 and counts.sum() == 7 + 4 + 1
    answers = [{"bucket": int(k) >> 61, "answer": bt.pack(np.array([n], "<u4"))} for k, n in zip(keys, counts)]
    batch = pa.RecordBatch.from_pydict({"rows": [data.getvalue().to_pybytes()], "answers": [answers]})
    for least, wanted in ((2, {"": 7, "big": 2, "cats": 2, "big cats": 2}), (3, {"": 7})):
        sent = pa.Table.from_batches(collocations._send(3, least, 3)(iter([batch])))
        met = {}
        for group in sent.column("bucket").unique().to_pylist():
            part = sent.filter(pa.compute.equal(sent.column("bucket"), group))
            met |= {r["phrase"]: r["f"] for r in collocations._sum(1)(part).to_pylist()}
        assert met == wanted


def test_counts_are_answered_up_to_what_is_asked():
    table = pa.table({"bucket": [0, 0], "batch": [1, 2], "asked": [bt.pack(np.array([5, 4], "<u4")), bt.pack(np.array([9], "<u4"))]})
    table = table.append_column("counts", pa.array([bt.pack(np.array([1, 8], "<u4")), bt.pack(np.array([7], "<u4"))]))
    answers = [bt.unpack(x.as_py(), "<u4").tolist() for x in bt._answer(10)(table).column("answer")]
    assert answers == [[1, 10], [10]]
