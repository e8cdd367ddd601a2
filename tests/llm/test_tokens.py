"""Token files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.llm import packing, token_files, tokens

vocabularies = pytest.importorskip("public_tokenizers")
BYTES, WORDS = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("word_bpe_49k.json")

ODD = ["", " ", "a", " a", "a ", "a  b", "it's  \n x", "a\n\nb c", "x \xa0y", "<|endoftext|> a", "ÀÉ straße İx", "don't 'RE 12,345",
       "'s 't a's \n b", "\x85tab\t\x1cq", "日本語 text", "emoji 😀!", "naïve café—dash", "é combining", "'''quotes'''s", "a_b-c/d\\e"]


def _ids(path, text, end):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4")


@pytest.mark.parametrize("path", [BYTES, WORDS, vocabularies.path("word_bpe_49k.json")])
def test_encoder_equals_the_library(path):
    random.seed(3)
    letters = "aeiou thnr'.,!?\n \t éñß9$%&|"
    texts = ODD + ["".join(random.choice(letters) for _ in range(random.randint(0, 300))) for _ in range(300)]
    encoder = tokens.TextEncoder(path)
    for text in texts + texts[:50]:
        assert encoder.encode(text) == _ids(path, text, 0)[:-1].tobytes(), repr(text)


@pytest.mark.parametrize("run", [" ", "\n", " \t\r\n"])
def test_long_white_space_runs(run):
    text = "some text" + run * (1_000_000 // len(run)) + "more text"
    assert tokens.TextEncoder(BYTES).encode(text) == _ids(BYTES, text, 0)[:-1].tobytes()


def test_memory_keeps_two_generations(monkeypatch):
    calls = []
    memory = tokens._Memory(lambda x: calls.append(x) or x.encode(), 2)
    assert [memory[x] for x in "abcab"] == [b"a", b"b", b"c", b"a", b"b"] and calls == ["a", "b", "c"]


DOCS = [(i, t, "s", i) for i, t in enumerate(ODD)] + [(100, None, "s", 1), (101, "long words in a row " * 20_000, "s", 2), (None, "no key", "s", 3)]
DOCS += [(7, "twice", "t", 4), (7, "twice", "t", 4)]
SCHEMA = "doc_id long, text string, ids string, shard long"


def test_token_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "ids")
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    token_files.write_token_ids(docs, path, WORDS)
    written = token_files.read_token_ids(spark, path)
    got = sorted(token_files.token_places(written).collect(), key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys) and len(got) == len(DOCS)
    start, texts = 0, {}
    for key, text, *_ in DOCS:
        texts.setdefault(key, []).append(_ids(WORDS, text, 2))
    for row in got:
        assert row["start"] == start
        start += row["n_tokens"]
        assert any(len(x) == row["n_tokens"] and zlib.crc32(x.tobytes()) == row["ids_crc32"] for x in texts[row["doc_id"]])
    assert np.array_equal(written.where("doc_id = 101").first()["ids"], texts[101][0])
    assert "doc_id" in written.where("doc_id = 101")._jdf.queryExecution().toString().split("PushedFilters")[1][:80]
    empty = str(tmp_path / "none")
    token_files.write_token_ids(docs.limit(0), empty, WORDS)
    schema = "doc_id long, shard int, place long, ids array<int>"
    assert token_files.token_places(spark.read.schema(schema).orc(empty)).count() == 0


def test_packing_uses_every_id_once(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    pieces = packing.offsets(packing.pack_documents(docs, BYTES, window=64, grain=4)).collect()
    got = {}
    for p in pieces:
        assert 0 < p["length"] <= 64 and len(p["ids"]) == 4 * p["length"]
        got.setdefault(p["doc_id"], []).append((p["start"], bytes(p["ids"]), p["doc_tokens"]))
    for key, text, *_ in DOCS:
        ids = _ids(BYTES, text, 0)
        own = sorted(got[key])
        if key != 7:  # two rows share this key
            assert b"".join(x[1] for x in own) == ids.tobytes() and all(x[2] == len(ids) for x in own)
    assert b"".join(x[1] for x in got[7] if x[2] == len(_ids(BYTES, "twice", 0))) == _ids(BYTES, "twice", 0).tobytes() * 2
    fills = {}
    for p in pieces:
        fills.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in fills.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    assert packing.pack_documents(docs.limit(0), BYTES).count() == 0
    whole = packing.sequences(packing.pack_documents(docs, BYTES, window=64, grain=4)).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(4 * p["length"] for p in pieces) and len(whole) == len(fills)


def test_plan_covers_the_histogram():
    random.seed(4)
    for bins in (8, 32, 128):
        histogram = np.array([0] + [random.choice([0, 1, 7, 300]) for _ in range(bins)])
        plan = packing.plan_sequences(histogram)
        used = np.zeros(bins + 1, dtype=int)
        for kind, count in zip(plan.kinds, plan.counts):
            assert sum(kind) <= bins and count > 0
            for size in kind:
                used[size] += count
        assert (used == histogram).all()


def test_even_lengths_fill_their_sequences():
    for bins in (8, 32, 128):
        histogram = np.array([0] + [50] * bins)
        plan = packing.plan_sequences(histogram)
        held = sum(sum(k) * c for k, c in zip(plan.kinds, plan.counts))
        assert held >= 0.95 * bins * sum(plan.counts)


def test_nonnegative_least_squares():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a = rng.random((12, 30))
        hidden = np.maximum(rng.standard_normal(30), 0) * (rng.random(30) < 0.2)
        x = packing.solve_nonnegative(a, a @ hidden)
        assert (x >= 0).all() and np.allclose(a @ x, a @ hidden, atol=1e-6)
        y = packing.solve_nonnegative(a, rng.standard_normal(12))
        assert (y >= 0).all()
