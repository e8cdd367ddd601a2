"""Token alignment against a plain recomputation."""

import hashlib
from collections import Counter

import pytest

from textlens.llm import alignment

vocabularies = pytest.importorskip("public_tokenizers")
A, B = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")


def _entries(tokenizer):
    """Bytes of every id, worked out here without the module's tables."""
    import re

    if hasattr(tokenizer, "id_to_piece"):
        out = []
        for i in range(tokenizer.get_piece_size()):
            piece = tokenizer.id_to_piece(i)
            single = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
            out.append(bytes([int(single.group(1), 16)]) if single else piece.replace("\u2581", " ").encode())
        return out
    printable = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    letters = {chr(c): c for c in printable}
    letters.update({chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in set(printable))})
    out = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        out[i] = bytes(letters[ch] for ch in entry)
    return out


def _plain(texts):
    a, b, *_ = alignment.vocabularies(A, B)
    a_bytes, b_bytes = _entries(a), _entries(b)
    docs = []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in ids_a) != whole or b"".join(b_bytes[i] for i in ids_b) != whole:
            docs.append(([], [], []))
            continue
        ends_a, ends_b, at = [], [], 0
        for i in ids_a:
            at += len(a_bytes[i])
            ends_a.append(at)
        at = 0
        for i in ids_b:
            at += len(b_bytes[i])
            ends_b.append(at)
        common = sorted(set(ends_a) & set(ends_b))
        groups, ia, ib = [], 0, 0
        for end in common:
            ga, gb = [], []
            while ia < len(ids_a) and ends_a[ia] <= end:
                ga.append(ids_a[ia])
                ia += 1
            while ib < len(ids_b) and ends_b[ib] <= end:
                gb.append(ids_b[ib])
                ib += 1
            groups.append((ga, gb))
        docs.append((ids_a, ids_b, groups))
    counts = Counter((g[0][-1], g[1][-1]) for _, _, groups in docs for g in groups)
    best = {}
    for (x, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for ids_a, ids_b, groups in docs:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(ids_a), len(ids_b), len(groups), len(links), sum(counts[l] == best[l[1]] for l in links),
                    sum(counts[l] for l in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_alignment_matches_a_plain_recount(spark):
    texts = ["Hello  world, café <|endoftext|> <s> 日本 text", None, "", " ", "the cat sat on the mat. " * 40,
             "the cat sat on the mat. " * 40, "Ünïcode ﬁ ligature (normalised away)", "tabs\tand\nlines\r\n", "x" * 30_000,
             "emoji 😀 and don't stop", "a  b   c", "the dog"]
    rows = [(i % 7, t, "clash") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_a string")
    got = sorted(tuple(r) for r in alignment.align_tokenizers(frame, A, B).collect())
    want = sorted((i % 7, *v) for i, v in enumerate(_plain(texts)))
    assert got == want
    assert sum(r[3] for r in want) > 100 and any(r[1] == 0 and r[0] in (1, 2) for r in want)


def test_empty_table(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
