"""Token ids of texts by a public tokenizer file, inside tasks.

A BPE tokenizer works on the pieces its pre-tokeniser cuts, one by one. For lower-casing word tokenizers
the ids of what stands between two spaces are kept for the life of the Python worker. Byte-level files
whose merges stand in the order of their ids give the same ids by rank, which is faster. Texts that
hold anything outside the plain Latin ranges, or the marks of special tokens, or by rank a very long run of white
space, and files of any other kind take the tokenizer's own path as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property

import numpy as np

# Chunks and pieces in each of the two generations a worker keeps (about 150 MB together).
CACHED_CHUNKS = 350_000
CACHED_PIECES = 50_000

# Characters for which the pattern engines agree and normalisation to composed form changes nothing.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-ȿ]")

# A run of white space this long may take the search by pattern beyond its stack (it did at a million, not at 400,000).
_LONG_SPACE = re.compile(r"(?<!\s)\s{10000}")

# Fixed value: the pattern of byte-level BPE where the file only says that it is used.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as the letters from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: 256 + n for n, b in enumerate(others)}


class _Memory(dict):
    """What a function returned for its latest arguments: a new generation, and the one before it."""

    def __init__(self, function, size: int):
        super().__init__()
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self.function(part)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[part] = ids
        return ids


class TextEncoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.by_rank = _rank_encoder(spec)
        pattern = _word_pattern(spec)
        if pattern:
            import regex

            self.split = regex.compile(pattern).findall
            self.model, self.letters = self.tokenizer.model, _byte_letters()
            self.model._resize_cache(0)  # what is looked up there is remembered here
            self.pieces, self.chunks = _Memory(self._piece, CACHED_PIECES), _Memory(self._chunk, CACHED_CHUNKS)
        self.words = bool(pattern)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():  # other bytes have letters of their own
            piece = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        word, end = (chunk, "") if chunk.isalpha() else (chunk[:-1], chunk[-1:])
        if not word.isalpha() or end.isalnum():
            return b"".join(map(self.pieces.__getitem__, self.split(chunk)))
        ids = self._piece(word)  # a word, or a word and one mark, are pieces as they are
        return ids + self.pieces[end] if end else ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _UNUSUAL.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        if self.words:  # white space is dropped
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        if self.by_rank and not _LONG_SPACE.search(text):
            return array("I", self.by_rank(text)).tobytes()
        return self._whole(text)


def _word_pattern(spec: dict) -> str | None:
    """The pattern of a lower-casing tokenizer that drops white space."""
    normal, cutter = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal]) if normal else []
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or cutter.get("type") != "Sequence":
        return None
    spaces = [s for s in steps if s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " "]
    split, level = cutter["pretokenizers"][0], cutter["pretokenizers"][-1]
    drops = split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"]
    plain = level["type"] == "ByteLevel" and not level["use_regex"] and not level["add_prefix_space"]
    if {s["type"] for s in steps if s not in spaces} == {"NFC", "Lowercase"} and len(cutter["pretokenizers"]) == 2 and drops and plain:
        return split["pattern"]["Regex"]
    return None


def _rank_encoder(spec: dict):
    """Encoder by ranks for a byte-level file whose merged tokens have ascending ids in the order of the merges."""
    cutter, model = spec.get("pre_tokenizer") or {}, spec["model"]
    level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    if model["type"] != "BPE" or model.get("dropout") or model.get("end_of_word_suffix") or spec.get("normalizer") or not level:
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if any(a >= b for a, b in zip(order, order[1:])):
        return None
    import tiktoken

    back = {v: k for k, v in _byte_letters().items()}
    ranks = {t.translate(back).encode("latin-1"): i for t, i in model["vocab"].items() if t not in {x["content"] for x in spec["added_tokens"]}}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder of a tokenizer file; tasks of one worker share what it has learnt."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
