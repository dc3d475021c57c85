"""Ids of a byte-level BPE tokenizer, read from its one file.

The merges of such a file are an order of byte strings, which a second public library applies several times faster. Texts in
which the two could read a character or a special token differently go to the tokenizer itself, so the ids are always its own.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np

LONGEST = 400  # characters of one kind in a row, for the fast way

# Fixed value: how byte-level tokenizers split a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACES = re.compile(r"\s{%d}" % LONGEST)
_workers: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def letters_of_bytes() -> dict[str, int]:
    """The character that stands for each byte in such files: itself if it can be seen, else one after the first 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


def _known() -> np.ndarray:
    """Characters that have had one meaning in all versions of Unicode that a library could follow."""
    old, ok = unicodedata.ucd_3_2_0, np.zeros(0x110000, bool)
    for i in range(0x10000):
        kind = old.category(chr(i))
        ok[i] = kind not in ("Cn", "Cs") and kind == unicodedata.category(chr(i))
    ok[[0x85, 0x1C, 0x1D, 0x1E, 0x1F, 0x180E, 0x200B]] = False  # white space for some
    return ok


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], letters_of_bytes()
        first = spec["pre_tokenizer"] or {}
        self.marks = [t["content"] for t in spec["added_tokens"]]
        own = set(self.marks)
        self.fast = None
        if (model["type"] == "BPE" and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
                and not spec["normalizer"] and not model.get("dropout") and not model.get("ignore_merges")):
            ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in own}
            self.fast = tiktoken.Encoding("pieces", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
            self.known = _known()

    def _plain(self, text: str) -> bool:
        if not text.isascii() and not self.known[np.frombuffer(text.encode("utf-32-le"), np.uint32)].all():
            return False
        if any(c in text for c in "\x1c\x1d\x1e\x1f") or any(m in text for m in self.marks):
            return False
        return max(map(len, text.split()), default=0) < LONGEST and not _SPACES.search(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        odd = []
        for i, text in enumerate(texts):
            if self.fast is not None and self._plain(text):
                out[i] = np.array(self.fast.encode_ordinary(text), np.uint32)
            else:
                odd.append(i)
        for i, found in zip(odd, self.full.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)):
            out[i] = np.array(found.ids, np.uint32)
        return out
