"""Token ids of whole batches of texts. A tokenizer that drops white space and marks word ends is asked once per distinct
word; every other one encodes whole texts."""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pandas as pd

from chronogeo.llm import arrays

MOST_WORDS = 600_000  # remembered by a worker; beyond that it starts anew

_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x0A]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_workers: dict[tuple, Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """The encoder of this worker. specials: strings of special tokens in a text become those tokens."""
    key = (path, specials)
    if key not in _workers:
        _workers[key] = Encoder(path, specials)
    return _workers[key]


class Encoder:
    def __init__(self, path: str, specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = not specials
        self.text = Tokenizer.from_file(path)  # for words: special tokens are found in whole texts only
        self.text.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.marks = [t["content"].encode() for t in spec["added_tokens"]] if specials else []
        self.by_word = bool(spec["model"].get("end_of_word_suffix"))
        self.bare = Tokenizer.from_file(path)  # for lower-case Latin letters, which the first steps leave as they are
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.size, self.used = np.zeros(1 << 16, np.int64), 0
        self.ids = np.zeros(1 << 18, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.rims: dict[str, list[int]] = {"": []}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each begins."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if not self.by_word:
            whole = [raw[offsets[i]:offsets[i + 1]].decode() for i in range(n)]
            found = [np.array(x.ids, np.uint32) for x in self.full.encode_batch_fast(whole, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.cumsum([0, *map(len, found)])
        lower = _LOWER[data]
        w = arrays.words(lower, offsets, _BREAK)
        code, example = _distinct(lower, w)
        slots = self._slots(lower.tobytes(), w.start[example].tolist(), w.end[example].tolist())
        word = slots[code]
        length, begin = self.size[word], self.start[word]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(begin - (ends - length), length) + np.arange(total)]
        bounds = np.append(0, ends)[w.first]
        special = sorted({int(np.searchsorted(offsets, at, "right")) - 1 for m in self.marks for at in _places(raw, m)})
        if not special:
            return ids, bounds
        parts = [ids[bounds[i]:bounds[i + 1]] for i in range(n)]
        for i in special:
            parts[i] = np.array(self.full.encode(raw[offsets[i]:offsets[i + 1]].decode(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def _slots(self, lower: bytes, start: list[int], end: list[int]) -> np.ndarray:
        if len(self.slot) > MOST_WORDS:
            self.forget()
        names = [lower[a:b] for a, b in zip(start, end)]
        slots = np.array([self.slot.get(h, -1) for h in names], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            fresh = [names[i] for i in new.tolist()]
            found = self._words([x.decode() for x in fresh])
            length = np.fromiter(map(len, found), np.int64, len(found))
            k, used, more = len(self.slot), self.used, int(length.sum())
            while k + len(new) > len(self.size):
                self.size, self.start = np.resize(self.size, 2 * len(self.size)), np.resize(self.start, 2 * len(self.start))
            while used + more > len(self.ids):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.ids[used:used + more] = np.fromiter(chain.from_iterable(found), np.uint32, more)
            self.size[k:k + len(new)], self.start[k:k + len(new)] = length, used + np.cumsum(length) - length
            self.used += more
            self.slot.update(zip(fresh, range(k, k + len(new))))
            slots[new] = np.arange(k, k + len(new))
        return slots

    def _words(self, words: list[str]) -> list[list[int]]:
        """A full stop or comma after a letter always begins a piece of its own."""
        stems = [x.rstrip(".,") for x in words]
        plain = [s.isalpha() and (s.isascii() or max(s) < "̀") for s in stems]
        made = iter(self.bare.encode_batch_fast([s.lower() for s, p in zip(stems, plain) if p], add_special_tokens=False))
        other = iter(self.text.encode_batch_fast([x for x, p in zip(words, plain) if not p], add_special_tokens=False))
        out = []
        for word, stem, p in zip(words, stems, plain):
            if p:
                rim = word[len(stem):]
                if rim not in self.rims:
                    self.rims[rim] = self.text.encode(rim, add_special_tokens=False).ids
                out.append(next(made).ids + self.rims[rim] if rim else next(made).ids)
            else:
                out.append(next(other).ids)
        return out


def _distinct(data: np.ndarray, w: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word among the distinct ones, and a word for each number. Hashes find them, bytes decide.

    Words of up to eight bytes are compared as one number.
    """
    code, _ = pd.factorize(w.hash)
    example = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    example[code[::-1]] = np.arange(len(code))[::-1]
    size, first = w.end - w.start, example[code]
    same = (size == size[first]).all()
    if same:
        eight = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), 0, (1,))
        short = np.flatnonzero(size <= 8)
        differ = eight[w.start[short]] ^ eight[w.start[first[short]]]
        same = not (differ & arrays.HEAD[size[short]]).any()
    if same:
        long = np.flatnonzero((size > 8) & (first != np.arange(len(code))))
        size, start, other = size[long], w.start[long], w.start[first[long]]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = (data[np.repeat(start, size) + step] == data[np.repeat(other, size) + step]).all()
    if not same:
        raw = data.tobytes()
        code, _ = pd.factorize(np.array([raw[a:b] for a, b in zip(w.start.tolist(), w.end.tolist())], object))
        example = np.zeros(int(code.max()) + 1, np.int64)
        example[code[::-1]] = np.arange(len(code))[::-1]
    return code, example


def _places(raw: bytes, mark: bytes) -> list[int]:
    found, at = [], raw.find(mark)
    while at >= 0:
        found.append(at)
        at = raw.find(mark, at + 1)
    return found
