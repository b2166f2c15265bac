"""Numpy views of a batch of texts: character classes, tokens and token hashes.

Used inside Arrow batches by the classifiers. Everything is linear in the characters and
works on at most ``common.CHARS_AT_ONCE`` of them at once (or on one longer text).
"""
from __future__ import annotations

import numpy as np

from telemetra.llm.common import code_points

OTHER, LOWER, UPPER, DIGIT, SPACE, LINE, STOP, SIGN = range(8)
# fixed values: look-alikes of letters in obfuscated words
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    """Per code point: ``class`` of the character, ``fold`` its folded letter (0: none)."""
    if not _tables:
        kind = np.zeros(0x110000, dtype=np.uint8)
        fold = np.zeros(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                kind[i] = UPPER if c.isupper() else LOWER
                low = c.lower()
                fold[i] = ord(low) if len(low) == 1 else i
            elif c.isdigit():
                kind[i] = DIGIT
            elif c.isspace():
                kind[i] = LINE if c == "\n" else SPACE
            elif c in ".,;:!?'\"()-":
                kind[i] = STOP
            elif i < 0x2000:
                kind[i] = SIGN
        for c, to in LOOK_ALIKES.items():
            fold[ord(c)] = ord(to)
        # odd multipliers spread code points over 64 bits
        _tables["class"], _tables["fold"] = kind, fold
        _tables["spread"] = (np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        power = np.empty(1 << 12, dtype=np.uint64)
        p = 1
        for i in range(len(power)):
            power[i] = p
            p = p * 0x5851F42D4C957F2D % (1 << 64)
        _tables["power"] = power
    return _tables[name]


class TextArrays:
    """Characters and white-space tokens of a list of texts."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.length = np.fromiter(map(len, texts), np.int64, self.n)
        self.codes = code_points("".join(texts))
        self.owner = np.repeat(np.arange(self.n), self.length)
        self.kind = _table("class")[self.codes]
        self.char_counts = np.bincount(self.owner * 8 + self.kind, minlength=self.n * 8).reshape(self.n, 8)
        ink = (self.kind != SPACE) & (self.kind != LINE)
        opening = np.zeros(len(ink), dtype=bool)
        opening[(np.cumsum(self.length) - self.length)[self.length > 0]] = True
        before = np.concatenate([[False], ink[:-1]]) if len(ink) else ink
        begin = ink & (~before | opening)
        self.ink, self.begin = ink, begin
        self.start = np.flatnonzero(begin)
        token_of = np.cumsum(begin) - 1
        self.token_of = token_of[ink]
        self.t_owner = self.owner[self.start]
        self.t_length = np.bincount(self.token_of, minlength=len(self.start))
        self.t_count = np.bincount(self.t_owner, minlength=self.n)
        self.t_first = np.cumsum(self.t_count) - self.t_count

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-token quantity over each text."""
        return np.bincount(self.t_owner, weights=flags, minlength=self.n)

    def kinds_per_token(self, kind: int) -> np.ndarray:
        return np.bincount(self.token_of[self.kind[self.ink] == kind], minlength=len(self.start))

    def folded(self) -> None:
        """Prefix hashes of the tokens' folded letters (case, look-alikes and marks removed)."""
        letter = _table("fold")[self.codes]
        kept = self.ink & (letter != 0)
        tokens = (np.cumsum(self.begin) - 1)[kept]
        self.f_length = np.bincount(tokens, minlength=len(self.start))
        self.f_first = np.cumsum(self.f_length) - self.f_length
        at = np.arange(len(tokens)) - self.f_first[tokens]
        power = _table("power")
        value = _table("spread")[letter[kept]] * power[np.minimum(at, len(power) - 1)]
        self.f_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])

    def prefix_hash(self, n: int | None = None) -> np.ndarray:
        """Hash of each token's first ``n`` folded letters (all: None); 0 where it has fewer."""
        first, size = self.f_first, self.f_length
        end = first + (size if n is None else np.minimum(size, n))
        h = self.f_sum[end] - self.f_sum[first]
        return np.where(size >= (1 if n is None else n), h, np.uint64(0))

    def token_hash(self) -> np.ndarray:
        """Hash of each token as written."""
        at = np.arange(len(self.codes))[self.ink] - self.start[self.token_of]
        power = _table("power")
        value = _table("spread")[self.codes[self.ink]] * power[np.minimum(at, len(power) - 1)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        last = np.cumsum(self.t_length)
        return total[last] - total[last - self.t_length]


def distinct_per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each text."""
    if not len(values):
        return np.zeros(n)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])])
    return np.bincount(o[new], minlength=n).astype(float)


def word_hash(word: str, n: int | None = None) -> int:
    """The hash that ``prefix_hash`` gives a token of this spelling."""
    t = TextArrays([word])
    t.folded()
    return int(t.prefix_hash(n)[0])
