"""Words of letters as code points, vectorised over a batch of texts."""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

from cratedig.llm._util import _BASE, _INVERSE, _power, mix, ragged

#: First and last code point of each script's letters.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it belongs to words (letters and marks), its lower case, its script (0: another)."""
    n = sys.maxunicode + 1
    letter = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
    marks = np.fromiter((i for i in range(0x300, 0x20000) if unicodedata.category(chr(i))[0] == "M"), np.int64)
    letter[marks] = True
    low = np.arange(n, dtype=np.uint32)
    for i in np.flatnonzero(letter).tolist():
        c = chr(i)
        if c.isupper() and len(x := c.lower()) == 1:
            low[i] = ord(x)
    script = np.zeros(n, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = k
    return letter, low, script


class Words:
    """The words of ``texts`` (None is empty): lower-cased code points, each word's span, row and hash."""

    def __init__(self, texts: list[str | None]):
        letter, low, _ = tables()
        raw = ["" if t is None else t for t in texts]
        size = np.array([len(t) for t in raw], np.int64)
        self.offs = np.concatenate([[0], np.cumsum(size)])
        self.code = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = letter[self.code]
        self.low = low[self.code]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offs] = True
        flips = np.concatenate([[False], inside, [False]])
        self.start = np.flatnonzero(inside & (~flips[:-2] | edge[:-1]))
        self.end = np.flatnonzero(inside & (~flips[2:] | edge[1:])) + 1
        self.row = np.searchsorted(self.offs, self.start, "right") - 1
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.prefix = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum(mix(self.low.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(self.low)), out=self.prefix[1:])
        self.hash = self.span(self.start, self.end)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * _power(_INVERSE, len(self.prefix))[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """One index of each distinct word, and for every word the position of its own among those."""
        _, first, inverse = np.unique(self.hash, return_index=True, return_inverse=True)
        return first, inverse

    def grams(self, words: np.ndarray, sizes: range, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``words``, bucket) of their character n-grams, marked at word edges, and of whole words."""
        owner, bucket = [np.arange(len(words))], [mix(self.hash[words] + np.uint64(77))]
        start, end = self.start[words], self.end[words]
        for n in sizes:
            counts = np.maximum(0, end - start - n + 1)
            of, step = ragged(counts)
            at = start[of] + step
            place = (step == 0).astype(np.uint64) + 2 * (at + n == end[of]).astype(np.uint64)
            owner.append(of)
            bucket.append(mix(self.span(at, at + n) * np.uint64(4) + place))
        return np.concatenate(owner), (np.concatenate(bucket) >> np.uint64(64 - bits)).astype(np.int64)
