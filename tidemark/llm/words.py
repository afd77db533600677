"""Words of whole texts as arrays: a block of texts is split and hashed word by word, some words at a time.

A word is a run of bytes other than ASCII white space (space, \\t, \\n, \\v, \\f, \\r) of the text's UTF-8 form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text handled at once, and words that are Python objects at once.
BLOCK = 1 << 18
PIECE = 1 << 15
#: Hashes that are kept by a Python worker: of so many different words, none of more bytes than this.
KEPT, KEPT_BYTES = 1 << 16, 64
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """The hash of each word asked for, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[word] = h
        return h


_kept = _Hashes()


def blocks(texts: Sequence[bytes], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes in each; a longer text is a block of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of some texts: ``doc`` (which text), ``start`` and ``end`` (bytes in ``data``), ``hash``."""

    def __init__(self, texts: Sequence[bytes]):
        self.n_docs = len(texts)
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_start = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
        self.space = _SPACE[self.data]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], self.space)).astype(np.int8)))
        self.start, self.end = edges[0::2], edges[1::2]
        self.doc = np.searchsorted(self.doc_start, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate(([0], np.cumsum(self.count)))  # of each text, its first word

    def pieces(self) -> Iterator[tuple[int, int, list[bytes]]]:
        """(first, end, words) of some words at a time."""
        for a in range(0, len(self.start), PIECE):
            b = min(a + PIECE, len(self.start))
            yield a, b, self.data[self.start[a]:self.end[b - 1]].tobytes().split()

    def numbers(self) -> np.ndarray:
        """A 64-bit hash of each word, as ``hashes`` but of other values and without an object for each word: eight bytes of all words
        at a time. Of the words of one length up to eight bytes no two have the same. Words over ``KEPT_BYTES`` are hashed one by one."""
        out = np.empty(len(self.start), np.uint64)
        for a in range(0, len(self.start), PIECE):
            b = min(a + PIECE, len(self.start))
            base = self.start[a]
            data = np.concatenate((self.data[base:self.end[b - 1]], np.zeros(8, np.uint8)))
            eight = np.ndarray(len(data) - 7, "<u8", data, strides=1)
            start, size = self.start[a:b] - base, self.end[a:b] - self.start[a:b]
            h = mix((eight[start] & _MASK[np.minimum(size, 8)]) ^ mix(size.astype(np.uint64) * _P))
            left, done = np.flatnonzero((size > 8) & (size <= KEPT_BYTES)), 8
            while len(left):
                h[left] = mix(h[left] * _P + (eight[start[left] + done] & _MASK[np.minimum(size[left] - done, 8)]))
                done += 8
                left = left[size[left] > done]
            for k in np.flatnonzero(size > KEPT_BYTES).tolist():
                h[k] = xxhash.xxh3_64_intdigest(data[start[k]:start[k] + size[k]])
            out[a:b] = h
        return out

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        for a, b, words in self.pieces():
            out[a:b] = np.fromiter(map(_kept.__getitem__, words), np.uint64, b - a)
        return out


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that start at each word, running on into the next text."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out = out * _P + hashes[k:k + len(out)]
    return mix(out)
