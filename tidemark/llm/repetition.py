"""Quality rule on repetition within a text, by suffix array and longest common prefixes.

The words of a block of texts are sorted as suffixes (each text ends in a mark of its own, so nothing matches across
texts). Neighbours in that order with a common prefix of ``n`` words are two places of a repeated string; their spans
are the members of the longest-common-prefix intervals. The union of the spans of at least ``min_words`` words gives the
covered share, the longest common prefix the longest repeat.

Words are compared by a 64-bit hash. A text of over 256 KB is a block of its own, which takes some thirty times its bytes of
memory; shorter ones share blocks. Nulls and texts without words: all counts 0, ``base_failed`` true. Repeated rows give repeated results, an empty table an
empty one. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import Words, blocks, windows

#: A repeat that counts towards the covered share has so many words at least.
MIN_WORDS = 5
#: Percent of the words that repeats may cover.
MAX_COVERED = 45
#: Words of the longest repeat that is let through, in percent of the text's words.
MAX_LONGEST = 25

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, n_covered_words bigint, n_longest_repeat bigint")


def common_prefixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the one before it) of ``ids``.

    The sort doubles the compared length in each round, and only among suffixes that are still tied. Every text in
    ``ids`` has to end in a value that occurs nowhere else.
    """
    n = len(ids)
    number = np.int32 if n < 1 << 31 else np.int64
    order = np.argsort(ids, kind="stable").astype(number)
    new = np.concatenate(([True], ids[order[1:]] != ids[order[:-1]])) if n else np.zeros(0, bool)
    starts = np.maximum.accumulate(np.where(new, np.arange(n, dtype=number), number(0)))
    rank = np.empty(n, number)
    rank[order] = starts
    levels = [rank.copy()]
    step = 1
    while True:
        tied = ~new | np.concatenate((~new[1:], [False]))
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        key = rank[at].astype(np.int64) * (n + 1) + rank[at + step]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        new[slots] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        levels.append(rank.copy())
        step *= 2
    prefix = np.zeros(n, number)
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1 if n else np.zeros(0, np.int64)
    a, b = order[pairs - 1], order[pairs]
    length = np.zeros(len(pairs), number)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + length, n - 1)] == levels[k][np.minimum(b + length, n - 1)]
        length += np.where(same, number(1 << k), number(0))
    prefix[pairs] = length
    return order, prefix


def covered(order: np.ndarray, prefix: np.ndarray, least: int) -> np.ndarray:
    """Which elements lie in a repeat of at least ``least`` elements."""
    n = len(order)
    span = np.zeros(n + 1, np.int64)
    follows = np.append(prefix[1:], prefix.dtype.type(0)) if n else prefix
    length = np.zeros(n, prefix.dtype)
    length[order] = np.maximum(prefix, follows)
    at = np.flatnonzero(length >= least)
    np.add.at(span, at, 1)
    np.add.at(span, at + length[at], -1)
    return np.cumsum(span[:-1]) > 0


def measure(texts: list[bytes], min_words: int) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, n_longest_repeat of each text."""
    w = Words(texts)
    sums = lambda x: np.add.reduceat(x.astype(np.int64), w.doc_start) if w.n_docs else np.zeros(0, np.int64)
    chars = sums(((w.data & 0xC0) != 0x80) & ~w.space)
    dup_lines = np.zeros(w.n_docs, np.int64)
    for i, text in enumerate(texts):
        lines = [line for line in text.split(b"\n") if line.split()]
        dup_lines[i] = len(lines) - len(set(lines))
    # Words of one text share an id if they are equal; the text's last id is its mark.
    _, word = np.unique(w.hashes(), return_inverse=True)
    at = np.arange(len(word)) + w.doc
    ids = np.empty(len(word) + w.n_docs, np.int64)
    ids[at] = w.doc * np.int64(len(word) + 1) + word
    marks = w.first[1:] + np.arange(w.n_docs)
    ids[marks] = np.arange(w.n_docs) * np.int64(len(word) + 1) + len(word)
    order, prefix = common_prefixes(ids)
    doc = np.empty(len(ids), np.int64)
    doc[at], doc[marks] = w.doc, np.arange(w.n_docs)
    count = lambda hit: np.bincount(doc[hit], minlength=w.n_docs)
    longest = np.zeros(w.n_docs, np.int64)
    np.maximum.at(longest, doc[order], prefix)
    return [w.count, chars, sums(_SYMBOL[w.data]), dup_lines, count(covered(order, prefix, 3)),
            count(covered(order, prefix, min_words)), longest]


def judged(texts: list[bytes], min_words: int, max_covered: int, max_longest: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first, last, columns of SCHEMA but for the first) of each block of texts."""
    for a, b in blocks(texts):
        words, chars, symbols, dup_lines, repeat, cover, longest = measure(texts[a:b], min_words)
        failed = (words < 50) | (100 * repeat > 50 * words)
        kept = ~failed & (100 * cover <= max_covered * words) & (100 * longest <= max_longest * words)
        yield a, b, [words, chars, symbols, dup_lines, repeat, failed, kept, cover, longest]


def repetition(docs: DataFrame, min_words: int = MIN_WORDS, max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Measures and verdict of every document; see the module's text."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b, found in judged(texts, min_words, max_covered, max_longest):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, found)], names=names)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def kept_documents(docs: DataFrame, min_words: int = MIN_WORDS, max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The documents that pass, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            for a, b, found in judged(texts, min_words, max_covered, max_longest):
                yield batch.slice(a, b - a).filter(pa.array(found[6]))

    return docs.mapInArrow(run, docs.schema)
