"""Periodic runs of words, by maximal pairs in the tree of longest-common-prefix intervals.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``least`` words and ``times`` periods long, that no
neighbouring word extends. Words i and i + q of it begin a maximal pair: the strings from there are equal for some words (all of the run but
its first period), but not one word longer on either side. So the runs are the maximal pairs whose distance q is at most
1 / (times - 1) of their length; nothing has to be extended.

The suffixes of the words are sorted; those that share a prefix form intervals, which nest to a tree. From the deepest interval up, the
positions of an interval's children are merged, the shorter list into the longer one, in text order, each with its left word as its class. Two
positions from different children differ in the word to the right; if their classes differ, too, they are a maximal pair. Within half of the
string's length, its places lie one period apart, and all but the first have the same left word. So a pair that gives a run's smallest period is
next to each other in the list, and only neighbours have to be looked at. A stretch found with several distances keeps the smallest.

Intervals of too short prefixes cannot hold a run and are not entered. A text is a unit: it takes some sixty times its bytes while it is sorted.
Null texts and texts without words have no runs. Repeated rows give repeated results, an empty table an empty one. Other columns may have any
name.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repetition import common_prefixes
from tidemark.llm.words import Words, blocks

#: Words and periods that a run has at least.
LEAST = 24
TIMES = 3
#: From this size a shorter list is merged by sorting instead of one by one.
BULK = 32

#: Of a document's id and number of words: from which word on how many words are repeated, or None.
Plant = Callable[[int | None, int], tuple[int, int] | None]

SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def maximal_pairs(place: list[int], shared: list[int], left: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, period, length) of the maximal pairs whose distance makes them a run.

    ``place`` are suffixes in sorted order, ``shared[k]`` the words that the k-th has in common with the one before; ``left`` is the word
    before each place of the text.
    """
    out: list[tuple[int, int, int]] = []

    def look(i: int, j: int, length: int) -> None:
        q = j - i
        if q * (times - 1) <= length and length + q >= least and left[i] != left[j]:
            out.append((i, q, length + q))

    def merged(a: list[int], b: list[int], length: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for p in b:
            k = bisect_left(a, p)
            if k:
                look(a[k - 1], p, length)
            if k < len(a):
                look(p, a[k], length)
        if len(b) > BULK:
            a += b
            a.sort()
        else:
            for p in b:
                insort(a, p)
        return a

    lists: list[list[int]] = [[place[0]]] if place else []
    depths: list[int] = []
    for p, length in zip(place[1:], shared[1:], strict=True):
        while depths and depths[-1] > length:
            last = lists.pop()
            lists[-1] = merged(lists[-1], last, depths.pop())
        depths.append(length)
        lists.append([p])
    while depths:
        last = lists.pop()
        lists[-1] = merged(lists[-1], last, depths.pop())
    return out


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of the runs in ``ids``: word numbers, in which each text ends in a mark that
    occurs nowhere else."""
    order, prefix = common_prefixes(ids)
    # A run's pair shares its length without the first period: (times - 1) / times of it or more.
    short = -(-least * (times - 1) // times)
    deep = prefix >= short
    first = np.append(deep[1:], False) & ~deep if len(deep) else deep
    some = deep | first
    shared = np.where(deep, prefix, 0)[some].tolist()
    place = order[some].tolist()
    left = np.concatenate(([-1], ids[:-1]))
    starts = [k for k, length in enumerate(shared) if not length] + [len(place)]
    found: dict[tuple[int, int], int] = {}
    words_before = left.tolist() if place else []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        for i, q, length in maximal_pairs(place[a:b], shared[a:b], words_before, least, times):
            key = (i, length)
            if found.get(key, q) >= q:
                found[key] = q
    out = np.array(sorted((i, length, q) for (i, length), q in found.items()), np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def word_numbers(w: Words) -> np.ndarray:
    """A number for each word; equal words have equal ones."""
    return np.unique(w.hashes(), return_inverse=True)[1].astype(np.int64)


def repeated(n: int, h: int) -> tuple[int, int]:
    """(a, p): from word ``a`` on, a text of ``n`` words repeats ``p`` words, as the number ``h`` has it."""
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a tenth of the documents, by the checksum of their id, is made periodic."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    return repeated(n, h) if h % 10 == 0 else None


def _texts_with_runs(texts: list[bytes], doc_ids: list, plant: Plant | None, least: int, times: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(number of words, runs, text without what runs repeat) of each text."""
    w = Words(texts)
    numbers, n_docs = word_numbers(w), w.n_docs
    sources: list[np.ndarray | None] = [None] * n_docs  # which own word stands at each place
    for k, doc_id in enumerate(doc_ids if plant else ()):
        if where := plant(doc_id, int(w.count[k])):
            a, p = where
            place = np.arange(w.count[k])
            sources[k] = np.where(place >= a, a + (place - a) % p, place)
    at = np.arange(len(numbers)) + w.doc
    marks = w.first[1:] + np.arange(n_docs)
    words = np.arange(len(numbers))
    for k, source in enumerate(sources):
        if source is not None:
            words[w.first[k]:w.first[k + 1]] = w.first[k] + source
    ids = np.empty(len(numbers) + n_docs, np.int64)
    wide = len(numbers) + 1
    ids[at] = w.doc * wide + numbers[words]
    ids[marks] = np.arange(n_docs) * wide + len(numbers)
    found = runs_of(ids, least, times)
    which = np.searchsorted(marks, found[:, 0])
    found[:, 0] -= which  # as word numbers of the block
    dropped = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(dropped)[:-1] == 0
    bounds = np.searchsorted(which, np.arange(n_docs + 1))
    for k in range(n_docs):
        a, b = int(w.first[k]), int(w.first[k + 1])
        own = found[bounds[k]:bounds[k + 1]] - [a, 0, 0]
        text = texts[k].split()
        source = sources[k]
        kept = np.flatnonzero(keep[a:b])
        kept = (kept if source is None else source[kept]).tolist()
        yield b - a, own, b" ".join(text if len(kept) == b - a and source is None else map(text.__getitem__, kept))


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES,
                  plant: Plant | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and the text with each run cut to its first period (words joined by a space).

    ``plant`` may name for a document (a, p): from word a on its text repeats p words instead of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for first, last in blocks(texts):
                n_words, found, collapsed = zip(*_texts_with_runs(texts[first:last], ids[first:last], plant, least, times), strict=True)
                flat = np.concatenate(found)
                ends = np.concatenate(([0], np.cumsum([len(f) for f in found])))
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(n_words, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def greatest(runs: Column) -> Column:
    """The run with most periods, compared exactly; of equal ones the first, then that with the smaller period."""

    def better(best: Column, x: Column) -> Column:
        # Products of word counts of one text stay within 64 bits.
        gain = x["length"] * best["period"] - best["length"] * x["period"]
        first = (x["start"] < best["start"]) | ((x["start"] == best["start"]) & (x["period"] < best["period"]))
        return best.isNull() | (gain > 0) | ((gain == 0) & first)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))
