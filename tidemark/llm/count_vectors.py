"""Near duplicates by word shingles: a similarity join whose candidates come from count vectors in R-trees.

A document's set holds the hashes of its distinct five-word shingles (the whole sequence if it has fewer words). Documents
with equal sets are one entity from then on. Shingles are hashed into groups twice over:

* Coarse groups (512): a set's count vector is a point. Two sets share at most the sum of the smaller counts of each group,
  which bounds their similarity without either set at hand. The same sum over two boxes bounds all pairs between them.
* Fine groups (65,536), whose counts over the whole corpus order all shingles from rare to common. Sets of similarity 0.8 share
  at least one of the rarest fifth of their shingles (plus one), so these shingles spread the join: sets with one in
  common are a block. The order comes from counts of groups, not of shingles, which only decides how small blocks are.

In each block the points are packed into an R-tree which is joined with itself; pairs whose bound allows similarity 0.8 are
verified on the whole sets. What is asked for is which documents hang together, so links are looked for in rounds: first
from each set to the smallest set it shares a block with, then to its best partner in another component in a few of its blocks, at
last between all pairs of all blocks that are still in different components. Members of one component are not compared any more, so
a large group of near copies never becomes all its pairs. Blocks over ``chunk`` rows are cut into a grid of cells.

Null texts and texts without words have an empty set and hang on nothing. Repeated rows and ties are copies with equal sets. A
null doc_id takes part, but does not name a component unless no member has an id. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cells import gridded, matrix, per_cell
from tidemark.llm.components import components
from tidemark.llm.stage import staged
from tidemark.llm.words import Words, blocks, mix, windows

SHINGLE = 5
#: Percent of the union that has to be shared.
PERCENT = 80
COARSE = 512
FINE_BITS = 16
#: Rows of a block that are compared in one task.
CHUNK = 2048
#: Blocks of each set that the second round looks at. It only saves the last one work.
FIRST_BLOCKS = 3
#: Rows with points that a task gets together.
BUCKET = 5_000
#: Rows of a cell that look for partners at once.
ROWS = 256
#: Bits of the filter that keeps sets without candidates out of a shuffle: 1 MB.
FILTER_BITS = 1 << 23
FILTER_RANGES = 16
#: Slots that rare shingles are counted in, to drop those of one set before they are shuffled: a bit each, 32 MB. With far more
#: shingles than slots it drops few, and the join still finds all.
SLOT_BITS = 28
SLOT_RANGES = 256


# -- sets ------------------------------------------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    for first, last in blocks(texts):
        w = Words([t.lower() for t in texts[first:last]])  # of bytes: ASCII letters only
        word = w.numbers()
        long = windows(word, size)
        for k in range(last - first):
            a, b = w.first[k], w.first[k + 1]
            if b - a >= size:
                s = np.sort(long[a:b - size + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield windows(word[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A hash of the whole set."""
    h = mix(s + np.uint64(0x9E3779B97F4A7C15))
    return int(mix(np.array([h.sum(dtype=np.uint64) ^ np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def fine_counts(docs: DataFrame) -> np.ndarray:
    """How many shingles of the corpus each fine group holds, repeated ones too. The result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << FINE_BITS, np.int64)
        for batch in batches:
            texts = _texts(batch, 0)
            for first, last in blocks(texts):
                w = Words([t.lower() for t in texts[first:last]])
                long = windows(w.numbers(), SHINGLE)
                inside = w.doc[:len(long)] == w.doc[SHINGLE - 1:]  # does not run on into the next text
                counts += np.bincount((long[inside] >> np.uint64(64 - FINE_BITS)).astype(np.int64), minlength=1 << FINE_BITS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["g", "c"])

    total = docs.select("text").mapInArrow(run, "g int, c bigint").groupBy("g").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros(1 << FINE_BITS, np.int64)
    out[total["g"].to_numpy(np.int64)] = total["c"].to_numpy(np.int64)
    return out


def rare_first(s: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """The shingles one of which any set as similar as asked for shares: the rarest ones, ties included."""
    n = len(s)
    most = n - -(-percent * n // 100) + 1
    if most >= n:
        return s
    count = order[(s >> np.uint64(64 - FINE_BITS)).astype(np.int64)]
    last = np.partition(count, most - 1)[most - 1]
    sure, tied = s[count < last], s[count == last]  # s is sorted, so equally common shingles are in order of their hash
    return np.concatenate((sure, tied[:most - len(sure)]))


def _slots(rare: np.ndarray) -> np.ndarray:
    """Slot of each shingle: bits that neither kind of group uses."""
    return (rare >> np.uint64(8)) & np.uint64((1 << SLOT_BITS) - 1)


def _more(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c == "_row"]


def rare_sets(docs: DataFrame, order: np.ndarray, percent: int) -> DataFrame:
    """doc_id, set_key, n (its size), rare (its rare shingles), text_key (a hash of the text), and ``_row`` if ``docs`` has it."""
    more = _more(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, rare = [], [], []
            for s in shingle_sets(_texts(batch, 1)):
                key.append(set_key(s))
                n.append(len(s))
                rare.append(rare_first(s, order, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(rare, pa.list_(pa.int64())), *batch.columns[2:]],
                names=["doc_id", "set_key", "n", "rare", "text_key", *more])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), *more).mapInArrow(
        run, "doc_id bigint, set_key bigint, n bigint, rare array<bigint>, text_key bigint" + "".join(f", {c} bigint" for c in more))


def _flat(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def shared_slots(sets: DataFrame) -> np.ndarray:
    """A bit per slot: whether two rows or more have rare shingles there. The result has a fixed size."""
    wide = np.uint64(SLOT_BITS - (SLOT_RANGES - 1).bit_length())
    per_range = 1 << int(wide)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            cuts = np.searchsorted(found, np.arange(SLOT_RANGES + 1, dtype=np.uint64) << wide)
            low = (found & np.uint64(per_range - 1)).astype(np.uint32)
            at = [k for k in range(SLOT_RANGES) if cuts[k] < cuts[k + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([low[cuts[k]:cuts[k + 1]].tobytes() for k in at], pa.binary())], names=["r", "low"])

        for batch in batches:
            held.append(_slots(_flat(batch.column(0))))
            if sum(map(len, held)) > 2_000_000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r, low in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                once, again = met.setdefault(r, (np.zeros(per_range, bool), np.zeros(per_range, bool)))
                places, counts = np.unique(np.frombuffer(low.as_buffer(), np.uint32), return_counts=True)
                again[places] |= once[places] | (counts > 1)
                once[places] = True
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array([np.packbits(again).tobytes() for _, again in met.values()], pa.binary())],
                                         names=["r", "bits"])

    found = sets.select("rare").mapInArrow(slots, "r int, low binary").repartition("r").mapInArrow(twice, "r int, bits binary").collect()
    bits = np.zeros((SLOT_RANGES, per_range // 8), np.uint8)
    for row in found:
        bits[row["r"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def spread_sets(sets: DataFrame) -> DataFrame:
    """``rare_sets`` with the rare shingles that spread the join: but for those of one document."""
    bits = sets.sparkSession.sparkContext.broadcast(shared_slots(sets))
    at = sets.columns.index("rare")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = bits.value
        for batch in batches:
            rare = batch.column(at)
            flat, offsets = _flat(rare), rare.offsets.to_numpy()
            slot = _slots(flat)
            # packbits puts the first of eight slots into the highest bit.
            hit = ((shared[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1).astype(bool)
            ends = np.concatenate(([0], np.cumsum(hit)))[offsets - offsets[0]]
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[hit].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], kept, *batch.columns[at + 1:]], names=batch.schema.names)

    return sets.mapInArrow(run, sets.schema)


def _point(s: np.ndarray) -> np.ndarray:
    return np.bincount((s & np.uint64(COARSE - 1)).astype(np.int64), minlength=COARSE).astype(np.int32)


# -- the tree --------------------------------------------------------------------------------------------------------


class RTree:
    """Points packed into boxes, boxes into larger ones."""

    LEAF, FAN = 16, 8

    def __init__(self, size: np.ndarray, counts: np.ndarray):
        self.order = self._packed(np.column_stack((size, counts)))
        self.size, self.counts = size[self.order], counts[self.order]
        #: From the leaves up: (least size, greatest count of each group, first member, end of members).
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size, high, fan = self.size, self.counts, self.LEAF
        while True:
            first = np.arange(0, len(size), fan)
            end = np.minimum(first + fan, len(size))
            size, high = np.minimum.reduceat(size, first), np.maximum.reduceat(high, first)
            self.levels.append((size, high, first, end))
            if len(first) == 1:
                return
            fan = self.FAN

    def _packed(self, points: np.ndarray) -> np.ndarray:
        """Split at the middle of the widest coordinate until leaves are full."""
        out, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= self.LEAF:
                out.append(rows)
                continue
            spread = points[rows].max(axis=0) - points[rows].min(axis=0)
            rows = rows[np.argsort(points[rows, spread.argmax()], kind="stable")]
            middle = (len(rows) // 2 + self.LEAF - 1) // self.LEAF * self.LEAF
            todo += [rows[middle:], rows[:middle]] if 0 < middle < len(rows) else [rows[self.LEAF:], rows[:self.LEAF]]
        return np.concatenate(out)


def may_link(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (a + b - overlap)


def tree_join(left: RTree, right: RTree, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of left, row of right, bound on what they share) of all pairs that may link."""
    shared = lambda x, y: np.minimum(x, y).sum(axis=1, dtype=np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo = [(len(left.levels) - 1, len(right.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        i, j, a, b = todo.pop()
        if len(a) > 4096:  # in pieces, to bound memory
            todo += [(i, j, a[k:k + 4096], b[k:k + 4096]) for k in range(0, len(a), 4096)]
            continue
        # Level -1 is the points themselves.
        size_a, high_a = (left.size, left.counts) if i < 0 else left.levels[i][:2]
        size_b, high_b = (right.size, right.counts) if j < 0 else right.levels[j][:2]
        bound = shared(high_a[a], high_b[b])
        ok = may_link(bound, size_a[a], size_b[b], percent)
        a, b, bound = a[ok], b[ok], bound[ok]
        if i < 0 and j < 0:
            out.append((left.order[a], right.order[b], bound))
        elif len(a):
            side, level, which = (left, i, a) if i >= j else (right, j, b)
            first, end = side.levels[level][2][which], side.levels[level][3][which]
            many = end - first
            members = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            if i >= j:
                todo.append((i - 1, j, members, np.repeat(b, many)))
            else:
                todo.append((i, j - 1, np.repeat(a, many), members))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64),) * 3


def block_pairs(table: pa.Table, starts: np.ndarray, percent: int, best: bool) -> pa.Table:
    """Pairs of each cell (columns set_key, component, n, counts, chunk) in different components that may link.

    All rows but those of the largest component look for partners. ``best``: of each one's partners only the one that may share most.
    """
    key, comp, n, chunk = (table[c].to_numpy() for c in ("set_key", "component", "n", "chunk"))
    counts = matrix(table, "counts")
    out = [(np.zeros(0, np.int64),) * 2]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        names, which, many = np.unique(comp[a:b], return_inverse=True, return_counts=True)
        if len(names) < 2:
            continue
        cut = a + int(np.searchsorted(chunk[a:b], chunk[b - 1]))  # the second chunk's first row; ``a`` if there is one chunk
        foreign = np.flatnonzero(which != many.argmax()) + a
        for left, right in ([(foreign, np.arange(a, b))] if cut == a else [
                (foreign[foreign < cut], np.arange(cut, b)), (foreign[foreign >= cut], np.arange(a, cut))]):
            whole = RTree(n[right], counts[right]) if len(left) and len(right) else None
            for start in range(0, len(left) if whole else 0, ROWS):  # some rows at a time, to bound what is held of pairs
                some = left[start:start + ROWS]
                i, j, bound = tree_join(RTree(n[some], counts[some]), whole, percent)
                i, j = some[i], right[j]
                keep = comp[i] != comp[j]
                i, j, bound = i[keep], j[keep], bound[keep]
                if best and len(i):
                    order = np.lexsort((-bound, i))
                    rows = order[np.concatenate(([True], i[order][1:] != i[order][:-1]))]
                    i, j = i[rows], j[rows]
                out.append((np.minimum(key[i], key[j]), np.maximum(key[i], key[j])))
    x, y = map(np.concatenate, zip(*out, strict=True))
    return pa.table({"a": pa.array(x), "b": pa.array(y)}).group_by(["a", "b"]).aggregate([])


# -- the join --------------------------------------------------------------------------------------------------------


def _active_filter(texts: DataFrame) -> np.ndarray:
    """A fixed-size bit array with the hashed places of ``texts`` (text_key) set. The driver gets it as bits, by range."""
    per_range = FILTER_BITS // FILTER_RANGES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        for batch in batches:
            at, place = (batch.column(k).to_numpy() for k in (0, 1))
            for r in np.unique(at).tolist():
                met.setdefault(r, np.zeros(per_range, bool))[place[at == r]] = True
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array([np.packbits(x).tobytes() for x in met.values()], pa.binary())],
                                         names=["r", "bits"])

    places = texts.select(F.pmod("text_key", F.lit(FILTER_BITS)).cast("int").alias("p")).distinct()
    ranges = places.select(F.expr(f"p div {per_range}").cast("int").alias("r"), F.expr(f"p % {per_range}").alias("place")).repartition("r")
    bits = np.zeros((FILTER_RANGES, per_range // 8), np.uint8)
    for row in ranges.mapInArrow(pack, "r int, bits binary").collect():
        bits[row["r"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def active_sets(docs: DataFrame, sets: DataFrame, active: DataFrame) -> DataFrame:
    """set_key, n, counts and packed text of the sets in ``active`` (set_key), each once. A packed text is smaller than its set.
    Only texts that ``sets`` (set_key, text_key) gives for one of them are looked at."""
    bits = docs.sparkSession.sparkContext.broadcast(_active_filter(sets.join(active, "set_key", "left_semi")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(bits.value).astype(bool)
        texts_seen: set[int] = set()  # of this task: of many copies each task gives one
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(1).to_numpy()
            at = []
            for i in np.flatnonzero(wanted[np.mod(keys, FILTER_BITS)]).tolist():
                if (text := int(keys[i])) not in texts_seen:
                    texts_seen.add(text)
                    at.append(i)
            texts = _texts(batch.take(pa.array(at, pa.int64())), 0)
            found = {k: (len(s), _point(s), t) for t, s in zip(texts, shingle_sets(texts), strict=True)
                     if len(s) and (k := set_key(s)) not in seen}
            seen.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.int64()), pa.array([n for n, _, _ in found.values()], pa.int64()),
                 pa.array([c for _, c, _ in found.values()], pa.list_(pa.int32())),
                 pa.array([zlib.compress(t, 1) for _, _, t in found.values()], pa.binary())], names=["set_key", "n", "counts", "packed"])

    texts = docs.select("text", F.xxhash64("text").alias("text_key"))
    found = texts.mapInArrow(run, "set_key bigint, n bigint, counts array<int>, packed binary")
    return found.join(active, "set_key", "left_semi").dropDuplicates(["set_key"])


def _bound(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda t, x: t + x)


def _similar(shared: Column, percent: int) -> Column:
    return 100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) that link: bounded by their points first, then on the whole sets."""

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("set_key").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = [None, None]  # rows with one b follow each other
        for batch in batches:
            keep = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if last[0] != b:
                    last = [b, next(shingle_sets([zlib.decompress(y)]))]
                s = next(shingle_sets([zlib.decompress(x)]))
                shared = len(np.intersect1d(s, last[1], assume_unique=True))
                keep.append(bool(may_link(shared, len(s), len(last[1]), percent)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.join(side("a", "n", "counts"), "a").join(side("b", "n", "counts"), "b")
    near = staged(pairs.sparkSession, near.filter(_similar(_bound("counts_a", "counts_b"), percent)).select("a", "b"), "near")
    whole = near.join(side("a", "packed"), "a").join(side("b", "packed"), "b").select("a", "b", "packed_a", "packed_b")
    return whole.mapInArrow(check, "a bigint, b bigint")


def in_components(docs: DataFrame, percent: int, chunk: int) -> DataFrame:
    """doc_id, n, component (of a set that is not empty) of each row of ``docs`` (doc_id, text), and ``_row`` if ``docs`` has it."""
    spark = docs.sparkSession
    # Stored with all rare shingles first: what is shared is counted, and then dropped, without going through the texts again.
    sets = staged(spark, spread_sets(staged(spark, rare_sets(docs, fine_counts(docs), percent), "rare")), "sets")
    rare = sets.select("set_key", F.explode("rare").alias("token"))
    # A token of one set only, however many copies it has, joins nothing.
    shared = rare.groupBy("token").agg(F.min("set_key").alias("hub"), F.max("set_key").alias("_most")).filter("hub <> _most").select("token", "hub")
    members = staged(spark, rare.join(shared, "token").select("token", "set_key", "hub").distinct(), "members")
    active = members.select("set_key").distinct()
    points = staged(spark, active_sets(docs, sets, active), "points")

    hubs = members.groupBy(F.col("set_key").alias("a")).agg(F.min("hub").alias("b")).filter("a <> b")
    links = staged(spark, verified(hubs, points, percent), "links")
    # Names that are not final yet only cost comparisons, of which the second round makes few.
    found = staged(spark, components(links, rounds=2), "components")
    first = members.groupBy("set_key").agg(F.array_sort(F.collect_set("token")).alias("t")).select(
        "set_key", F.explode(F.slice("t", 1, FIRST_BLOCKS)).alias("token"))
    for best in (True, False):
        some = members.join(first, ["set_key", "token"]) if best else members
        placed = some.join(found.withColumnRenamed("key", "set_key"), "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
        # Blocks with sets of several components; of blocks with the same members one is enough.
        open_ = (placed.groupBy("token").agg(
            F.min("component").alias("_a"), F.max("component").alias("_b"), F.count("*").alias("_n"),
            F.bit_xor(F.xxhash64("set_key")).alias("_x"), F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("_y"))
            .filter("_a <> _b").groupBy("_n", "_x", "_y").agg(F.min("token").alias("token")).select("token", "_n"))
        rows = staged(spark, gridded(placed, open_, ["token"], "set_key", chunk), "cells")
        pointed = rows.join(points.select("set_key", "n", "counts"), "set_key").select("token", "i", "j", "chunk", "set_key", "component", "n", "counts")
        pairs = per_cell(pointed, rows.count(), ["token", "i", "j"], [], partial(block_pairs, percent=percent, best=best), "a bigint, b bigint", BUCKET).distinct()
        more = staged(spark, verified(pairs, points, percent), "links")
        links = links.unionByName(more)
        if best:  # whole components: the last round compares no two sets that already hang together
            found = staged(spark, components(links), "components")
        elif not more.isEmpty():
            found = components(links)

    more = _more(sets)
    return sets.select("doc_id", "set_key", "n", *more).join(found.withColumnRenamed("key", "set_key"), "set_key", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "set_key")).alias("component"), *more)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = in_components(docs, percent, chunk)
    names = own.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return own.join(names, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (any id before none), of rows with one id that with the
    smallest hash, and of copies of a whole row one. Rows without words stay. Columns with maps tell no rows apart."""
    key, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(F.lit(0), *[x for c in plain for x in (c, c.isNull())])
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r ", "") == ""
    own = in_components(docs.filter(~blank).select(key.alias("doc_id"), text.alias("text"), row.alias("_row")), percent, chunk)
    kept = (own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_best"))
            .select(F.coalesce("_best.doc_id", F.lit(0)).alias("_key"), F.col("_best._row").alias("_row")))
    # Copies of a row meet before the join, and combine before they are shuffled.
    rows = (docs.filter(~blank).select(F.coalesce(key, F.lit(0)).alias("_key"), row.alias("_row"), F.struct("*").alias("_doc"))
            .groupBy("_key", "_row").agg(F.first("_doc").alias("_doc")))
    return rows.join(kept, ["_key", "_row"], "left_semi").select("_doc.*").unionByName(docs.filter(blank))
