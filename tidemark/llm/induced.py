"""Repeated byte strings of a corpus, by suffix arrays of shards that are sorted by induction.

Every 200-byte window of a text is named by its smallest 32-byte gram (by hash, the leftmost of equals). Equal windows have
equal grams, so windows with different grams never need to meet. Neighbouring windows with one gram form a region, which is
one row. Regions whose gram occurs once in the corpus are done. Equal regions are counted by hash: found twice or more, they
are repeated from end to end, so a passage that a third of all texts share is a few rows. Only what is left, regions found
once whose gram occurs again and one copy of each other region with that gram, is fetched as text and dealt to shards by gram.

A shard is sorted as in the method of induced sorting: suffixes are classified, the leftmost smaller ones (LMS) are sorted by
the substrings between them, recursively where substrings are equal, and all others are induced from them in two linear scans.
The scans take runs of slots at a time: a run ends before the first slot that one of its own suffixes fills. Common prefixes with
the suffix before in order are computed in text order, all regions side by side. A window with a common prefix of its whole
length is repeated, as is the one before it.

Grams with more regions than ``hot_regions`` are not dealt to a shard: their windows are counted by hash, spread over all
tasks.

Null texts count as empty. A document that comes twice has its windows twice. A table without rows gives no rows. Only ``doc_id``
and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import staged
from tidemark.llm.words import mix

WINDOW = 200
GRAM = 32
#: Most windows in a region.
LONGEST_RUN = 512
#: Bytes sorted together.
SHARD_BYTES = 6 << 20
HOT_REGIONS = 4000
#: Stands for a null doc_id while rows are joined.
NO_ID = -(1 << 63)
#: Window starts handled at once when regions are made; low bits of a key hold the place.
CHUNK = 1 << 21
_PLACE_BITS = np.uint64(22)

_SEED = np.random.RandomState(6).randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_FACTORS = (np.random.RandomState(7).randint(1, 1 << 62, 5, dtype=np.int64) * 2 + 1).astype(np.uint64)


# -- regions ---------------------------------------------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on, by doubling."""
    h, size = _SEED[data], 1
    for factor in _FACTORS:
        h = h[:-size] * factor + h[size:]
        size *= 2
    return mix(h)


def smallest(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def regions(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (gram, first window, number of windows, whether the gram is at several places) of a text."""
    for begin in range(0, len(data) - WINDOW + 1, CHUNK):
        part = data[begin:begin + CHUNK + WINDOW - 1]
        h = gram_hashes(part)
        place = np.arange(len(h), dtype=np.uint64)
        keyed = (h >> _PLACE_BITS << _PLACE_BITS) | place
        at = (smallest(keyed, WINDOW - GRAM + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        gram = h[at]
        start = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        length = np.diff(np.concatenate((start, [len(gram)])))
        moved = np.concatenate(([0], np.cumsum(at[1:] != at[:-1])))
        several = moved[start + length - 1] > moved[start]
        cuts = -(-length // LONGEST_RUN)
        which = np.repeat(np.arange(len(start)), cuts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first = start[which] + nth * LONGEST_RUN
        yield (gram[start][which].view(np.int64), first + begin,
               np.minimum(length[which] - nth * LONGEST_RUN, LONGEST_RUN), several[which])


REGIONS = "doc_id bigint, text_key bigint, gram bigint, region bigint, start int, n int, several boolean"


def region_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text_key, binary text)."""
    names = [c.split()[0] for c in REGIONS.split(", ")]
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        rows, held, out = [], 0, []

        def flush(rows=rows, out=out, ids=ids, keys=keys):
            take = pa.array(np.array(rows, np.int64))
            gram, region, start, n, several = map(np.concatenate, zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [ids.take(take), keys.take(take), pa.array(gram), pa.array(region), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(several)], names=names)

        for k, text in enumerate(batch.column(2)):
            data = np.frombuffer(text.as_buffer(), np.uint8) if len(text.as_py() or b"") >= WINDOW else None
            if data is None:
                continue
            view = memoryview(data)
            for gram, start, n, several in regions(data):
                region = np.fromiter((xxhash.xxh3_64_intdigest(view[a:a + m + WINDOW - 1]) for a, m in zip(start.tolist(), n.tolist(), strict=True)),
                                     np.uint64, len(start)).view(np.int64)
                out.append((gram, region, start, n, several))
                rows += [k] * len(start)
                held += len(start)
            if held > 50_000:
                yield flush()
                rows.clear()
                out.clear()
                held = 0
        if held:
            yield flush()


# -- suffix arrays ---------------------------------------------------------------------------------------------------


def _ranks(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by character, place of each in that order among its equals)."""
    if chars.dtype.itemsize > 2 and len(chars) > 4096:  # numpy sorts numbers of two bytes in linear time
        order = np.argsort((chars & 0xFFFF).astype(np.uint16), kind="stable")
        if len(chars) and chars.max() > 0xFFFF:
            order = order[np.argsort((chars[order] >> 16).astype(np.uint16), kind="stable")]
    else:
        order = np.argsort(chars, kind="stable")
    by = chars[order]
    new = np.concatenate(([True], by[1:] != by[:-1]))
    at = np.arange(len(by))
    return order, at - np.maximum.accumulate(np.where(new, at, 0))


def _scan(s: np.ndarray, wanted: np.ndarray, sa: np.ndarray, free: np.ndarray, up: bool) -> None:
    """One inducing scan. Each suffix puts the one that starts a character earlier, if ``wanted``, in the next free slot of
    its character; ``free`` holds these slots. ``up``: from the first slot on, else from the last one back."""
    n, i, step = len(sa), 0, 1 << 12
    view = sa if up else sa[::-1]
    wanted = np.append(wanted, (False, False))  # for the places before the first character and of empty slots
    while i < n:
        seg = view[i:i + step]
        before = seg - 1
        hit = np.flatnonzero(wanted[before])
        k = len(seg)
        if len(hit):
            source = before[hit]
            chars = s[source]
            to = free[chars] if up else n - 1 - free[chars]  # slots in the order of the scan
            reach = np.minimum.accumulate(to)  # the first slot that what comes up to here fills
            if reach[-1] < i + k:
                # The run ends at the first slot that something before it fills.
                fits = reach[:-1] > i + hit[1:]
                stop = len(hit) if fits.all() else int(np.argmin(fits)) + 1
                k = min(k, int(reach[stop - 1]) - i)
                stop = int(np.searchsorted(hit[:stop], k))
                source, chars = source[:stop], chars[:stop]
            order, rank = _ranks(chars)
            by = chars[order]
            place = free[by]
            sa[place + rank if up else place - rank] = source[order]
            last = np.append(np.flatnonzero(rank[1:] == 0), len(rank) - 1)  # of each character, its last
            free[by[last]] += rank[last] + 1 if up else -(rank[last] + 1)
        i += k
        step = min(1 << 18, max(64, 2 * k))


def _induce(s: np.ndarray, smaller: np.ndarray, first: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order. ``first``: each character's first slot, and the end."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    order, rank = _ranks(s[lms])
    by = s[lms][order].astype(np.int64)
    many = np.bincount(by, minlength=len(first) - 1)
    sa[first[by + 1] - many[by] + rank] = lms[order]
    _scan(s, ~smaller, sa, first[:-1].copy(), True)
    slots = np.flatnonzero(sa >= 0)
    sa[slots[smaller[sa[slots]]]] = -1
    sa[0] = n - 1
    _scan(s, smaller, sa, first[1:] - 1, False)
    sa[0] = n - 1
    return sa


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` in order. ``s`` holds integers from 0 on, and ends in its only 0. Its length fits four bytes."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    # A suffix is smaller than the next one if its first differing neighbour is.
    differs = np.flatnonzero(s[:-1] != s[1:])
    smaller = np.ones(n, bool)
    smaller[:-1] = np.repeat(s[differs] < s[differs + 1], np.diff(differs, prepend=-1))
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    first = np.concatenate(([0], np.cumsum(np.bincount(s))))
    sa = _induce(s, smaller, first, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    # Substrings from one LMS place to the next, both included, get names in order.
    length = np.zeros(n, np.int32)
    length[lms] = np.concatenate((np.diff(lms) + 1, [1]))
    same = length[ordered[1:]] == length[ordered[:-1]]
    left = np.flatnonzero(same)
    a, b, most = ordered[left], ordered[left + 1], length[ordered[left]]
    offset = 0
    while len(left):
        equal = s[a + offset] == s[b + offset]
        same[left[~equal]] = False
        go = equal & (offset + 1 < most)
        left, a, b, most = left[go], a[go], b[go], most[go]
        offset += 1
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(lms):
        name = np.zeros(n, np.int32)
        name[ordered] = names
        ordered = lms[suffix_array(name[lms])]
    return _induce(s, smaller, first, ordered)


def repeated_windows(texts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """Of each text the places where a ``window`` starts that also starts at another place of these texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
    # 0 ends all texts, 1 ends each one.
    s = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8).astype(np.uint16) + np.uint16(2)
    s[starts + lengths] = 1
    s[-1] = 0
    sa = suffix_array(s)
    before = np.empty(len(s), np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = sa[0]
    # Common prefixes in text order: one character on, a prefix is at most one shorter. Texts go side by side.
    hit = np.zeros(len(s), bool)
    prefix = np.zeros(len(texts), np.int64)
    live = np.flatnonzero(lengths >= window)
    t = 0
    while len(live):
        i = starts[live] + t
        j = before[i]
        size = np.maximum(prefix[live] - 1, 0)
        grow = np.arange(len(live))
        while len(grow):
            x, y = i[grow] + size[grow], j[grow] + size[grow]
            grow = grow[(s[x] == s[y]) & (s[x] > 1)]
            size[grow] += 1
        prefix[live] = size
        full = size >= window
        hit[i[full]] = True
        hit[j[full]] = True
        t += 1
        live = live[lengths[live] - t >= window]
    return [np.flatnonzero(hit[a:a + m]) for a, m in zip(starts, lengths, strict=True)]


def _spans(places: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.concatenate(([0], cut + 1))].tolist(), places[np.concatenate((cut, [len(places) - 1]))].tolist(), strict=True))


SPANS = "doc_id bigint, text_key bigint, a int, b int"


def sort_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans of repeated bytes in the regions that occur once."""
    found = repeated_windows(list(rows["bytes"]))
    out = [(d, k, start + a, start + b + WINDOW)
           for d, k, start, once, places in zip(rows["doc_id"], rows["text_key"], rows["start"], rows["once"], found, strict=True)
           if once for a, b in _spans(places)]
    return pd.DataFrame(out, columns=["doc_id", "text_key", "a", "b"])


# -- the operator ----------------------------------------------------------------------------------------------------


def keyed_documents(docs: DataFrame) -> DataFrame:
    """doc_id (``NO_ID`` for null), hash of the text, and the text as bytes. Rows that agree in both are copies."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("bytes"))


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """(doc_id, text_key, a, b): bytes a ... b - 1 are covered by repeated windows. Spans may overlap. ``docs``: keyed documents."""
    spark = docs.sparkSession
    place = ["doc_id", "text_key", "start", "n"]
    rows = staged(spark, docs.filter(F.octet_length("bytes") >= WINDOW).mapInArrow(region_rows, REGIONS), "regions")
    again = rows.groupBy("gram").agg(F.count("*").alias("_n"), F.max("several").alias("_s")).filter("_n > 1 or _s").select("gram")
    candidates = staged(spark, rows.join(again, "gram"), "candidates")
    counted = candidates.groupBy("gram", "region").agg(
        F.count("*").alias("copies"), F.min(F.struct(*place)).alias("one"), F.max("several").alias("several"))
    counted = staged(spark, counted, "counted")
    whole = (candidates.join(counted.filter("copies > 1").select("gram", "region"), ["gram", "region"])
             .select("doc_id", "text_key", F.col("start").alias("a"), (F.col("start") + F.col("n") + WINDOW - 1).alias("b")))
    # Regions found once need their text, as do the others with their gram.
    open_grams = (counted.groupBy("gram").agg(F.min("copies").alias("_least"), F.count("*").alias("regions"), F.max("several").alias("_s"))
                  .filter("_least = 1 and (regions > 1 or _s)").select("gram", "regions"))
    needed = (counted.select("gram", "one.*", (F.col("copies") == 1).alias("once")).join(open_grams, "gram")
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "start", "n", "once", "regions")).alias("parts")))
    cut = docs.join(needed, ["doc_id", "text_key"]).select("doc_id", "text_key", F.explode(F.expr(
        f"transform(parts, p -> named_struct('gram', p.gram, 'start', p.start, 'once', p.once, 'regions', p.regions, "
        f"'bytes', substring(bytes, p.start + 1, p.n + {WINDOW - 1})))")).alias("p")).select("doc_id", "text_key", "p.*")
    cut = staged(spark, cut, "region-texts")
    size = cut.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = size // shard_bytes + 1
    cold = cut.filter(F.col("regions") <= hot_regions).withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    sorted_ = cold.drop("gram", "regions").groupBy("shard").applyInPandas(sort_shard, SPANS)
    windows = cut.filter(F.col("regions") > hot_regions).select(
        "doc_id", "text_key", "once", F.posexplode(F.expr(
            f"transform(sequence(1, octet_length(bytes) - {WINDOW - 1}), i -> md5(substring(bytes, i, {WINDOW})))")).alias("i", "h"), "start")
    twice = windows.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    hot = windows.filter("once").join(twice, "h").select(
        "doc_id", "text_key", (F.col("start") + F.col("i")).alias("a"), (F.col("start") + F.col("i") + WINDOW).alias("b"))
    return whole.unionByName(sorted_).unionByName(hot)


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs, as structs a, b) and kept (remaining bytes) of every document."""
    keyed = keyed_documents(docs)
    spans = repeated_spans(keyed, shard_bytes, hot_regions)
    # A text has fewer spans than bytes; copies of a row share theirs.
    by_text = spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("found"))
    joined = keyed.join(by_text, ["doc_id", "text_key"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            merged, kept = [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                runs: list[list[int]] = []
                for span in found or []:
                    if runs and span["a"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span["b"])
                    else:
                        runs.append([span["a"], span["b"]])
                merged.append([{"a": a, "b": b} for a, b in runs])
                edges = [0, *[x for run in runs for x in run], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.as_py()) for t in batch.column(1)], pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])

    ids = F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id")
    return joined.select(ids, "bytes", "found").mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, spans array<struct<a:int,b:int>>, kept binary")
