"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

*Codes.* On a bounded sample the principal axes of the vectors and a rotation of them are learned that lets signs lose as little as may be
(the rotation and the signs are fitted to each other in turn). A vector's code is the signs of its rotated coordinates. Nearness is the inner
product, so vectors are centred, the part of the product that this takes away becomes one more coordinate, and vectors are told apart by
bands of length; the length itself is not in the code.

*Index.* A code is cut into ``m`` substrings of about log2(rows) bits. Two codes at most r bits apart agree in some substring i but for
floor((r - i) / m) bits (pigeonhole: one bit less for the later ones). So each row is entered once for each substring, in the cell of its
band, substring number and the substring's leading bits, and a query probes the cells whose leading bits are that near. In a cell, rows whose
substring is near enough are candidates, of these the codes within r are ranked by the inner product of the original vectors, in double
precision. A pair is ranked at the first substring that retrieves it, and only there.

*Radius.* The first two rounds take small radii and give every query a bound, the score of its last result so far. What has to be beaten fixes the
angle, and the angle the radius within which a code of the wanted rows lies with probability ``SURE`` (a bit differs with
the angle's share of a half turn); bands that cannot reach the bound are left out. The last round searches that radius, for the queries whose
radius so far is smaller. A query with too few results looks at everything.

Equal vectors are one entry with its smallest ids, as many as a result can hold; the rest cannot be among the nearest, which are
taken by smaller id. Queries with equal vectors are one query. Cells are cut into chunks of rows and of queries, so a
cell with a third of all rows is many tasks. What leaves a cell are the best of each query there.

Vectors that are null, empty, zero, or hold nulls or numbers that are not finite take no part, nor do rows without an id. Vectors of different
lengths do not meet. Repeated rows count once; of two vectors with one id neither is found by the other. An empty table, or one without
queries, has an empty result. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import staged

#: Results of a query, and the share of rows that are queries: ids divisible by this.
NEAREST = 20
EVERY = 20
#: Vectors that the axes and the rotation are learned from. It bounds what the driver sees.
SAMPLE = 4096
#: Bits of a code at most.
BITS = 256
#: Bits that substrings may differ in, in the rounds before the last.
FLIPS = (0, 2)
#: Probability with which the code of a wanted row lies within the radius.
SURE = 0.95
#: Rows and queries of a cell that are compared in one task, and queries at once.
ROWS, QUERIES, AT_ONCE = 4096, 2048, 256
#: Rows with vectors that a task gets together, and probes that are made at once.
BUCKET, PROBES = 10_000, 20_000
#: Bands of length: a factor of two has so many.
BANDS = 2


# -- codes ------------------------------------------------------------------------------------------------------------


class Codes:
    """Learned from a sample of vectors of one length: bands and codes of rows and of queries."""

    def __init__(self, sample: np.ndarray, bits: int, seed: int = 11):
        # Scaled, so that no product of large numbers overflows.
        self.scale = float(np.abs(sample).max())
        sample = sample / self.scale
        self.mean = sample.mean(axis=0)
        moved = sample - self.mean
        along = moved @ self.mean
        # The products with the mean become one more coordinate, as large beside the row's others as its partner is beside the query's.
        size = np.sqrt((moved ** 2).sum(axis=1).mean())
        ratio = np.sqrt(np.sqrt((along ** 2).mean()) / size ** 2) if size else 0.0
        self.turn = float(ratio * size) or 1.0
        lifted = self._rows(sample)
        values, axes = np.linalg.eigh(lifted.T @ lifted)
        axes = axes[:, np.argsort(-values, kind="stable")[:bits]]
        turned = lifted @ axes
        turned = turned / np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-300)
        rotation = np.linalg.qr(np.random.RandomState(seed).standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(30):
            u, _, v = np.linalg.svd(np.where(turned @ rotation >= 0, 1.0, -1.0).T @ turned)
            rotation = (u @ v).T
        self.rotated = axes @ rotation

    def _rows(self, x: np.ndarray) -> np.ndarray:
        moved = x - self.mean
        return np.column_stack((moved, (moved @ self.mean) / self.turn))

    def rows(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signs, length) of rows."""
        lifted = self._rows(x / self.scale)
        return lifted @ self.rotated >= 0, np.linalg.norm(lifted, axis=1)

    def queries(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signs, length, what a score loses by centring) of queries."""
        x = x / self.scale
        lifted = np.column_stack((x - self.mean, np.full(len(x), self.turn)))
        return lifted @ self.rotated >= 0, np.linalg.norm(lifted, axis=1), x @ self.mean


def substrings(signs: np.ndarray, m: int, width: int) -> np.ndarray:
    """The first ``m * width`` signs as ``m`` numbers."""
    weights = 1 << np.arange(width - 1, -1, -1)
    return signs[:, :m * width].reshape(len(signs), m, width) @ weights


def radius_for(cosine: float, bits: int, sure: float = SURE) -> int:
    """Differing bits, of ``bits``, that a vector at this cosine has at most, with probability ``sure``."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    total, some = 0.0, 0
    for k in range(bits):
        log = math.lgamma(bits + 1) - math.lgamma(k + 1) - math.lgamma(bits - k + 1)
        total += math.exp(log + k * math.log(p) + (bits - k) * math.log1p(-p)) if 0 < p < 1 else float(k == 0 and p == 0)
        if total >= sure:
            return k
    return bits


def flips(radius: int, i: int, m: int) -> int:
    """Bits in which substring ``i`` may differ, so that one of ``m`` substrings finds every code within ``radius``."""
    return (radius - i) // m


def near_prefixes(prefix: int, width: int, most: int) -> list[int]:
    """All numbers of ``width`` bits at most ``most`` bits from ``prefix``."""
    return [prefix ^ sum(1 << b for b in bits) for k in range(min(most, width) + 1) for bits in combinations(range(width), k)]


# -- a cell -----------------------------------------------------------------------------------------------------------


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def _best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` best of each query, best first, ties to the smaller id; each id once for a query."""
    order = np.lexsort((vec_id, -score, query))
    query, score, vec_id = query[order], score[order], vec_id[order]
    again = np.concatenate(([False], (query[1:] == query[:-1]) & (vec_id[1:] == vec_id[:-1]))) if len(query) else np.zeros(0, bool)
    query, score, vec_id = query[~again], score[~again], vec_id[~again]
    first = np.concatenate(([0], np.flatnonzero(query[1:] != query[:-1]) + 1)) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    keep = rank < most
    return query[keep], score[keep], vec_id[keep]


def _packed(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> pa.Table:
    """One row for each query, which are next to each other."""
    first = np.concatenate(([0], np.flatnonzero(query[1:] != query[:-1]) + 1)) if len(query) else np.zeros(0, np.int64)
    ends = pa.array(np.append(first, len(query)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(c, kind)) for c, kind in ((score, pa.float64()), (vec_id, pa.int64()))]
    return pa.table([pa.array(query[first], pa.int64()), *lists], names=["query", "scores", "ids"])


def cell_best(cell: pd.DataFrame, m: int, most: int) -> Iterator[pa.Table]:
    """Of each query of a cell its best rows there. Queries have ``radius``; the cell is that of substring ``part``."""
    part = int(cell["part"].iloc[0])
    asks = cell["radius"].notna().to_numpy()
    queries, rows = cell[asks], cell[~asks]
    if not len(queries) or not len(rows):
        return
    x, code = _matrix(rows["embedding"]), np.array(rows["code"].tolist(), np.uint32)
    longest = np.linalg.norm(x, axis=1).max()
    counts = rows["ids"].map(len).to_numpy()
    first, flat = np.cumsum(counts) - counts, np.concatenate(rows["ids"].tolist())
    for a in range(0, len(queries), AT_ONCE):
        some = queries.iloc[a:a + AT_ONCE]
        q_code, radius = np.array(some["code"].tolist(), np.uint32), some["radius"].to_numpy(np.int64)[:, None]
        apart = np.zeros((len(some), len(rows)), np.uint16)
        hit = np.ones(apart.shape, bool)
        for i in range(m):
            differ = np.bitwise_count(q_code[:, i, None] ^ code[None, :, i])
            near = differ <= (radius - i) // m
            hit &= near if i == part else ~near if i < part else True
            apart += differ
        hit &= apart <= radius
        y = _matrix(some["embedding"])
        score = y @ x.T
        score[~hit] = -np.inf
        if score.shape[1] > most:  # the best ones, with all that tie with the last of them but for rounding
            last = np.partition(score, score.shape[1] - most, axis=1)[:, score.shape[1] - most, None]
            hit &= score >= last - 1e-12 * np.linalg.norm(y, axis=1, keepdims=True) * longest
        q, r = np.nonzero(hit)
        value = np.concatenate([(y[q[k:k + 4096]] * x[r[k:k + 4096]]).sum(axis=1) for k in range(0, len(q), 4096)] or [np.zeros(0)])
        n = counts[r]
        ids = flat[np.repeat(first[r], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        q, value, ids = _best(np.repeat(q, n), np.repeat(value, n), ids, most)
        yield _packed(some["key"].to_numpy(np.int64)[q], value, ids)


# -- the search -------------------------------------------------------------------------------------------------------

FOUND = "query bigint, scores array<double>, ids array<bigint>"


def _valid_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and key (equal for equal vectors) of what takes part."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    valid = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0)
    plain = F.transform("embedding", lambda v: v + F.lit(0).cast(kind[6:-1]))  # no negative zeros
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(valid)
    return rows.select("vec_id", plain.alias("embedding")).withColumn("key", F.xxhash64("embedding", F.size("embedding")))


def _cells(rows: DataFrame, sizes: DataFrame, own: str, other: str, chunk: int, other_chunk: int) -> DataFrame:
    """``rows`` in chunks of their cell, each once for every chunk of the other side."""
    parts = lambda n, most: F.floor((F.col(n) - 1) / most) + 1
    cut = sizes.select("band", "part", "prefix", parts(own, chunk).alias("_own"), parts(other, other_chunk).alias("_other"))
    return rows.join(cut, ["band", "part", "prefix"]).withColumn(own, F.pmod(F.xxhash64("key", "part"), F.col("_own")).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), (F.col("_other") - 1).cast("int")))).drop("_own", "_other")


class Index:
    """Codes of all entries of one vector length, in cells."""

    def __init__(self, entries: DataFrame, count: int, codes: Codes, bits: int, most: int):
        self.spark, self.codes, self.most = entries.sparkSession, codes, most
        self.width = max(1, min(30, bits, round(math.log2(max(2, count)))))
        self.m = max(1, bits // self.width)
        self.bits = self.m * self.width
        #: Leading bits of a substring that name its cell: of ``ROWS`` rows about, if all are equally frequent.
        self.lead = max(0, min(self.width, math.ceil(math.log2(max(1, count / ROWS)))))
        m, width, shift = self.m, self.width, self.width - self.lead

        def coded(batches: Iterator[pa.RecordBatch], query: bool) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                signs, length, *lost = codes.queries(x) if query else codes.rows(x)
                code = substrings(signs, m, width)
                extra = [pa.array(lost[0])] if query else [pa.array(np.ceil(BANDS * np.log2(np.maximum(length, 1e-30))).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(code.astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(length), *extra],
                    names=[*batch.schema.names, "code", "length", "lost" if query else "band"])

        kind = entries.schema["embedding"].dataType.simpleString()
        base = f"key bigint, embedding {kind}"
        cell = [F.posexplode("code").alias("part", "_sub")]
        prefix = F.shiftright("_sub", shift).alias("prefix")
        rows = entries.select("key", "embedding", "ids").mapInArrow(
            partial(coded, query=False), f"{base}, ids array<bigint>, code array<int>, length double, band int")
        self.rows = staged(self.spark, rows, "coded")
        self.placed = self.rows.select("band", "key", "embedding", "ids", "code", *cell).select("*", prefix).drop("_sub")
        self.row_counts = staged(self.spark, self.placed.groupBy("band", "part", "prefix").agg(F.count("*").alias("_r")), "row-counts")
        #: The greatest length of each band. Bands are powers, so there are few.
        self.bands = {r["band"]: r["most"] for r in self.rows.groupBy("band").agg(F.max("length").alias("most")).collect()}
        queries = entries.filter("asks").select("key", "embedding").mapInArrow(
            partial(coded, query=True), f"{base}, code array<int>, length double, lost double")
        self.queries = staged(self.spark, queries, "queries")

    def search(self, queries: DataFrame) -> DataFrame:
        """The best of each query within its radii. ``queries``: key, embedding, code, and ``radii`` (by band)."""
        m, lead, shift = self.m, self.lead, self.width - self.lead

        def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.select(["key", "embedding", "code"])
                at: list[int] = []
                to: list[tuple[int, int, int, int]] = []

                def flush() -> pa.RecordBatch:
                    columns = [pa.array(c, pa.int32()) for c in zip(*to, strict=True)] if to else [pa.array([], pa.int32())] * 4
                    out = pa.RecordBatch.from_arrays([*own.take(pa.array(at, pa.int64())).columns, *columns], names=names)
                    at.clear()
                    to.clear()
                    return out

                for k, (code, radii) in enumerate(zip(batch.column("code").to_pylist(), batch.column("radii").to_pylist(), strict=True)):
                    for band_radius in radii:
                        band, radius = band_radius["band"], band_radius["radius"]
                        for part in range(m):
                            if (most := flips(radius, part, m)) >= 0:
                                near = near_prefixes(code[part] >> shift, lead, most)
                                at += [k] * len(near)
                                to += [(band, part, prefix, radius) for prefix in near]
                                if len(at) > PROBES:
                                    yield flush()
                yield flush()

        names = ["key", "embedding", "code", "band", "part", "prefix", "radius"]
        kind = queries.schema["embedding"].dataType.simpleString()
        asked = queries.select("key", "embedding", "code", "radii").mapInArrow(
            probes, f"key bigint, embedding {kind}, code array<int>, band int, part int, prefix int, radius int")
        asked = staged(self.spark, asked, "probes")
        sizes = asked.groupBy("band", "part", "prefix").agg(F.count("*").alias("_q")).join(self.row_counts, ["band", "part", "prefix"])
        sizes = staged(self.spark, sizes, "cells")
        columns = ["key", "embedding", "ids", "code", "band", "part", "prefix", "radius", "_q", "_r"]
        met = _cells(asked.withColumn("ids", F.lit(None).cast("array<bigint>")), sizes, "_q", "_r", QUERIES, ROWS).select(*columns).unionByName(
            _cells(self.placed.withColumn("radius", F.lit(None).cast("int")), sizes, "_r", "_q", ROWS, QUERIES).select(*columns))
        work = sizes.agg(F.sum(F.col("_q") * F.ceil(F.col("_r") / ROWS) + F.col("_r") * F.ceil(F.col("_q") / QUERIES))).first()[0] or 0
        cell = ["band", "part", "prefix", "_q", "_r"]
        bucket = F.pmod(F.xxhash64(*cell), F.lit(work // BUCKET + 1)).alias("_bucket")

        def best(table: pa.Table) -> pa.Table:
            found = [f for _, group in table.to_pandas().groupby(cell, sort=False) for f in cell_best(group, m, self_most)]
            return pa.concat_tables(found) if found else _packed(*(np.zeros(0, np.int64),) * 3)

        self_most = self.most
        return merge(met.withColumn("_bucket", bucket).groupBy("_bucket").applyInArrow(best, FOUND), self.most, self.spark)


def merge(found: DataFrame, most: int, spark: SparkSession) -> DataFrame:
    """One row for each query: the ``most`` best of all its rows."""
    found = staged(spark, found, "found")
    count = found.count()

    def best(table: pa.Table) -> pa.Table:
        many = np.diff(table["scores"].combine_chunks().offsets.to_numpy())
        query, score, ids = (np.repeat(table["query"].to_numpy(), many), table["scores"].combine_chunks().flatten().to_numpy(),
                             table["ids"].combine_chunks().flatten().to_numpy())
        return _packed(*_best(query, score, ids, most))

    bucket = F.pmod(F.xxhash64("query"), F.lit(count // BUCKET + 1)).alias("_bucket")
    return staged(spark, found.select(bucket, "*").groupBy("_bucket").applyInArrow(best, FOUND), "best")


def _aimed(queries: DataFrame, index: Index, sure: float) -> DataFrame:
    """``queries`` (with ``last``, the score to beat, or null) with the radius to search in each band that can hold a better score."""
    cosines = np.linspace(-1, 1, 513)
    table = np.array([radius_for(c, index.bits, sure) for c in cosines])
    bands, bits, scale = sorted(index.bands.items()), index.bits, index.codes.scale

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for last, size, lost in zip(*(batch.column(c).to_pylist() for c in ("last", "length", "lost")), strict=True):
                own = []
                for band, longest in bands:
                    reach = size * longest
                    cosine = (last / scale / scale - lost) / reach if last is not None and reach else -1.0
                    if cosine <= 1 + 1e-9:
                        # At the next smaller cosine of the table, whose radius is no smaller.
                        at = int((min(cosine, 1.0) + 1) * 256)
                        own.append({"band": band, "radius": int(table[at]) if at > 0 else bits})
                out.append(own)
            radii = pa.array(out, pa.list_(pa.struct([("band", pa.int32()), ("radius", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*batch.columns, radii], names=[*batch.schema.names, "radii"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInArrow(aim, f"{schema}, radii array<struct<band:int,radius:int>>")


def nearest(vectors: DataFrame, most: int = NEAREST, every: int = EVERY, sample: int = SAMPLE, bits: int = BITS, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``most`` nearest found of each vector whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = staged(spark, _valid_rows(vectors), "vectors")
    # Only keys and ids are ranked. A query leaves out its own id, so one id more than asked for is kept.
    known = rows.select("key", "vec_id").distinct()
    few = known.withColumn("_rank", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).filter(F.col("_rank") <= most + 1)
    asked = staged(spark, known.filter(F.col("vec_id") % every == 0), "asked")
    asks = asked.select("key").distinct().withColumn("asks", F.lit(True))
    entries = rows.groupBy("key").agg(F.first("embedding").alias("embedding")).join(
        few.groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "key")
    entries = staged(spark, entries.join(asks, "key", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "entries")
    found: DataFrame | None = None
    for length, count in sorted((r[0], r[1]) for r in entries.groupBy(F.size("embedding")).count().collect()):
        of_length = entries.filter(F.size("embedding") == length)
        some = of_length.orderBy(F.xxhash64("key"), "key").limit(sample).select(F.col("embedding").cast("array<double>")).toPandas()["embedding"]
        codes = Codes(np.stack(some.tolist()), min(bits, length + 1))
        best = _search(Index(of_length, count, codes, min(bits, length + 1), most + 1), sure)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    each = found.select(F.col("query").alias("key"), F.explode(F.arrays_zip("ids", "scores")).alias("r")).join(asked, "key").select(
        F.col("vec_id").alias("query_id"), "key", F.col("r.ids").alias("vec_id"), F.col("r.scores").alias("score")).filter("query_id <> vec_id")
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")


def _search(index: Index, sure: float) -> DataFrame:
    """query, scores and ids of the best of each query of the index."""
    spark, m = index.spark, index.m
    open_, best = index.queries, None
    for k in FLIPS:
        radius = min(index.bits, m * (k + 1) - 1)
        radii = F.array(*[F.struct(F.lit(b).cast("int").alias("band"), F.lit(radius).alias("radius")) for b in sorted(index.bands)])
        found = index.search(open_.withColumn("radii", radii))
        best = found if best is None else merge(best.unionByName(found), index.most, spark)
        last = best.filter(F.size("scores") >= index.most).select(F.col("query").alias("key"), F.element_at("scores", -1).alias("last"))
        aimed = _aimed(open_.drop("radii").join(last, "key", "left"), index, sure).drop("last")
        open_ = staged(spark, aimed.filter(F.exists("radii", lambda r: r["radius"] > radius)), "open")
        if open_.isEmpty():
            return best
    return merge(best.unionByName(index.search(open_)), index.most, spark)
