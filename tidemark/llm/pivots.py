"""Near duplicates among vectors by a pivot-permutation index.

Some vectors of the table, far apart from each other, are pivots. Each vector is described by its ``nearest`` pivots in
order of nearness, and entered in the inverted lists of all pairs of these. Two vectors that share two or more pivots so meet in
the list of each pair they share; that count is the candidate test. In the list of the first pair they share, and only there,
the cosine is computed in double precision and compared. Equal vectors are one entry with a count. The links of a list leave it
as counts per vector and as links of each vector to one of its group, never as all pairs. Lists over ``chunk`` vectors are cut into a
grid of cells.

Vectors that are null, empty, zero, or hold nulls or numbers that are not finite link with nothing. Vectors of different
lengths do not link. Repeated rows are copies and link with each other. Null ids take part, but name a component only if no
member has an id. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cells import gridded, matrix, per_cell
from tidemark.llm.components import components
from tidemark.llm.stage import staged

LEAST = 0.95
#: Pivots at most, and how many vectors they are chosen from. Both bound what the driver sees.
PIVOTS = 512

#: Pivots are at a smaller cosine than this from each other.
APART = 0.8
#: Nearest pivots that describe a vector.
NEAREST = 6
CHUNK = 4096


def choose_pivots(sample: np.ndarray, most: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """Rows of ``sample`` (unit vectors) taken in order if they are far from those taken before."""
    taken = np.empty((0, sample.shape[1]))
    for row in sample:
        if len(taken) == most:
            break
        if not len(taken) or (taken @ row).max() < apart:
            taken = np.vstack((taken, row))
    return taken


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that neither tiny nor huge vectors lose their length.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def permutations(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each row, in order; equally near ones by number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :nearest]


def cell_pairs(x: np.ndarray, near: np.ndarray, pair: tuple[int, int], cut: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that link and whose first shared pair of pivots is ``pair``. With ``cut``, rows before it with rows after it."""
    left, right = (slice(0, len(x)),) * 2 if not cut else (slice(0, cut), slice(cut, len(x)))
    found = [(np.zeros(0, np.int64),) * 2]
    for a in range(left.start, left.stop, 512):
        i, j = np.nonzero(x[a:min(a + 512, left.stop)] @ x[right].T >= least)
        i, j = i + a, j + right.start
        if not cut:
            i, j = i[i < j], j[i < j]
        if len(i):
            # ``near`` is sorted, so the first two shared pivots are the first pair.
            shared = (near[i][:, :, None] == near[j][:, None, :]).any(axis=2)
            first = shared.argmax(axis=1)
            shared[np.arange(len(i)), first] = False
            own = (near[i, first] == pair[0]) & (near[i, shared.argmax(axis=1)] == pair[1])
            found.append((i[own], j[own]))
    i, j = map(np.concatenate, zip(*found, strict=True))
    return i, j


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each of ``n`` rows the smallest one it hangs together with."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        for side in (root[i], root[j], i, j):
            np.minimum.at(root, side, low)
        root = root[root]
    return root


def list_links(table: pa.Table, starts: np.ndarray, least: float) -> pa.Table:
    """(key, links, root): of each vector in a cell the copies it links with there, and a vector it hangs together with."""
    key, copies, chunk = (table[c].to_numpy() for c in ("key", "copies", "chunk"))
    p, q = table["p"].to_numpy(), table["q"].to_numpy()
    x, near = unit(matrix(table, "embedding")), np.sort(matrix(table, "near"), axis=1)
    out = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a < 2:
            continue
        cut = int(np.searchsorted(chunk[a:b], chunk[b - 1])) if chunk[a] != chunk[b - 1] else 0
        i, j = cell_pairs(x[a:b], near[a:b], (p[a], q[a]), cut, least)
        if len(i):
            links = np.zeros(b - a, np.int64)
            np.add.at(links, i, copies[a:b][j])
            np.add.at(links, j, copies[a:b][i])
            hit = np.flatnonzero(links)
            out.append((key[a:b][hit], links[hit], key[a:b][roots(b - a, i, j)[hit]]))
    columns = map(np.concatenate, zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("key", "links", "root"), map(pa.array, columns), strict=True)))


def near_vectors(vectors: DataFrame, least: float = LEAST, pivots: int = PIVOTS, nearest: int = NEAREST, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    valid = (F.size("embedding") > 0) & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0)
    plain = F.transform("embedding", lambda v: v + F.lit(0.0))  # no negative zeros
    keyed = rows.select("vec_id", F.when(F.coalesce(valid, F.lit(False)), plain).alias("embedding"))
    keyed = staged(spark, keyed.withColumn("key", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))), "vectors")
    distinct = staged(spark, keyed.filter("key is not null").groupBy("key", "embedding").agg(F.count("*").alias("copies")), "distinct")

    sample = distinct.orderBy(F.xxhash64("key"), "key").limit(8 * pivots).select("embedding").toPandas()["embedding"]
    by_length: dict[int, np.ndarray] = {}
    for length in sorted({len(e) for e in sample}):
        by_length[length] = choose_pivots(unit(np.stack([e for e in sample if len(e) == length])), pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            near: list[list[int]] = [[] for _ in sizes]
            for length in set(sizes.tolist()) & set(by_length):
                at = np.flatnonzero(sizes == length)
                vectors = column.take(pa.array(at)).flatten().to_numpy().reshape(len(at), length)
                for k, row in zip(at, permutations(unit(vectors), by_length[length], nearest).tolist(), strict=True):
                    near[k] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=["key", "embedding", "copies", "near"])

    described = distinct.mapInArrow(describe, "key bigint, embedding array<double>, copies bigint, near array<int>")
    # Lengths with too few pivots to share two of them get pivots beyond all others, so that these vectors meet in one list.
    spare = F.array(F.lit(pivots), F.lit(pivots + 1))
    described = described.withColumn("near", F.when(F.size("near") < nearest, F.concat("near", spare)).otherwise(F.col("near")))
    pairs = F.expr(
        "filter(flatten(transform(near, p -> transform(near, q -> struct(size(embedding) as length, p as p, q as q)))), x -> x.p < x.q)")
    listed = staged(spark, described.select("key", "embedding", "copies", "near", F.explode(pairs).alias("pair")).select(
        "key", "embedding", "copies", "near", "pair.*"), "lists")
    sizes = listed.groupBy("length", "p", "q").agg(F.count("*").alias("_n")).filter("_n > 1")
    cells = gridded(listed, sizes, ["length", "p", "q"], "key", chunk)
    found = staged(spark, per_cell(cells, listed.count(), ["length", "p", "q", "i", "j"], ["length"], partial(list_links, least=least),
                                   "key bigint, links bigint, root bigint"), "found")

    places = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    entries = (distinct.select("key", "copies").join(counts, "key", "left").join(places, "key", "left")
               .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "key").alias("component")))
    own = keyed.select("vec_id", "key").join(entries, "key", "left")
    names = own.filter("key is not null").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = own.join(names, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return named.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
