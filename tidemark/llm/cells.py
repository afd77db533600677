"""Groups of bounded size handled many to a task call, so that small groups cost little."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows expected in a bucket.
BUCKET = 20_000


def gridded(rows: DataFrame, sizes: DataFrame, keys: Sequence[str], member: str, most: int) -> DataFrame:
    """``rows`` in cells: a group of over ``most`` rows is cut into chunks, and each pair of chunks is a cell.

    ``sizes``: the groups wanted (``keys``) and their number of rows ``_n``. Adds ``chunk`` and the cell's chunks ``i`` <= ``j``. A row's
    chunk is a hash of ``member`` and the keys.
    """
    many = sizes.select(*keys, (F.floor((F.col("_n") - 1) / most) + 1).cast("int").alias("_chunks"))
    return (rows.join(many, list(keys)).withColumn("chunk", F.pmod(F.xxhash64(member, *keys), F.col("_chunks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
            .withColumn("i", F.least("chunk", "_other")).withColumn("j", F.greatest("chunk", "_other")).drop("_other", "_chunks"))


def per_cell(rows: DataFrame, count: int, keys: Sequence[str], apart: Sequence[str], each: Callable[[pa.Table, np.ndarray], pa.Table], schema: str,
             bucket: int = BUCKET) -> DataFrame:
    """``each(table, starts)`` for buckets of whole groups: rows sorted by ``keys`` and ``chunk``, and where each group starts (and the
    end). ``count`` is the number of rows, which sets the number of buckets; ``apart`` are keys that never share a bucket."""
    buckets = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(count // bucket + 1)))
    names = [*keys, "chunk"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in names]).combine_chunks()
        n = table.num_rows
        new = np.zeros(n, bool)
        new[0] = True
        for k in keys:
            values = table[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return each(table, np.concatenate((np.flatnonzero(new), [n])))

    return buckets.groupBy("_bucket", *apart).applyInArrow(run, schema)


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A column of arrays of one length as rows of a matrix."""
    column = table[name].combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)
