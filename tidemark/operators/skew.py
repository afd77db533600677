"""Joins that hold when one key owns a large share of the rows.

``lookup_join`` is the one entry point. It gives no hint: Spark broadcasts a lookup side that it finds within its
own threshold, by plan or by measured size, and adaptive execution splits the partitions a hot key blows up beyond.
Where that is switched off and the planned size is over the threshold, ``salted_join`` spreads hot keys itself.

``salted_join`` finds the hot keys by a bounded frequent-items sketch, so the hot-key table has at most
``MAX_HOT_KEYS`` rows whatever the data size. The sketch reads the big side once more, which is why it is
not the first choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT_KEYS = 100
SKETCH_ITEMS = 10_000
HOT_SHARE = 1_000  # a key is hot when it holds more than 1/HOT_SHARE of the rows
SALTS = 64


def planned_bytes(df: DataFrame) -> int:
    """Spark's size estimate for ``df``; reads statistics only, runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _size_conf(df: DataFrame, key: str) -> int:
    text = df.sparkSession.conf.get(key).strip().lower()
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "b": 1}
    for suffix, factor in units.items():
        if text.endswith(suffix):
            return int(text[: -len(suffix)]) * factor
    return int(text)


def fits_broadcast(df: DataFrame, limit: int | None = None, widen: float = 1.0) -> bool:
    """True when the planned size of ``df`` (times ``widen``) is within the broadcast threshold."""
    if limit is None:
        limit = _size_conf(df, "spark.sql.autoBroadcastJoinThreshold")
    return planned_bytes(df) * max(widen, 1.0) <= limit


def hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Hashes of the join keys holding more than 1/HOT_SHARE of the rows: at most MAX_HOT_KEYS rows."""
    found = (
        df.select(F.xxhash64(*on).alias("_h"))
        .agg(
            F.expr(f"approx_top_k(_h, {MAX_HOT_KEYS}, {SKETCH_ITEMS})").alias("_top"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select("_n", F.explode("_top").alias("_k"))
    )
    return found.filter(F.col("_k.count") * HOT_SHARE > F.col("_n")).select(F.col("_k.item").alias("_hot"))


def _row_salt(df: DataFrame, salts: int) -> Column:
    # Row hash plus partition id: both are fixed for a re-run task, so a retry salts the same way,
    # and exact copies of one row still spread.
    plain = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in plain]), F.lit(salts))


def _holds_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _holds_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_holds_map(f.dataType) for f in dt.fields)
    return isinstance(dt, T.VariantType)


def salted_join(
    big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join (inner or left) that spreads the hot keys of ``big`` over ``salts`` tasks each."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    on = list(on)
    hot = F.broadcast(hot_keys(big, on))
    salted_big = (
        big.withColumn("_h", F.xxhash64(*on))
        .join(hot, F.col("_h") == F.col("_hot"), "left")
        .withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(_row_salt(big, salts)).cast("int"))
        .drop("_h", "_hot")
    )
    copies = F.when(F.col("_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_other = (
        other.withColumn("_h", F.xxhash64(*on))
        .join(hot, F.col("_h") == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_h", "_hot")
    )
    return salted_big.join(salted_other, [*on, "_salt"], how).drop("_salt")


def _splits_skew(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        conf.get(key, "true").lower() == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))


def lookup_join(
    big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", limit: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Join ``other`` to ``big`` by whichever way Spark finds best; salted where Spark could not split a hot key.

    ``sized_by`` is a frame with at least as many rows as ``other``, to take the size from where ``other`` is
    built by joins and its own estimate would be a product. ``limit`` replaces the session's threshold.
    """
    on = list(on)
    if _splits_skew(big):
        return big.join(other, on, how)
    widen = 1.0 if sized_by is None else len(other.columns) / max(len(sized_by.columns), 1)
    fits = fits_broadcast(other if sized_by is None else sized_by, limit, widen)
    return big.join(other, on, how) if fits else salted_join(big, other, on, how)
