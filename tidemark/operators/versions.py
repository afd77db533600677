"""Latest-per-key, first-per-key and the other version operators, all as map-side-combined aggregates.

None of them sorts a whole key group in one task: a key that owns a third of the rows is reduced to
one row per input task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _ordered_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Struct that compares by ``order`` first, then by every other column, so ties are settled. Maps, which have no order,
    stand in it as their sorted entries."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    maps = _maps(df)
    return F.struct(*[F.array_sort(F.map_entries(f"`{c}`")).alias(c) if c in maps else F.col(f"`{c}`") for c in [*order, *rest]])


def _maps(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, MapType)}


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    out, maps = df.groupBy(*keys).agg(agg(_ordered_row(df, keys, order)).alias("_row")), _maps(df)
    held = lambda c: F.map_from_entries(f"_row.`{c}`") if c in maps else F.col(f"_row.`{c}`")
    return out.select(*[F.col(c) if c in keys else held(c).alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The highest version of each key."""
    return _pick(df, keys, order, F.max)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The lowest version of each key."""
    return _pick(df, keys, order, F.min)


def superseded(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row that is not the latest of its key.

    A multiset difference: it hashes on whole rows, so a key with very many versions spreads out.
    """
    return df.exceptAll(latest_by_key(df, keys, order))


def upsert(df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """Resolve a change log into its table: last row per key, keys whose last row is a delete vanish."""
    if deleted is None:
        return latest_by_key(df, keys, order)
    marked = df.withColumn("_gone", F.coalesce(deleted, F.lit(False)))
    return latest_by_key(marked, keys, order).filter(~F.col("_gone")).drop("_gone")
