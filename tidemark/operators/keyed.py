"""Batch forms of the keyed, stateful operators.

State machines over a key's history become aggregates (first, last, distinct days) wherever the answer
allows. The two that need a running value per row cut each key's history into time slices: running
values inside a slice come from a window over (key, slice), and the values carried into a slice come
from slice totals, so a key with a third of all rows is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.intervals import HOUR, interval_join
from tidemark.operators.versions import first_by_key, latest_by_key, superseded


def first_of_day(
    df: DataFrame, keys: Sequence[str], ms: str = "ts", tz: str = S.BUSINESS_TZ, order: Sequence[str] | None = None
) -> DataFrame:
    """The first row of each key on each day."""
    dated = df.withColumn("_day", S.ms_to_day(F.col(ms), tz))
    return first_by_key(dated, [*keys, "_day"], order or [ms]).drop("_day")


def flag_first_of_day(
    df: DataFrame, keys: Sequence[str], name: str, ms: str = "ts", tz: str = S.BUSINESS_TZ,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """All rows, with ``name`` = 1 on the first of each key and day and 0 on the rest."""
    firsts = first_of_day(df, keys, ms, tz, order)
    rest = df.exceptAll(firsts)
    return firsts.withColumn(name, F.lit(1).cast("bigint")).unionByName(rest.withColumn(name, F.lit(0).cast("bigint")))


def login_days(logins: DataFrame, tz: str = S.BUSINESS_TZ, away_days: int = 8) -> DataFrame:
    """First login per user and day (uid, ts) with ``uu`` = 1 and ``back`` = 1 after ``away_days`` away.

    The window runs over distinct days, so a user has at most one row per calendar day in it.
    """
    days = (
        logins.select(F.col("common.uid").alias("uid"), "ts", S.ms_to_day(F.col("ts"), tz).alias("day"))
        .groupBy("uid", "day").agg(F.min("ts").alias("ts"))
    )
    last = F.lag("day").over(W.partitionBy("uid").orderBy("day"))
    back = F.coalesce((F.date_diff("day", last) >= away_days).cast("bigint"), F.lit(0).cast("bigint"))
    return days.select("uid", "ts", F.lit(1).cast("bigint").alias("uu"), back.alias("back"))


def retract_versions(df: DataFrame, key: str, amount: str, order: Sequence[str] = ("ts_ms",)) -> DataFrame:
    """Every version plus, for each superseded one, the same row with its amount negated."""
    old = superseded(df, [key], list(order))
    return df.unionByName(old.withColumn(amount, S.negated(F.col(amount))))


def drop_repeats(df: DataFrame) -> DataFrame:
    """Whole-record deduplication."""
    return df.dropDuplicates()


def _sliced(df: DataFrame, order_ms: str, width: int) -> DataFrame:
    return df.withColumn("_slice", F.floor(F.col(order_ms) / F.lit(width)))


#: Keys whose rows disagree are known by buckets of their hashes. At most so many numbers, a power of two, are broadcast.
DISAGREEING = 1 << 20


def by_agreement(df: DataFrame, key: str, *shared: Column) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows of keys whose rows all agree in ``shared``, and all others: those of the other keys, and the few whose hashes are in a bucket
    with one. Also a function for what the others are joined with: all of it, or nothing if all keys agree.

    Only hashes are shuffled. Where all keys agree, adaptive execution leaves out whatever is to be done for the others.
    """
    hashed = df.select(F.xxhash64(key).alias("_key"), F.xxhash64(*shared).alias("_at"))
    spread = hashed.groupBy("_key").agg(F.min("_at").alias("_low"), F.max("_at").alias("_high")).filter("_low <> _high")
    bucket = lambda at: at.bitwiseAND(F.lit(DISAGREEING - 1))
    buckets = spread.select(bucket(F.col("_key")).alias("_bucket")).distinct()
    marked = df.withColumn("_bucket", bucket(F.xxhash64(key)))
    near, apart = (marked.join(F.broadcast(buckets), "_bucket", how).drop("_bucket") for how in ("left_anti", "left_semi"))
    return near, apart, lambda other: other.join(F.broadcast(buckets), F.lit(True), "left_semi")


def strictly_newer(
    df: DataFrame, key: str, value: str, arrival_ms: str, slice_ms: int = HOUR, ties: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Rows whose ``value`` exceeds every earlier one of their key, in order of arrival. Rows without a key or a time are left out.

    ``within`` names columns that all rows of a key agree in and by which the rows lie together already, as a join leaves them: nothing is
    shuffled then, and nothing cut into slices.
    """
    rest = list(ties) if ties is not None else [c for c in df.columns if c not in (key, arrival_ms)]
    if within:
        before = W.partitionBy(*within, key).orderBy(arrival_ms, *rest).rowsBetween(W.unboundedPreceding, -1)
        known = df.filter(F.col(key).isNotNull() & F.col(arrival_ms).isNotNull()).withColumn("_earlier", F.max(value).over(before))
        return known.filter(F.col("_earlier").isNull() | (F.col(value) > F.col("_earlier"))).select(*df.columns)
    cut = _sliced(df, arrival_ms, slice_ms).filter(F.col(key).isNotNull() & F.col("_slice").isNotNull())
    totals = cut.groupBy(key, "_slice").agg(F.max(value).alias("_m"))
    before = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # Nothing is carried into a key's first slice, so most keys send no row to the join.
    carried = totals.select(key, "_slice", F.max("_m").over(before).alias("_carried")).filter(F.col("_carried").isNotNull())
    inside = W.partitionBy(key, "_slice").orderBy(arrival_ms, *rest).rowsBetween(W.unboundedPreceding, -1)
    joined = cut.withColumn("_inside", F.max(value).over(inside)).join(carried, [key, "_slice"], "left")
    earlier = F.greatest("_inside", "_carried")  # ignores nulls
    return joined.filter(earlier.isNull() | (F.col(value) > earlier)).select(*df.columns)


RUNNING_FIELDS = ["os", "ch", "md", "ba", "search_item"]


def _slice_totals(cut: DataFrame, key: str, ms: str, fields: Sequence[str]) -> DataFrame:
    return cut.groupBy(key, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.max(ms).alias("_last"), *[F.collect_set(f).alias(f"_s_{f}") for f in fields])


def _with_new_values(totals: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Add per (key, slice) the values first seen in that slice, null where there are none.

    Running sets are then built from new values only, so their cost grows with the distinct values of a
    key and not with its slices.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"_s_{f}").alias("vals")) for f in fields])
    firsts = (
        totals.select(key, "_slice", F.explode(pairs).alias("_p"))
        .select(key, "_slice", F.col("_p.f").alias("_f"), F.explode("_p.vals").alias("_v"))
        .groupBy(key, "_f", "_v").agg(F.min("_slice").alias("_slice"))
    )
    fresh = firsts.groupBy(key, "_slice").agg(
        *[F.collect_list(F.when(F.col("_f") == f, F.col("_v"))).alias(f"_new_{f}") for f in fields])
    fresh = fresh.select(key, "_slice", *[
        F.when(F.size(f"_new_{f}") > 0, F.col(f"_new_{f}")).alias(f"_new_{f}") for f in fields])
    return totals.join(fresh, [key, "_slice"], "left")


def _running_set(field: str, frame) -> Column:
    return F.flatten(F.collect_list(f"_new_{field}").over(frame))


def running_profile(
    df: DataFrame, fields: Sequence[str] = RUNNING_FIELDS, slice_ms: int = HOUR, key: str = "uid", ms: str = "ts"
) -> DataFrame:
    """Per record its user's page views and distinct device values and search words so far.

    One row per input: (uid, ts_ms, pv, one comma-joined sorted text per field). The event time goes
    along, so later time joins have something to join on.
    """
    rest = [c for c in df.columns if c not in (key, ms)]
    cut = _sliced(df, ms, slice_ms)
    totals = _with_new_values(_slice_totals(cut, key, ms, fields), key, fields)
    before = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[_running_set(f, before).alias(f"_s_{f}") for f in fields])
    inside = W.partitionBy(key, "_slice").orderBy(ms, *rest).rowsBetween(W.unboundedPreceding, 0)
    running = cut.select(
        key, "_slice", F.col(ms).alias("ts_ms"), F.count(F.lit(1)).over(inside).alias("_pv"),
        *[F.collect_set(f).over(inside).alias(f"_i_{f}") for f in fields])
    texts = [S.joined(F.array_sort(F.array_union(f"_i_{f}", f"_s_{f}"))).alias(f) for f in fields]
    return running.join(carried, [key, "_slice"]).select(
        key, "ts_ms", (F.col("_pv") + F.col("_n")).cast("bigint").alias("pv"), *texts)


def profile_by_window(
    df: DataFrame, width: int, fields: Sequence[str] = RUNNING_FIELDS, key: str = "uid", ms: str = "ts"
) -> DataFrame:
    """The last ``running_profile`` row of each user and time window, without making the others.

    Window totals are aggregated first; the running step then sees one row per user and window.
    """
    totals = _with_new_values(_slice_totals(_sliced(df, ms, width), key, ms, fields), key, fields)
    upto = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    return totals.select(
        key, F.col("_last").alias("ts_ms"), F.sum("_n").over(upto).cast("bigint").alias("pv"),
        *[S.joined(F.array_sort(_running_set(f, upto))).alias(f) for f in fields])


def latest_by_window(df: DataFrame, keys: Sequence[str], ms: str, width: int) -> DataFrame:
    """The last row of each key in each time window."""
    cut = _sliced(df, ms, width)
    return latest_by_key(cut, [*keys, "_slice"], [ms]).drop("_slice")


def latest_orders(details: DataFrame, key: str = "id") -> DataFrame:
    """The newest version of each order line; equal times are settled by the remaining columns."""
    return latest_by_key(details, [key], ["ts_ms"])


def join_within_retention(left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str, retention: int):
    """Join two keyed change streams whose rows are kept for ``retention`` milliseconds."""
    return interval_join(left, right, key, left_ms, right_ms, retention, retention)

