"""Interval joins: rows of two keyed streams whose times lie within a bound of each other.

In batch the time axis is cut into slices at least as wide as the interval and the slice is part of the join key.
Each pair meets in exactly one slice, a key's rows spread over the slices, and no task ever sees all
rows of a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str, before: int, after: int, copied: str = "right",
    span: int = 1, sliced: bool = False,
) -> DataFrame:
    """Inner join on ``key`` where right time is in [left time - before, left time + after] (milliseconds).

    Both bounds are inclusive. ``key`` is named alike on both sides; all other columns must differ. Rows of the ``copied`` side go to all
    slices they can meet rows in, so name the smaller one. Slices are ``span`` intervals wide: the wider, the fewer copies (1 + 1 / span of
    a row on average) and the more rows of a key in a slice. ``sliced`` keeps the slice that a pair met in as ``_slice``: pairs lie together by
    ``key`` and ``_slice``.
    """
    width = F.lit(max(before + after, 1) * span)
    slice_of = lambda at: F.floor(at / width)
    # Slices of the times that a copied row can meet: at most two.
    if copied == "right":
        a = left.withColumn("_slice", slice_of(F.col(left_ms)))
        met = F.sequence(slice_of(F.col(right_ms) - after), slice_of(F.col(right_ms) + before))
        b = right.filter(F.col(right_ms).isNotNull()).withColumn("_slice", F.explode(met))
    else:
        met = F.sequence(slice_of(F.col(left_ms) - before), slice_of(F.col(left_ms) + after))
        a = left.filter(F.col(left_ms).isNotNull()).withColumn("_slice", F.explode(met))
        b = right.withColumn("_slice", slice_of(F.col(right_ms)))
    in_bounds = F.col(right_ms).between(F.col(left_ms) - before, F.col(left_ms) + after)
    pairs = a.join(b, [key, "_slice"]).filter(in_bounds)
    return pairs if sliced else pairs.drop("_slice")


#: Slices of an order's join with its lines, in intervals: an order has few lines.
ORDER_SPAN = 4


def line_slice(ms: Column, bound: int) -> Column:
    """The slice of an order's join with its lines that a line's time is in."""
    return F.floor(ms / F.lit(max(2 * bound, 1) * ORDER_SPAN))


def order_with_details(
    orders: DataFrame, details: DataFrame, bound: int = 2 * MINUTE, compat: bool = False, sliced: bool = False
) -> DataFrame:
    """Orders joined to their details within ``bound``.

    ``compat`` reproduces the merge as written: the coupon amount holds the quantity, and the activity
    and total amounts lose their fraction.
    """
    left = orders.select(
        F.col("id").alias("order_id"), "uid", "consignee", "create_time", "original_total_amount", "total_amount",
        "province_id", "pay_time_slot", "ts_ms")
    right = details.select(
        "order_id", F.col("id").alias("detail_id"), "sku_num", "sku_id", "sku_name", "order_price",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", F.col("ts_ms").alias("detail_ts_ms"))
    out = interval_join(left, right, "order_id", "ts_ms", "detail_ts_ms", bound, bound, "left", ORDER_SPAN, sliced).drop("detail_ts_ms")
    if compat:
        for name in ("split_activity_amount", "split_total_amount"):
            out = out.withColumn(name, F.col(name).try_cast("double").cast("bigint").cast("string"))
        out = out.withColumn("split_coupon_amount", F.col("sku_num").cast("string"))
    return out


def user_with_supplement(
    users: DataFrame, supplements: DataFrame, bound: int = 5 * MINUTE, default_gender: str | None = None
) -> DataFrame:
    """Users joined to their body measures within ``bound``."""
    right = supplements.select(
        "uid", "height", "unit_height", "weight", "unit_weight", F.col("ts_ms").alias("sup_ts_ms"))
    out = interval_join(users, right, "uid", "ts_ms", "sup_ts_ms", bound, bound).drop("sup_ts_ms")
    if default_gender is not None:
        out = out.withColumn("gender", F.coalesce("gender", F.lit(default_gender)))
    return out


def trimmed_orders(envelopes: DataFrame) -> DataFrame:
    """Orders cut to four columns."""
    after = F.col("after")
    return envelopes.filter(F.col("source")["table"] == "order_info").select(
        after["id"].alias("order_id"), after["user_id"].alias("uid"), after["total_amount"].alias("total_amount"), "ts_ms")


def trimmed_details(envelopes: DataFrame) -> DataFrame:
    """Details cut to three columns and their time."""
    after = F.col("after")
    return envelopes.filter(F.col("source")["table"] == "order_detail").select(
        after["order_id"].alias("order_id"), after["sku_id"].alias("sku_id"), after["sku_name"].alias("sku_name"),
        F.col("ts_ms").alias("detail_ts_ms"))


def trimmed_order_join(orders: DataFrame, details: DataFrame, bound: int = 5 * MINUTE) -> DataFrame:
    return interval_join(orders, details, "order_id", "ts_ms", "detail_ts_ms", bound, bound, "left", ORDER_SPAN).drop("detail_ts_ms")
