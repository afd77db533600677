"""Tumbling-window measures. Windows align to the epoch; bounds come out as text in the business zone.

Every measure is a plain grouped aggregate, so global windows and hot keys are reduced on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import keyed, logs
from tidemark.operators.skew import lookup_join
from tidemark.operators.versions import latest_by_key

MONEY = "decimal(18,2)"


def _zoned(ts: Column, tz: str) -> Column:
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def bound_columns(tz: str = S.BUSINESS_TZ, window: str = "window") -> list[Column]:
    """stt, edt and cur_date of a window column."""
    start, end = _zoned(F.col(f"{window}.start"), tz), _zoned(F.col(f"{window}.end"), tz)
    return [
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("edt"),
        F.date_format(start, "yyyy-MM-dd").alias("cur_date"),
    ]


def tumble(
    df: DataFrame, ts: Column, size: str, keys: Sequence[str], aggregates: Sequence[Column], tz: str = S.BUSINESS_TZ
) -> DataFrame:
    """Aggregate by tumbling window and keys; works on batch and streaming input."""
    out = df.groupBy(F.window(ts, size), *keys).agg(*aggregates)
    names = [c for c in out.columns if c != "window"]
    return out.select(*bound_columns(tz), *names)


def _at(ms: str) -> Column:
    return F.timestamp_millis(F.col(ms))


def _total(column: str, name: str | None = None) -> Column:
    return F.sum(column).cast("bigint").alias(name or column)


def keyword_counts(words: DataFrame, size: str = "5 seconds", tz: str = S.BUSINESS_TZ, ms: str = "ts") -> DataFrame:
    return tumble(words, _at(ms), size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], tz)


TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]


def traffic(log: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Visitors, sessions, page views and duration by version, channel, area and newness.

    The visitor of a day is counted where the device's first record of that day falls. Those first
    records join the others as rows with a 1, so there is no join back.
    """
    measures = logs.page_measures(log)
    firsts = keyed.first_of_day(measures.select("mid", "ts", *TRAFFIC_KEYS), ["mid"], "ts", tz)
    zero = F.lit(0).cast("bigint")
    rows = measures.drop("mid").withColumn("uv", zero).unionByName(
        firsts.drop("mid").withColumns({"uv": F.lit(1).cast("bigint"), "sv": zero, "pv": zero, "dur": zero}))
    return tumble(rows, _at("ts"), size, TRAFFIC_KEYS, [
        _total("uv", "uv_ct"), _total("sv", "sv_ct"), _total("pv", "pv_ct"), _total("dur", "dur_sum")], tz)


def home_detail_visits(log: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """First home visits and first product-page visits of the day."""
    visits = logs.on_pages(log, "home", "good_detail").select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    firsts = keyed.first_of_day(visits, ["mid", "page_id"], "ts", tz)
    return tumble(firsts, _at("ts"), size, [], [
        F.count_if(F.col("page_id") == "home").alias("home_uv_ct"),
        F.count_if(F.col("page_id") == "good_detail").alias("good_detail_uv_ct")], tz)


def login_users(log: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Users logging in for the first time that day, and those back after a pause."""
    days = keyed.login_days(logs.logins(log), tz)
    return tumble(days, _at("ts"), size, [], [_total("back", "back_ct"), _total("uu", "uu_ct")], tz)


def cart_users(cart: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Users adding to their cart for the first time that day. ``size='1 millisecond'`` is the window as written."""
    firsts = keyed.first_of_day(cart.select("user_id", "ts_ms"), ["user_id"], "ts_ms", tz)
    return tumble(firsts, _at("ts_ms"), size, [], [F.count(F.lit(1)).alias("cart_add_uu_ct")], tz)


def province_orders(details: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Orders and amount per province from a retracting stream (``order_id``, ``province_id``, amount, ``ts_ms``)."""
    return tumble(details, _at("ts_ms"), size, ["province_id"], [
        F.count_distinct("order_id").alias("order_count"),
        F.sum(F.col("split_total_amount").cast(MONEY)).alias("order_amount")], tz)


def settled_versions(details: DataFrame, key: str = "id", amount: str = "split_total_amount") -> DataFrame:
    """What ``province_orders`` needs of the retracting stream, in less work.

    A superseded version and its negation cancel, so all versions count as orders with amount 0 and only
    the latest carries its amount.
    """
    columns = [c for c in (key, "order_id", "province_id", amount, "ts_ms") if c in details.columns]
    rows = details.select(*columns).withColumn(amount, F.col(amount).cast(MONEY))
    latest = latest_by_key(rows, [key], ["ts_ms"])
    return rows.withColumn(amount, F.lit(0).cast(MONEY)).unionByName(latest)


def province_orders_by_order(
    details: DataFrame, orders: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ
) -> DataFrame:
    """``province_orders`` where the province is still on the order (``order_id``, ``province_id``; one row per order).

    Amounts are summed per window and order before the join, which so meets one row per order and window,
    and counting orders needs no distinct.
    """
    totals = details.groupBy(F.window(_at("ts_ms"), size), "order_id").agg(
        F.sum(F.col("split_total_amount").cast(MONEY)).alias("_amount"))
    out = lookup_join(totals, orders, ["order_id"], "left").groupBy("window", "province_id").agg(
        F.count("order_id").alias("order_count"), F.sum("_amount").alias("order_amount"))
    return out.select(*bound_columns(tz), "province_id", "order_count", "order_amount")


SKU_MEASURES = {
    "original_amount": "split_original_amount",
    "activity_reduce_amount": "split_activity_amount",
    "coupon_reduce_amount": "split_coupon_amount",
    "order_amount": "split_total_amount",
}


def sku_orders(details: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Amounts per SKU and event-time window of the latest line versions."""
    return tumble(details, _at("ts_ms"), size, ["sku_id"], [
        F.sum(F.col(source).try_cast(MONEY)).alias(name) for name, source in SKU_MEASURES.items()], tz)


def snake_json(df: DataFrame, drop: Sequence[str] = ("ts",)) -> DataFrame:
    """Rows as JSON text with snake-case names; fields in ``drop`` stay out."""
    kept = [F.col(c).alias(S.camel_to_snake(c)) for c in df.columns if c not in drop]
    return df.select(F.to_json(F.struct(*kept)).alias("value"))
