"""Batch forms of the stateful operators over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import keyed
from tidemark.operators import logs as L
from tidemark.plans import standins as T
from tidemark.plans.catalog.join_queries import ORDER_DETAIL_JOIN, order_detail_join
from tidemark.plans.catalog.window_queries import CART_ADDS, DAY, LOGIN_DAYS, VERSIONS, line_versions
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import latest, using


@query("g2_first_visit", using("log") + f"""
SELECT mid, vc, ts, CAST(row_number() OVER (PARTITION BY mid, ts // {DAY} ORDER BY ts, vc) = 1 AS BIGINT) AS uv FROM log""")
def g2_first_visit(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with a 1 on its device's first of the day."""
    visits = T.app_log(spark, sf).select(F.col("common.mid").alias("mid"), F.col("common.vc").alias("vc"), "ts")
    return keyed.flag_first_of_day(visits, ["mid"], "uv", "ts", "UTC")


@query("g3_first_home_detail", using("log") + f"""
SELECT mid, page_id, min(ts) AS ts FROM log WHERE page_id IN ('home', 'good_detail') GROUP BY mid, page_id, ts // {DAY}""")
def g3_first_home_detail(spark: SparkSession, sf: str) -> DataFrame:
    visits = L.on_pages(T.app_log(spark, sf), "home", "good_detail").select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    return keyed.first_of_day(visits, ["mid", "page_id"], "ts", "UTC")


@query("g4_login_days", using("log") + LOGIN_DAYS)
def g4_login_days(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.login_days(L.logins(T.app_log(spark, sf)), "UTC")


@query("g5_retract_versions", using("order_detail", "order_info", v=VERSIONS) + """
SELECT id, order_id, province_id, CAST(amount AS DOUBLE) AS amount, ts_ms FROM v UNION ALL
SELECT id, order_id, province_id, CAST(-amount AS DOUBLE), ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, order_id DESC, amount DESC) AS rn FROM v) WHERE rn > 1""")
def g5_retract_versions(spark: SparkSession, sf: str) -> DataFrame:
    out = keyed.retract_versions(line_versions(spark, sf), "id", "split_total_amount")
    return out.select("id", "order_id", "province_id", F.col("split_total_amount").cast("double").alias("amount"), "ts_ms")


_VERSION_COLUMNS = "order_id,sku_id,sku_name,create_time,source_id,source_type,sku_num,order_price,split_total_amount,split_activity_amount,split_coupon_amount"


@query("g6_latest_version", using("order_detail") + f"""
SELECT * FROM {latest('order_detail', 'id', 'ts_ms', _VERSION_COLUMNS)}""")
def g6_latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.latest_orders(T.order_detail(spark, sf))


@query("g7_first_cart_add", using("cart_info", adds=CART_ADDS) + f"""
SELECT user_id, min(ts_ms) AS ts_ms FROM adds GROUP BY user_id, ts_ms // {DAY}""")
def g7_first_cart_add(spark: SparkSession, sf: str) -> DataFrame:
    cart = C.cart_adds(T.change_log(spark, sf)).select("user_id", "ts_ms")
    return keyed.first_of_day(cart, ["user_id"], "ts_ms", "UTC")


@query("g9_strictly_newer", using("tag_order_info", "tag_order_detail", j=ORDER_DETAIL_JOIN) + """
SELECT detail_id, create_time, total_amount FROM (
  SELECT *, max(create_time) OVER (PARTITION BY detail_id ORDER BY ts_ms, order_id, total_amount, split_total_amount, sku_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM j) WHERE m IS NULL OR create_time > m""")
def g9_strictly_newer(spark: SparkSession, sf: str) -> DataFrame:
    out = keyed.strictly_newer(
        order_detail_join(spark, sf), "detail_id", "create_time", "ts_ms",
        ties=["order_id", "total_amount", "split_total_amount", "sku_id"])
    return out.select("detail_id", "create_time", "total_amount")


@query("g10_strictly_newer_user", using("log") + f"""
SELECT uid, ts, during_time FROM (
  SELECT *, max(during_time) OVER (PARTITION BY uid ORDER BY ts, during_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM log) WHERE m IS NULL OR during_time > m""")
def g10_strictly_newer_user(spark: SparkSession, sf: str) -> DataFrame:
    """Record highs per user: rows whose value exceeds every earlier one, in order of arrival."""
    rows = T.app_log(spark, sf).select(F.col("common.uid").alias("uid"), "ts", "page.during_time")
    return keyed.strictly_newer(rows, "uid", "during_time", "ts")
