"""Windowed measures over the stand-ins, with hour or day windows since the events are sparse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import keyed, lookups, windows
from tidemark.operators import logs as L
from tidemark.plans import standins as T
from tidemark.plans.catalog.fact_queries import FACT, FACT_NEEDS, fact
from tidemark.plans.catalog.log_queries import DEVICE_SQL
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import bounds, latest, using

HOUR = 3_600_000
DAY = 24 * HOUR


@query("f1_keyword_count", using("log") + f"""
SELECT {bounds('ts', HOUR)}, keyword, count(*) AS keyword_count FROM (
  SELECT ts, unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM log
  WHERE last_page_id = 'search' AND item_type = 'keyword') GROUP BY ALL""")
def f1_keyword_count(spark: SparkSession, sf: str) -> DataFrame:
    return windows.keyword_counts(L.words(L.searches(T.app_log(spark, sf)), "fullword", "ts"), "1 hour", "UTC")


TRAFFIC_SQL = f"""
SELECT {bounds('ts', HOUR)}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct, count(*) AS pv_ct,
  CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM (SELECT *, CAST(last_page_id IS NULL AS INT) AS sv, CAST(row_number() OVER (
    PARTITION BY mid, ts // {DAY} ORDER BY ts, vc, ch, ar, is_new) = 1 AS INT) AS uv FROM log)
GROUP BY ALL"""


@query("f2_traffic", using("log") + TRAFFIC_SQL)
def f2_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return windows.traffic(T.app_log(spark, sf), "1 hour", "UTC")


HOME_DETAIL_SQL = f"""
SELECT {bounds('ts', HOUR)}, count(CASE WHEN page_id = 'home' THEN 1 END) AS home_uv_ct,
  count(CASE WHEN page_id = 'good_detail' THEN 1 END) AS good_detail_uv_ct
FROM (SELECT mid, page_id, min(ts) AS ts FROM log WHERE page_id IN ('home', 'good_detail')
      GROUP BY mid, page_id, ts // {DAY}) GROUP BY ALL"""


@query("f3_home_detail", using("log") + HOME_DETAIL_SQL)
def f3_home_detail(spark: SparkSession, sf: str) -> DataFrame:
    return windows.home_detail_visits(T.app_log(spark, sf), "1 hour", "UTC")


LOGIN_DAYS = f"""
  SELECT uid, ts, CAST(1 AS BIGINT) AS uu, CAST(coalesce(d - lag(d) OVER (PARTITION BY uid ORDER BY d) >= 8, false) AS BIGINT) AS back
  FROM (SELECT uid, ts // {DAY} AS d, min(ts) AS ts FROM log WHERE last_page_id = 'login' OR last_page_id IS NULL
        GROUP BY ALL)"""
LOGIN_SQL = f"""
SELECT {bounds('ts', HOUR)}, CAST(sum(back) AS BIGINT) AS back_ct, CAST(sum(uu) AS BIGINT) AS uu_ct FROM days_ GROUP BY ALL"""


@query("f4_login_users", using("log", days_=LOGIN_DAYS) + LOGIN_SQL)
def f4_login_users(spark: SparkSession, sf: str) -> DataFrame:
    return windows.login_users(T.app_log(spark, sf), "1 hour", "UTC")


CART_ADDS = "SELECT user_id, ts_ms FROM cart_info WHERE op <> 'u' OR sku_num > old_num"
CART_SQL = f"""
SELECT {bounds('ts_ms', HOUR)}, count(*) AS cart_add_uu_ct FROM (
  SELECT user_id, min(ts_ms) AS ts_ms FROM adds GROUP BY user_id, ts_ms // {DAY}) GROUP BY ALL"""


@query("f5_cart_users", using("cart_info", adds=CART_ADDS) + CART_SQL)
def f5_cart_users(spark: SparkSession, sf: str) -> DataFrame:
    return windows.cart_users(C.cart_adds(T.change_log(spark, sf)), "1 hour", "UTC")


@query("f5_cart_users_as_written", using("cart_info", adds="SELECT user_id, ts_ms FROM cart_info WHERE op = 'r'") + f"""
SELECT {bounds('ts_ms', 1)}, count(*) AS cart_add_uu_ct, ts_ms AS ms FROM (
  SELECT user_id, min(ts_ms) AS ts_ms FROM adds GROUP BY user_id, ts_ms // {DAY}) GROUP BY ALL""")
def f5_cart_users_as_written(spark: SparkSession, sf: str) -> DataFrame:
    """The window as written is one millisecond of real time."""
    firsts = keyed.first_of_day(
        C.cart_adds(T.change_log(spark, sf), "as_written").select("user_id", "ts_ms"), ["user_id"], "ts_ms", "UTC")
    return windows.tumble(
        firsts.withColumn("ms", F.col("ts_ms")), F.timestamp_millis("ts_ms"), "1 millisecond", ["ms"],
        [F.count(F.lit(1)).alias("cart_add_uu_ct")], "UTC")


VERSIONS = """
  SELECT d.id, d.order_id, province_id, CAST(split_total_amount AS DECIMAL(18,2)) AS amount, d.ts_ms
  FROM order_detail d JOIN order_info o ON d.order_id = o.id"""


@T.once
def line_versions(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of the order lines with the province of their order."""
    log = T.change_log(spark, sf, "order_detail", "order_info")
    orders = C.orders(log).select(F.col("id").alias("order_id"), "province_id")
    details = C.order_details(log).select("id", "order_id", "split_total_amount", "ts_ms")
    return lookups.enrich(details, orders, "order_id", ["province_id"]).withColumn(
        "split_total_amount", F.col("split_total_amount").cast(windows.MONEY))


@query("f6_province_orders", using("order_detail", "order_info", v=VERSIONS) + f"""
SELECT {bounds('ts_ms', DAY)}, province_id, count(DISTINCT order_id) AS order_count,
  CAST(sum(CASE WHEN rn = 1 THEN amount ELSE 0 END) AS DOUBLE) AS order_amount
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, order_id DESC, province_id DESC, amount DESC) AS rn FROM v)
GROUP BY ALL""")
def f6_province_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Over the retracting stream of line versions."""
    retracting = keyed.retract_versions(line_versions(spark, sf), "id", "split_total_amount")
    out = windows.province_orders(retracting, "1 day", "UTC")
    return out.withColumn("order_amount", F.col("order_amount").cast("double"))


SKU_WINDOW = f"""
SELECT {bounds('ts_ms', DAY)}, sku_id, CAST(sum(CAST(split_original_amount AS DECIMAL(18,2))) AS DOUBLE) AS original_amount,
  CAST(sum(CAST(split_activity_amount AS DECIMAL(18,2))) AS DOUBLE) AS activity_reduce_amount,
  CAST(sum(CAST(split_coupon_amount AS DECIMAL(18,2))) AS DOUBLE) AS coupon_reduce_amount,
  CAST(sum(CAST(split_total_amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount FROM fact GROUP BY ALL"""


def plain_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in windows.SKU_MEASURES})


@query("f7_sku_orders", using(*FACT_NEEDS, **FACT) + SKU_WINDOW)
def f7_sku_orders(spark: SparkSession, sf: str) -> DataFrame:
    return plain_amounts(windows.sku_orders(fact(spark, sf), "1 day", "UTC"))


@query("f8_latest_per_window", using("log", d=f"SELECT *, ts // {HOUR} AS w FROM ({DEVICE_SQL})") + f"""
SELECT * EXCLUDE (w) FROM {latest('d', 'uid, w', 'ts', 'vc,ch,ar,os,md,ba,search_item')}""")
def f8_latest_per_window(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.latest_by_window(L.device_and_search(T.app_log(spark, sf)), ["uid"], "ts", HOUR)


def running_sql(order: str, relation: str) -> str:
    """Running counts and sorted distinct sets per user of ``relation`` ordered by ``order``."""
    sets = ", ".join(
        f"coalesce(array_to_string(list_sort(list_distinct(list({c}) FILTER (WHERE {c} IS NOT NULL) OVER w)), ','), '') AS {c}"
        for c in ("os", "ch", "md", "ba", "search_item"))
    return f"""
SELECT uid, ts AS ts_ms, count(*) OVER w AS pv, {sets} FROM {relation}
WINDOW w AS (PARTITION BY uid ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


RUNNING_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("ts", "vc", "ch", "ar", "os", "md", "ba", "search_item"))


@query("f9_running_profile", using("log", d=DEVICE_SQL) + running_sql(RUNNING_ORDER, "d"))
def f9_running_profile(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.running_profile(L.device_and_search(T.app_log(spark, sf)))


PROFILES = f"""
  SELECT * EXCLUDE (w, rn) FROM (
    SELECT *, ts_ms // 120000 AS w, row_number() OVER (PARTITION BY uid, ts_ms // 120000 ORDER BY ts_ms DESC, pv DESC) AS rn
    FROM ({running_sql(RUNNING_ORDER, 'd')})) WHERE rn = 1"""


@query("f9_profile_by_window", using("log", d=DEVICE_SQL, p=PROFILES) + "SELECT * FROM p")
def f9_profile_by_window(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.profile_by_window(L.device_and_search(T.app_log(spark, sf)), 120_000)
