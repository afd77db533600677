"""Interval joins and dimension lookups over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import intervals as I
from tidemark.operators import keyed, lookups, tags
from tidemark.operators import logs as L
from tidemark.plans import standins as T
from tidemark.plans.catalog.changes import TODAY, USERS_SQL
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import latest, using

SLOT_SQL = """CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
  WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END"""
ORDER_DETAIL_JOIN = f"""
  SELECT o.id AS order_id, user_id AS uid, consignee, CAST(o.create_time AS BIGINT) AS create_time, original_total_amount,
    total_amount, CAST(province_id AS BIGINT) AS province_id, {SLOT_SQL} AS pay_time_slot, o.ts_ms,
    d.id AS detail_id, CAST(sku_num AS BIGINT) AS sku_num, CAST(sku_id AS BIGINT) AS sku_id, sku_name, order_price,
    split_activity_amount, split_coupon_amount, split_total_amount
  FROM (SELECT *, ts_ms // 3600000 % 24 AS h FROM tag_order_info) o JOIN tag_order_detail d ON o.id = d.order_id
  WHERE d.ts_ms BETWEEN o.ts_ms - 120000 AND o.ts_ms + 120000"""


def order_detail_join(spark: SparkSession, sf: str, compat: bool = False) -> DataFrame:
    log = T.tag_change_log(spark, sf)
    orders = L.not_empty(tags.order_rows(log, "UTC"), "id")
    details = L.not_empty(tags.detail_rows(log), "order_id")
    return I.order_with_details(orders, details, compat=compat)


@query("d7_order_interval", using("tag_order_info", "tag_order_detail") + ORDER_DETAIL_JOIN)
def d7_order_interval(spark: SparkSession, sf: str) -> DataFrame:
    return order_detail_join(spark, sf)


@query("d7_order_interval_as_written", using("tag_order_info", "tag_order_detail", j=ORDER_DETAIL_JOIN) + """
SELECT * REPLACE (CAST(sku_num AS VARCHAR) AS split_coupon_amount,
  CAST(CAST(trunc(CAST(split_activity_amount AS DOUBLE)) AS BIGINT) AS VARCHAR) AS split_activity_amount,
  CAST(CAST(trunc(CAST(split_total_amount AS DOUBLE)) AS BIGINT) AS VARCHAR) AS split_total_amount) FROM j""")
def d7_order_interval_as_written(spark: SparkSession, sf: str) -> DataFrame:
    return order_detail_join(spark, sf, compat=True)


def user_join_sql(minutes: int, gender: str) -> str:
    return f"""
  SELECT u.* REPLACE ({gender} AS gender), height, unit_height, weight, unit_weight
  FROM u JOIN user_info_sup_msg s ON u.uid = s.uid
  WHERE s.ts_ms BETWEEN u.ts_ms - {minutes * 60000} AND u.ts_ms + {minutes * 60000}"""


def user_join(spark: SparkSession, sf: str) -> DataFrame:
    log = T.tag_change_log(spark, sf)
    return I.user_with_supplement(
        L.not_empty(tags.user_rows(log, TODAY), "uid"), L.not_empty(tags.supplement_rows(log), "uid"))


@query("d8_user_interval", using("user_info", "user_info_sup_msg", u=USERS_SQL) + user_join_sql(5, "coalesce(gender, 'home')"))
def d8_user_interval(spark: SparkSession, sf: str) -> DataFrame:
    return user_join(spark, sf)


@query("d9_user_interval_hour", using("user_info", "user_info_sup_msg", u=USERS_SQL) + user_join_sql(60, "coalesce(gender, 'null')"))
def d9_user_interval_hour(spark: SparkSession, sf: str) -> DataFrame:
    log = T.tag_change_log(spark, sf)
    users = tags.user_rows(log, TODAY, default_gender=None)
    return I.user_with_supplement(users, tags.supplement_rows(log), 60 * I.MINUTE, default_gender="null")


@query("d10_order_interval_trimmed", using("tag_order_info", "tag_order_detail") + """
SELECT o.id AS order_id, user_id AS uid, total_amount, o.ts_ms, sku_id, sku_name
FROM tag_order_info o JOIN tag_order_detail d ON o.id = d.order_id
WHERE d.ts_ms BETWEEN o.ts_ms - 300000 AND o.ts_ms + 300000""")
def d10_order_interval_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    log = T.tag_change_log(spark, sf)
    return I.trimmed_order_join(I.trimmed_orders(log), I.trimmed_details(log))


@query("d14_province_lookup", using("order_info", "province") + """
SELECT o.id, province_id, name AS province_name FROM order_info o LEFT JOIN province p ON o.province_id = p.id""")
def d14_province_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = C.orders(T.change_log(spark, sf)).select("id", "province_id")
    return lookups.province_names(orders, T.provinces(spark, sf))


SKU_DIM = """
  SELECT s.id AS sku_id, spu_id, spu_name, s.tm_id AS trademark_id, tm_name AS trademark_name, s.category3_id,
    c3.name AS category3_name, category2_id, c2.name AS category2_name, category1_id, c1.name AS category1_name
  FROM sku_info s LEFT JOIN trademark t ON s.tm_id = t.id LEFT JOIN category3 c3 ON s.category3_id = c3.id
  LEFT JOIN category2 c2 ON c3.category2_id = c2.id LEFT JOIN category1 c1 ON c2.category1_id = c1.id"""
SKU_NEEDS = ("sku_info", "trademark", "category3", "category2", "category1")


@T.once
def sku_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.sku_dimension(
        T.sku_info(spark, sf), T.trademarks(spark, sf), T.category3(spark), T.category2(spark), T.category1(spark))


@query("d15_sku_lookup", using("order_detail", *SKU_NEEDS, dim=SKU_DIM) + """
SELECT o.id, o.ts_ms, dim.* FROM order_detail o LEFT JOIN dim USING (sku_id)""")
def d15_sku_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.order_detail(spark, sf).select("id", "ts_ms", "sku_id")
    return lookups.sku_lookups(rows, sku_dimension(spark, sf), skus=T.sku_info(spark, sf))


@query("d16_generic_lookup", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id, c_name AS name, c_mktsegment AS segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def d16_generic_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = T.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("user_id"))
    people = T.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return lookups.enrich(orders, people, "user_id", ["name", "segment"], dim_key="uid")


@query("d17_config_broadcast", using("active_config") + """
SELECT t.table_name, sink_table, CAST(t.n AS BIGINT) AS n FROM (
  SELECT 'nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region
  UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part
  UNION ALL SELECT 'customer', (SELECT sum(1 + CAST(c_custkey % 3 = 0 AS INT) + CAST(c_custkey % 7 = 0 AS INT)
    + CAST(c_custkey % 14 = 0 AS INT)) FROM customer)) t JOIN active_config c ON t.table_name = c.source_table""")
def d17_config_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    config = C.active_config(C.config_changes(T.config_envelopes(spark, sf)))
    routed = C.route(C.valid_changes(T.dim_envelopes(spark, sf), "shop"), config)
    return routed.groupBy(F.col("source_table").alias("table_name"), "sink_table").agg(F.count(F.lit(1)).alias("n"))


@T.once
def tree(spark: SparkSession) -> DataFrame:
    return lookups.category_tree(T.category3(spark), T.category2(spark), T.category1(spark))


@T.once
def brands(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.sku_brands(T.sku_info(spark, sf), T.spu_info(spark, sf), T.trademarks(spark, sf))


@query("d18_category_tree", using("sku_info", "tree") + """
SELECT s.id AS sku_id, t.* FROM sku_info s JOIN tree t ON s.category3_id = t.id""")
def d18_category_tree(spark: SparkSession, sf: str) -> DataFrame:
    skus = T.sku_info(spark, sf).select(F.col("id").alias("sku_id"), F.col("category3_id").alias("id"))
    return lookups.lookup_join(skus, tree(spark), ["id"])


@query("d19_sku_brands", using("brands") + "SELECT * FROM brands")
def d19_sku_brands(spark: SparkSession, sf: str) -> DataFrame:
    return brands(spark, sf)


SEARCH_LOOKUP = f"""
  SELECT l.*, t.b1name AS b1_category, c.search_category FROM profiles l
  LEFT JOIN {latest('(SELECT b3name, b1name, id FROM tree)', 'b3name', 'id', 'b1name')} t ON l.search_item = t.b3name
  LEFT JOIN {latest('compare', 'category_name', 'id', 'search_category', first=True)} c ON t.b1name = c.category_name"""
BRAND_LOOKUP = f"""
  SELECT o.*, b.c3id, b.tname, t.b1name AS b1_name FROM joined o
  LEFT JOIN {latest('(SELECT skuid, c3id, tname FROM brands)', 'skuid', 'c3id,tname', first=True)} b
    ON CAST(o.sku_id AS VARCHAR) = b.skuid LEFT JOIN tree t ON b.c3id = t.id"""


@query("d20_search_lookup", using("log", "tree", "compare", profiles="""
  SELECT uid, ts, item AS search_item FROM log""", r=SEARCH_LOOKUP) + "SELECT * FROM r")
def d20_search_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.device_and_search(T.app_log(spark, sf)).select("uid", "ts", "search_item")
    return lookups.search_category(rows, tree(spark), T.category_compare(spark))


@query("d20_brand_lookup", using("order_detail", "brands", "tree", joined="""
  SELECT id, sku_id FROM order_detail""", r=BRAND_LOOKUP) + "SELECT * FROM r")
def d20_brand_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.order_detail(spark, sf).select("id", "sku_id")
    return lookups.brand_and_category(rows, brands(spark, sf), tree(spark), T.sku_info(spark, sf))


@query("g12_join_retention", using("order_info", "payment_info") + """
SELECT o.id AS order_id, o.ts_ms, p.ts_ms AS pay_ts_ms FROM order_info o JOIN payment_info p ON o.id = p.order_id
WHERE p.ts_ms BETWEEN o.ts_ms - 7200000 AND o.ts_ms + 7200000 AND payment_status = '1602'""")
def g12_join_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and payments that meet while both are kept."""
    log = T.change_log(spark, sf, "order_info", "payment_info")
    orders = C.orders(log).select(F.col("id").alias("order_id"), "ts_ms")
    paid = C.payments(log).select("order_id", F.col("ts_ms").alias("pay_ts_ms"))
    return keyed.join_within_retention(orders, paid, "order_id", "ts_ms", "pay_ts_ms", 2 * I.HOUR)
