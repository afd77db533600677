"""Change-log selections, routing and dimension merges over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import intervals, tags
from tidemark.operators import logs as L
from tidemark.plans import standins as T
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import using

_CUSTOMER_CHANGES = """
  SELECT 'customer' AS table_name, 'r' AS op, c_custkey AS id FROM customer
  UNION ALL SELECT 'customer', 'u', c_custkey FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'customer', 'd', c_custkey FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT 'customer', 'c', c_custkey FROM customer WHERE c_custkey % 14 = 0"""


@query("c1_valid_changes", f"""
SELECT table_name, op, CAST(id AS VARCHAR) AS id FROM ({_CUSTOMER_CHANGES}
  UNION ALL SELECT 'nation', 'r', n_nationkey FROM nation UNION ALL SELECT 'region', 'r', r_regionkey FROM region
  UNION ALL SELECT 'supplier', 'r', s_suppkey FROM supplier UNION ALL SELECT 'part', 'r', p_partkey FROM part)""")
def c1_valid_changes(spark: SparkSession, sf: str) -> DataFrame:
    both = T.dim_envelopes(spark, sf).unionByName(T.config_envelopes(spark, sf))
    key = F.coalesce(F.col("after")["id"], F.col("before")["id"])
    return C.valid_changes(both, "shop").select(F.col("source")["table"].alias("table_name"), "op", key.alias("id"))


@query("c2_table_select", using("order_detail") + """
SELECT id, order_id, sku_id, sku_name, create_time, source_id, source_type, sku_num, split_total_amount,
  split_activity_amount, split_coupon_amount,
  CAST(CAST(CAST(sku_num AS DECIMAL(16,2)) * CAST(order_price AS DECIMAL(16,2)) AS DECIMAL(33,4)) AS VARCHAR)
    AS split_original_amount, ts_ms FROM order_detail""")
def c2_table_select(spark: SparkSession, sf: str) -> DataFrame:
    return C.order_details(T.change_log(spark, sf))


@query("c3_cart_add", using("cart_info") + """
SELECT id, user_id, sku_id, CAST(CASE WHEN op = 'u' THEN sku_num - old_num ELSE sku_num END AS VARCHAR) AS sku_num, ts_ms
FROM cart_info WHERE op <> 'u' OR sku_num > old_num""")
def c3_cart_add(spark: SparkSession, sf: str) -> DataFrame:
    return C.cart_adds(T.change_log(spark, sf))


@query("c3_cart_add_as_written", using("cart_info") + """
SELECT id, user_id, sku_id, CAST(sku_num AS VARCHAR) AS sku_num, ts_ms FROM cart_info WHERE op = 'r'""")
def c3_cart_add_as_written(spark: SparkSession, sf: str) -> DataFrame:
    return C.cart_adds(T.change_log(spark, sf), "as_written")


@query("c4_order_cancel", using("order_info") + """
SELECT id, operate_time, ts_ms FROM order_info WHERE order_status IN ('1001', '1003')""")
def c4_order_cancel(spark: SparkSession, sf: str) -> DataFrame:
    return C.cancelled_orders(T.change_log(spark, sf))


@query("c4_order_cancel_as_written", using("order_info") + """
SELECT id, operate_time, ts_ms FROM order_info WHERE order_status = '1001' AND CAST(id AS BIGINT) % 2 = 0
  OR order_status = '1003'""")
def c4_order_cancel_as_written(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with odd ids are updates here: the first code needs a snapshot row, the second does not."""
    odd = F.col("after")["id"].try_cast("bigint") % 2 == 1
    order_rows = T.change_log(spark, sf).filter(F.col("source")["table"] == "order_info")
    return C.cancelled_orders(order_rows.withColumn("op", F.when(odd, "u").otherwise(F.col("op"))), strict=False)


@query("c5_payment_success", using("payment_info") + """
SELECT user_id, order_id, payment_type, callback_time, ts_ms FROM payment_info WHERE payment_status = '1602'""")
def c5_payment_success(spark: SparkSession, sf: str) -> DataFrame:
    return C.payments(T.change_log(spark, sf))


@query("c6_refund_request", using("order_refund_info") + """
SELECT id, user_id, order_id, sku_id, refund_type, refund_num, refund_amount, refund_reason_type, refund_reason_txt,
  create_time, ts_ms FROM order_refund_info""")
def c6_refund_request(spark: SparkSession, sf: str) -> DataFrame:
    return C.refund_requests(T.change_log(spark, sf))


@query("c7_order_status", using("order_info") + """
SELECT id, user_id, province_id, ts_ms FROM order_info WHERE order_status = '1006'""")
def c7_order_status(spark: SparkSession, sf: str) -> DataFrame:
    return C.orders_in_status(T.change_log(spark, sf))


@query("c8_refund_payment", using("refund_payment") + """
SELECT id, order_id, sku_id, payment_type, callback_time, total_amount, ts_ms FROM refund_payment
WHERE refund_status = '1602'""")
def c8_refund_payment(spark: SparkSession, sf: str) -> DataFrame:
    return C.refund_payments(T.change_log(spark, sf))


@query("c8_refund_approved", using("order_refund_info") + """
SELECT order_id, sku_id, refund_num, ts_ms FROM order_refund_info WHERE refund_status = '0705'""")
def c8_refund_approved(spark: SparkSession, sf: str) -> DataFrame:
    return C.approved_refunds(T.change_log(spark, sf))


# The routed rows as SQL: all changes of configured tables, cut to the configured columns.
_DIM_ROWS = """
  SELECT 'nation' AS source_table, 'r' AS op, 100 AS ts_ms, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name,
    'region_id' AS col3, CAST(n_regionkey AS VARCHAR) AS val3 FROM nation
  UNION ALL SELECT 'region', 'r', r_regionkey + 19, CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL FROM region
  UNION ALL SELECT 'supplier', 'r', 100, CAST(s_suppkey AS VARCHAR), s_name, 'nation_id', CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'part', 'r', 100, CAST(p_partkey AS VARCHAR), p_name, 'brand', p_brand FROM part
  UNION ALL SELECT 'customer', 'r', 100, CAST(c_custkey AS VARCHAR), c_name, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT 'customer', 'u', 200, CAST(c_custkey AS VARCHAR), c_name || ' v2', 'segment', '' FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'customer', 'd', 300, CAST(c_custkey AS VARCHAR), c_name, 'segment', c_mktsegment FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT 'customer', 'c', 400, CAST(c_custkey AS VARCHAR), c_name || ' v3', NULL, NULL FROM customer WHERE c_custkey % 14 = 0"""


@query("c12_config_routing", using("active_config", rows_=_DIM_ROWS) + """
SELECT c.sink_table, r.op, CAST(r.ts_ms AS BIGINT) AS ts_ms, r.id AS row_key, r.name, r.col3 IS NOT NULL AS has_third
FROM rows_ r JOIN active_config c USING (source_table)""")
def c12_config_routing(spark: SparkSession, sf: str) -> DataFrame:
    config = C.active_config(C.config_changes(T.config_envelopes(spark, sf)))
    cells = F.col("cells")
    return C.route(T.dim_envelopes(spark, sf), config).select(
        "sink_table", "op", "ts_ms", "row_key", cells["name"].alias("name"), (F.size(cells) == 3).alias("has_third"))


@query("c13_config_rows", using("config") + "SELECT * FROM config")
def c13_config_rows(spark: SparkSession, sf: str) -> DataFrame:
    return C.config_changes(T.config_envelopes(spark, sf))


_CELLS = """
  SELECT c.sink_table, r.id AS row_key, r.op, r.ts_ms, x.name, x.value FROM rows_ r JOIN active_config c USING (source_table),
    LATERAL (SELECT 'id' AS name, r.id AS value UNION ALL SELECT 'name', r.name UNION ALL SELECT r.col3, r.val3) x
  WHERE x.name IS NOT NULL"""
_MERGED = """
  SELECT sink_table, row_key, name, value FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.sink_table, c.row_key, name ORDER BY c.ts_ms DESC, value DESC) AS rn
    FROM cells_ c LEFT JOIN (SELECT sink_table, row_key, max(ts_ms) AS gone FROM cells_ WHERE op = 'd' GROUP BY ALL) d
      USING (sink_table, row_key)
    WHERE c.op <> 'd' AND coalesce(value, '') <> '' AND (gone IS NULL OR c.ts_ms > gone)) WHERE rn = 1"""


@query("b5_dim_merge", using("active_config", rows_=_DIM_ROWS, cells_=_CELLS) + _MERGED)
def b5_dim_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All dimension tables after all changes, cell by cell."""
    config = C.active_config(C.config_changes(T.config_envelopes(spark, sf)))
    merged = C.merge_dims(C.route(C.valid_changes(T.dim_envelopes(spark, sf), "shop"), config))
    return merged.select("sink_table", "row_key", F.explode("cells").alias("name", "value"))


@query("b6_dim_lifecycle", using("active_config") + "SELECT sink_table, sink_columns, emptied_at FROM active_config")
def b6_dim_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension tables that exist, and when each was last emptied."""
    return C.active_config(C.config_changes(T.config_envelopes(spark, sf))).select("sink_table", "sink_columns", "emptied_at")


@query("c18_order_projection", using("tag_order_info") + """
SELECT id, user_id AS uid, consignee, CAST(create_time AS BIGINT) AS create_time, original_total_amount, total_amount,
  CAST(province_id AS BIGINT) AS province_id,
  CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午' WHEN h < 18 THEN '下午'
    WHEN h < 22 THEN '晚上' ELSE '夜间' END AS pay_time_slot, ts_ms
FROM (SELECT *, ts_ms // 3600000 % 24 AS h FROM tag_order_info)""")
def c18_order_projection(spark: SparkSession, sf: str) -> DataFrame:
    return tags.order_rows(T.tag_change_log(spark, sf), "UTC")


@query("c19_detail_projection", using("tag_order_detail") + """
SELECT CAST(sku_num AS BIGINT) AS sku_num, CAST(create_time AS BIGINT) AS create_time, CAST(sku_id AS BIGINT) AS sku_id,
  split_coupon_amount, sku_name, order_price, id, order_id, split_activity_amount, split_total_amount, ts_ms
FROM tag_order_detail""")
def c19_detail_projection(spark: SparkSession, sf: str) -> DataFrame:
    return tags.detail_rows(T.tag_change_log(spark, sf))


ZODIAC_SQL = """CASE WHEN md <= 119 THEN '摩羯座' WHEN md <= 218 THEN '水瓶座' WHEN md <= 320 THEN '双鱼座' WHEN md <= 419 THEN '白羊座'
  WHEN md <= 520 THEN '金牛座' WHEN md <= 621 THEN '双子座' WHEN md <= 722 THEN '巨蟹座' WHEN md <= 822 THEN '狮子座'
  WHEN md <= 922 THEN '处女座' WHEN md <= 1022 THEN '天秤座' WHEN md <= 1122 THEN '天蝎座' WHEN md <= 1221 THEN '射手座'
  ELSE '摩羯座' END"""
USERS_SQL = f"""
  SELECT id AS uid, name AS uname, user_level, login_name, phone_num, email, gender, strftime(b, '%Y-%m-%d') AS birthday,
    CAST(2024 - year(b) - CASE WHEN 615 < md THEN 1 ELSE 0 END AS INT) AS age, CAST(year(b) // 10 * 10 AS INT) AS decade,
    {ZODIAC_SQL} AS zodiac_sign, ts_ms
  FROM (SELECT *, month(b) * 100 + day(b) AS md FROM
    (SELECT *, DATE '1970-01-01' + CAST(birthday AS INT) AS b FROM user_info))"""
TODAY = "2024-06-15"


@query("c20_user_projection", using("user_info", u=USERS_SQL) + """
SELECT * REPLACE (coalesce(gender, 'home') AS gender) FROM u""")
def c20_user_projection(spark: SparkSession, sf: str) -> DataFrame:
    return tags.user_rows(T.tag_change_log(spark, sf), TODAY)


@query("c20_user_projection_nick", using("user_info", u=USERS_SQL) + """
SELECT u.*, nick_name FROM u JOIN user_info i ON u.uid = i.id""")
def c20_user_projection_nick(spark: SparkSession, sf: str) -> DataFrame:
    return tags.user_rows(T.tag_change_log(spark, sf), TODAY, default_gender=None, nick_name=True)


@query("c21_supplement_projection", using("user_info_sup_msg") + "SELECT * FROM user_info_sup_msg")
def c21_supplement_projection(spark: SparkSession, sf: str) -> DataFrame:
    return tags.supplement_rows(T.tag_change_log(spark, sf))


@query("c22_not_empty", using("user_info") + "SELECT id, gender FROM user_info WHERE coalesce(gender, '') <> ''")
def c22_not_empty(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.select_table(T.change_log(spark, sf), "user_info", ["id", "gender"])
    return L.not_empty(rows, "id", "gender").select("id", "gender")


@query("c23_trimmed_projections", using("tag_order_info", "tag_order_detail") + """
SELECT 'order' AS kind, id AS order_id, user_id AS a, total_amount AS b, ts_ms FROM tag_order_info
UNION ALL SELECT 'detail', order_id, sku_id, sku_name, ts_ms FROM tag_order_detail""")
def c23_trimmed_projections(spark: SparkSession, sf: str) -> DataFrame:
    log = T.tag_change_log(spark, sf)
    orders = intervals.trimmed_orders(log).select(
        F.lit("order").alias("kind"), "order_id", F.col("uid").alias("a"), F.col("total_amount").alias("b"), "ts_ms")
    details = intervals.trimmed_details(log).select(
        F.lit("detail").alias("kind"), "order_id", F.col("sku_id").alias("a"), F.col("sku_name").alias("b"),
        F.col("detail_ts_ms").alias("ts_ms"))
    return orders.unionByName(details)
