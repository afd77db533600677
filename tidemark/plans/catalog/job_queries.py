"""The batch jobs from raw input to output table, over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scores as M
from tidemark.operators import changelog as C
from tidemark.plans import jobs
from tidemark.plans import standins as T
from tidemark.plans.catalog.changes import _CELLS, _DIM_ROWS, _MERGED, TODAY, USERS_SQL
from tidemark.plans.catalog.fact_queries import DETAIL_REST, FACT, FACT_NEEDS, fact
from tidemark.plans.catalog.join_queries import SEARCH_LOOKUP, SKU_DIM, SKU_NEEDS, sku_dimension, tree, user_join_sql
from tidemark.plans.catalog.log_queries import DEVICE_SQL
from tidemark.plans.catalog.tag_queries import device_sql, milli, search_sql
from tidemark.plans.catalog.window_queries import (
    CART_ADDS, CART_SQL, DAY, HOME_DETAIL_SQL, LOGIN_DAYS, LOGIN_SQL, PROFILES, TRAFFIC_SQL, VERSIONS,
    plain_amounts,
)
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import bounds, latest, using
from tidemark.session import new_path
from tidemark.sources.cdc import land_changes, landed_changes, parse_envelopes, to_values


@query("job_ods_ingest", using("cart_info") + """
SELECT id, op, CAST(sku_num AS VARCHAR) AS sku_num, CASE WHEN op = 'u' THEN CAST(old_num AS VARCHAR) END AS old_num, ts_ms
FROM cart_info""")
def job_ods_ingest(spark: SparkSession, sf: str) -> DataFrame:
    back = parse_envelopes(jobs.ods_ingest(T.cart_envelopes(spark, sf)))
    return back.select(
        F.col("after")["id"].alias("id"), "op", F.col("after")["sku_num"].alias("sku_num"),
        F.col("before")["sku_num"].alias("old_num"), "ts_ms")


@T.once
def landed(spark: SparkSession, sf: str) -> DataFrame:
    """The change log of all shop tables as JSON text, parsed once and landed by table."""
    path = new_path(spark, "landed")
    land_changes(jobs.ods_ingest(T.change_log(spark, sf)), path)
    return landed_changes(spark, path)


@query("job_ods_land", using("cart_info", "order_info", "order_detail", "payment_info", "comment_info") + """
SELECT 'cart_info' AS name, op, count(*) AS n, max(ts_ms) AS last_ms FROM cart_info GROUP BY op
UNION ALL SELECT 'order_info', 'r', count(*), max(ts_ms) FROM order_info UNION ALL SELECT 'order_detail', 'r', count(*), max(ts_ms) FROM order_detail
UNION ALL SELECT 'payment_info', 'r', count(*), max(ts_ms) FROM payment_info UNION ALL SELECT 'comment_info', 'r', count(*), max(ts_ms) FROM comment_info""")
def job_ods_land(spark: SparkSession, sf: str) -> DataFrame:
    """Operations per table of the landed log; the rows themselves are checked by the facts that read it."""
    name = F.col("source")["table"]
    some = landed(spark, sf).filter(name.isin("cart_info", "order_info", "order_detail", "payment_info", "comment_info"))
    return some.groupBy(name.alias("name"), "op").agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ms"))


@query("job_dwd_order_detail_landed", using(*FACT_NEEDS, **FACT) + "SELECT * FROM fact")
def job_dwd_order_detail_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The order-detail fact from the landed log."""
    return jobs.dwd_order_detail(landed(spark, sf), "UTC")


_KEPT = """SELECT * FROM (SELECT r.*, emptied_at FROM all_rows r JOIN active_config c USING (source_table))
  WHERE emptied_at IS NULL OR ts_ms > emptied_at"""


@query("job_dim_sync", using("active_config", all_rows=_DIM_ROWS, rows_=_KEPT, cells_=_CELLS) + _MERGED)
def job_dim_sync(spark: SparkSession, sf: str) -> DataFrame:
    config = C.config_changes(T.config_envelopes(spark, sf))
    merged = jobs.dim_sync(to_values(T.dim_envelopes(spark, sf)), config, "shop")
    return merged.select("sink_table", "row_key", F.explode("cells").alias("name", "value"))


_FIXED = """
  SELECT *, CASE WHEN is_new = '1' AND d <> stored THEN '0' ELSE is_new END AS fixed FROM (
    SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE d - 1 END) OVER (PARTITION BY mid ORDER BY ts, is_new) AS stored
    FROM (SELECT *, ts // 86400000 AS d FROM log WHERE ts % 89 <> 0 AND ts % 97 <> 0))"""


@query("job_dwd_base_log", using("log", f=_FIXED, p="SELECT * FROM f WHERE NOT has_start") + """
SELECT 'dirty' AS output, NULL AS is_new, count(*) AS n FROM log WHERE ts % 89 <> 0 AND ts % 97 = 0
UNION ALL SELECT 'err', fixed, count(*) FROM f WHERE has_err GROUP BY fixed
UNION ALL SELECT 'start', fixed, count(*) FROM f WHERE has_start GROUP BY fixed
UNION ALL SELECT 'display', fixed, CAST(sum(entries) AS BIGINT) FROM p GROUP BY fixed
UNION ALL SELECT 'action', fixed, CAST(sum(entries) AS BIGINT) FROM p GROUP BY fixed
UNION ALL SELECT 'page', fixed, count(*) FROM p GROUP BY fixed""")
def job_dwd_base_log(spark: SparkSession, sf: str) -> DataFrame:
    """All outputs of the log job, counted by repaired flag."""
    out = jobs.dwd_base_log_outputs(T.log_topic(spark, sf), "UTC")
    flag = F.get_json_object("value", "$.common.is_new")
    return out.groupBy("output", F.when(F.col("output") != "dirty", flag).alias("is_new")).agg(F.count(F.lit(1)).alias("n"))


@query("job_dwd_comment", using("comment_info", "base_dic") + """
SELECT id, user_id, sku_id, appraise, dic_name AS appraise_name, comment_txt, ts_ms
FROM comment_info JOIN base_dic ON appraise = dic_code""")
def job_dwd_comment(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = T.base_dic(spark, sf).select("dic_code", F.struct("dic_name").alias("info"))
    return jobs.dwd_comment(T.change_log(spark, sf, "cart_info", "comment_info"), dictionary)


@query("job_dwd_cart_add", using("cart_info") + """
SELECT id, user_id, sku_id, CAST(CASE WHEN op = 'u' THEN sku_num - old_num ELSE sku_num END AS VARCHAR) AS sku_num, ts_ms
FROM cart_info WHERE op <> 'u' OR sku_num > old_num""")
def job_dwd_cart_add(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dwd_cart_add(T.change_log(spark, sf, "cart_info", "comment_info"))


@query("job_dws_keyword", using("log") + f"""
SELECT {bounds('ts', 5000)}, keyword, count(*) AS keyword_count FROM (
  SELECT ts, unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM log
  WHERE last_page_id = 'search' AND item_type = 'keyword') GROUP BY ALL""")
def job_dws_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dws_keyword(T.app_log(spark, sf), tz="UTC")


@query("job_dws_traffic", using("log") + TRAFFIC_SQL)
def job_dws_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dws_traffic(T.app_log(spark, sf), "1 hour", "UTC")


@query("job_dws_home_detail", using("log") + HOME_DETAIL_SQL)
def job_dws_home_detail(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dws_home_detail(T.app_log(spark, sf), "1 hour", "UTC")


@query("job_dws_login", using("log", days_=LOGIN_DAYS) + LOGIN_SQL)
def job_dws_login(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dws_login(T.app_log(spark, sf), "1 hour", "UTC")


@query("job_dws_cart_uu", using("cart_info", adds=CART_ADDS) + CART_SQL)
def job_dws_cart_uu(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.dws_cart_uu(jobs.dwd_cart_add(T.change_log(spark, sf, "cart_info", "comment_info")), "1 hour", "UTC")


@query("job_dws_province", using("order_detail", "order_info", "province", v=VERSIONS) + f"""
SELECT {bounds('ts_ms', DAY)}, province_id, any_value(name) AS province_name, count(DISTINCT order_id) AS order_count,
  CAST(sum(CASE WHEN rn = 1 THEN amount ELSE 0 END) AS DOUBLE) AS order_amount
FROM (SELECT *, row_number() OVER (PARTITION BY v.id ORDER BY ts_ms DESC, order_id DESC, amount DESC) AS rn FROM v) v
LEFT JOIN province p ON v.province_id = p.id GROUP BY ALL""")
def job_dws_province(spark: SparkSession, sf: str) -> DataFrame:
    log = T.change_log(spark, sf, "order_detail", "order_info")
    details = C.order_details(log).select("id", "order_id", "split_total_amount", "ts_ms")
    orders = C.orders(log).select(F.col("id").alias("order_id"), "province_id", "ts_ms")
    out = jobs.dws_province(details, T.provinces(spark, sf), "1 day", "UTC", orders)
    return out.withColumn("order_amount", F.col("order_amount").cast("double"))


_SKU = f"""
  SELECT {bounds('ts_ms', DAY)}, sku_id, CAST(sum(CAST(split_original_amount AS DECIMAL(18,2))) AS DOUBLE) AS original_amount,
    CAST(sum(CAST(split_activity_amount AS DECIMAL(18,2))) AS DOUBLE) AS activity_reduce_amount,
    CAST(sum(CAST(split_coupon_amount AS DECIMAL(18,2))) AS DOUBLE) AS coupon_reduce_amount,
    CAST(sum(CAST(split_total_amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
  FROM {latest('od_', 'id', 'ts_ms', DETAIL_REST)} GROUP BY ALL"""


@query("job_dws_sku", using("order_detail", *SKU_NEEDS, od_=FACT["od_"], dim=SKU_DIM, m=_SKU) + """
SELECT m.*, dim.* EXCLUDE (sku_id) FROM m LEFT JOIN dim USING (sku_id)""")
def job_dws_sku(spark: SparkSession, sf: str) -> DataFrame:
    details = C.order_details(T.change_log(spark, sf, *T.TRADE))
    return plain_amounts(jobs.dws_sku(details, sku_dimension(spark, sf), "1 day", "UTC", T.sku_info(spark, sf)))


@query("job_dwd_order_chain", using(*FACT_NEEDS, "payment_info", **FACT) + """
SELECT f.id, cast(o.id IS NOT NULL AS INT) AS cancelled, cast(p.order_id IS NOT NULL AS INT) AS paid FROM fact f
LEFT JOIN (SELECT id FROM order_info WHERE order_status IN ('1001','1003')) o ON f.order_id = o.id
LEFT JOIN (SELECT order_id FROM payment_info WHERE payment_status = '1602') p ON f.order_id = p.order_id""")
def job_dwd_order_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Detail, cancel and payment facts brought together per line."""
    log, lines = T.change_log(spark, sf, "order_info", "payment_info"), fact(spark, sf)
    cancelled = jobs.dwd_order_cancel(log, lines, "UTC").select("id", F.lit(1).alias("c"))
    paid = jobs.dwd_pay_success(log, lines).select(F.col("order_detail_id").alias("id"), F.lit(1).alias("p"))
    flags = cancelled.unionByName(paid, allowMissingColumns=True).unionByName(lines.select("id"), allowMissingColumns=True)
    return flags.groupBy("id").agg(
        F.coalesce(F.max("c"), F.lit(0)).alias("cancelled"), F.coalesce(F.max("p"), F.lit(0)).alias("paid"))


@query("job_tag_log", using("log", d=f"SELECT DISTINCT * FROM ({DEVICE_SQL})", p=PROFILES) + "SELECT * FROM p")
def job_tag_log(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_log(T.app_log(spark, sf))


@query("job_tag_score", using("log", "tree", "compare", d=f"SELECT DISTINCT * FROM ({DEVICE_SQL})", profiles=PROFILES, r=SEARCH_LOOKUP) + f"""
SELECT uid, ts_ms, search_category, {device_sql("split_part(os, ',', 1)")}, {search_sql(True)} FROM r""")
def job_tag_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = jobs.tag_score(jobs.tag_log(T.app_log(spark, sf)), tree(spark), T.category_compare(spark))
    names = [f"{m}_{b}" for m in ("device", "search") for b in M.BANDS]
    return milli(scored, "device", "search").select("uid", "ts_ms", "search_category", *names)


@query("job_tag_user", using("user_info", "user_info_sup_msg", u="""
  SELECT x.* REPLACE (CASE WHEN strftime(b, '%m%d') = '1023' THEN '天秤座' ELSE zodiac_sign END AS zodiac_sign), nick_name
  FROM (SELECT *, CAST(birthday AS DATE) AS b FROM (""" + USERS_SQL + """)) x JOIN user_info i ON x.uid = i.id""") + """
SELECT * EXCLUDE (b) FROM (""" + user_join_sql(60, "coalesce(gender, 'null')") + ")")
def job_tag_user(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_user_standalone(T.tag_change_log(spark, sf), TODAY)


@query("job_tag_order", using("tag_order_info", "tag_order_detail") + """
SELECT o.id AS order_id, user_id AS uid, total_amount, o.ts_ms, sku_id, sku_name
FROM tag_order_info o JOIN tag_order_detail d ON o.id = d.order_id
WHERE d.ts_ms BETWEEN o.ts_ms - 300000 AND o.ts_ms + 300000""")
def job_tag_order(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_order(T.tag_change_log(spark, sf))


