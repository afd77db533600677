"""Sources and sinks over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import facts, logs, windows
from tidemark.plans import standins as T
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import bounds, dt, latest, using
from tidemark.schemas import ENVELOPE, LOG_MAPS
from tidemark.session import new_path
from tidemark.sources import cdc, sinks, tables

HOUR = 3_600_000

_ALL_TABLES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {'order_detail_id' if name.startswith('order_detail_') else 'order_id' if name == 'payment_info' else 'uid' if name == 'user_info_sup_msg' else 'id'} AS k, ts_ms FROM {name}"
    for name in T.SHOP)


@query("a1_cdc_scan", using(*T.SHOP, "cart_info", rows_=_ALL_TABLES + " UNION ALL SELECT 'cart_info', id, ts_ms FROM cart_info") + """
SELECT table_name, count(*) AS n, count(DISTINCT k) AS n_keys, min(ts_ms) AS first_ts, max(ts_ms) AS last_ts
FROM rows_ GROUP BY table_name""")
def a1_cdc_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The whole change log through its JSON text form."""
    read = cdc.parse_envelopes(cdc.to_values(T.change_log(spark, sf)))
    after = F.col("after")
    key = F.coalesce(after["id"], after["order_detail_id"], after["order_id"], after["uid"])
    return read.groupBy(F.col("source")["table"].alias("table_name")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"),
        F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts"))


@query("a3_value_scan", using("log") + """
SELECT count(*) AS n, count(CASE WHEN ts % 89 = 0 THEN 1 END) AS n_null,
  count(CASE WHEN ts % 89 <> 0 AND ts % 97 = 0 THEN 1 END) AS n_cut FROM log""")
def a3_value_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of a topic; null payloads stay null."""
    path = new_path(spark, "values")
    T.raw_log(spark, sf).write.parquet(path)
    value = F.col("value")
    return tables.read_table(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value.isNull()).alias("n_null"),
        F.count_if(value.isNotNull() & ~value.endswith("}")).alias("n_cut"))


@query("a4_json_topic_table", using("cart_info") + """
SELECT id, user_id, CAST(sku_num AS VARCHAR) AS sku_num, op, ts_ms FROM cart_info""")
def a4_json_topic_table(spark: SparkSession, sf: str) -> DataFrame:
    cdc.json_table(cdc.to_values(T.cart_envelopes(spark, sf)), ENVELOPE, "topic_db")
    return spark.sql("""
        SELECT after['id'] AS id, after['user_id'] AS user_id, after['sku_num'] AS sku_num, op, ts_ms
        FROM topic_db WHERE source['table'] = 'cart_info'""")


@query("a5_event_time_topic", using("log") + f"""
SELECT item AS fullword, {dt('ts')} AS event_time FROM log
WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL""")
def a5_event_time_topic(spark: SparkSession, sf: str) -> DataFrame:
    log = cdc.json_table(cdc.to_values(T.app_log(spark, sf)), LOG_MAPS)
    page = F.col("page")
    return (
        cdc.with_event_time(log, "ts", "3 seconds")
        .filter((page["last_page_id"] == "search") & (page["item_type"] == "keyword") & page["item"].isNotNull())
        .select(page["item"].alias("fullword"), F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("event_time")))


@query("a6_fact_reread", using("order_detail", "order_info", d=latest(
    "order_detail", "id", "ts_ms", "order_id,sku_id,sku_name,create_time,source_id,source_type,sku_num,split_total_amount,split_activity_amount,split_coupon_amount")) + """
SELECT province_id, count(*) AS n_lines, count(DISTINCT d.order_id) AS n_orders
FROM d JOIN order_info o ON d.order_id = o.id GROUP BY province_id""")
def a6_fact_reread(spark: SparkSession, sf: str) -> DataFrame:
    """A fact written once and read as the source of the next job."""
    path = new_path(spark, "order-detail")
    facts.order_detail_facts(T.change_log(spark, sf, *T.TRADE), "UTC").write.parquet(path)
    return tables.read_table(spark, path).groupBy("province_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("order_id").alias("n_orders"))


@query("a7_dim_scan", using("base_dic") + "SELECT dic_code, dic_name FROM base_dic")
def a7_dim_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.dim_scan(T.base_dic(spark, sf), "dic_code").select("dic_code", "info.dic_name")


@query("a8_reference_rows", using("sku_info") + """
SELECT id, spu_id AS "spuId", spu_name AS "spuName", tm_id AS "tmId", category3_id AS "category3Id" FROM sku_info""")
def a8_reference_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tables.camel_columns(T.sku_info(spark, sf))


@query("a9_config_scan", using("config") + "SELECT source_table, op, ts_ms FROM config")
def a9_config_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = cdc.parse_envelopes(cdc.to_values(T.config_envelopes(spark, sf)))
    table = F.coalesce(F.col("after")["source_table"], F.col("before")["source_table"])
    return rows.filter(F.col("source")["db"] == "config").select(table.alias("source_table"), "op", "ts_ms")


@query("b1_append_sink", using("log") + "SELECT mid, page_id, ts FROM log WHERE NOT has_start")
def b1_append_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "pages")
    sinks.append_values(cdc.to_values(logs.page_log(T.app_log(spark, sf))), path)
    return cdc.json_table(cdc.file_values(spark, path), LOG_MAPS).select(
        F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"), "ts")


@query("b2_dynamic_topic_sink", """
SELECT 'dim_nation' AS sink_table, count(*) AS n FROM nation UNION ALL SELECT 'dim_region', count(*) FROM region
UNION ALL SELECT 'dim_supplier', count(*) FROM supplier
UNION ALL SELECT 'dim_customer', count(*) + count(CASE WHEN c_custkey % 3 = 0 THEN 1 END)
  + count(CASE WHEN c_custkey % 7 = 0 THEN 1 END) + count(CASE WHEN c_custkey % 14 = 0 THEN 1 END) FROM customer""")
def b2_dynamic_topic_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "routed")
    config = C.active_config(C.config_changes(T.config_envelopes(spark, sf)))
    sinks.append_by_row_topic(C.route(T.dim_envelopes(spark, sf), config).select("sink_table", "row_key", "cells", "op"), path)
    return spark.read.json(path).groupBy("sink_table").agg(F.count(F.lit(1)).alias("n"))


@query("b3_upsert_sink", using("order_detail", d=latest(
    "(SELECT id, sku_id, split_total_amount, ts_ms FROM order_detail)", "id", "ts_ms", "sku_id,split_total_amount")) + """
SELECT id, sku_id, split_total_amount, ts_ms FROM d""")
def b3_upsert_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of changes into a keyed table; the last row per key wins."""
    path = new_path(spark, "upsert")
    columns = ["id", "sku_id", "split_total_amount", "ts_ms"]
    rows, shipped = T.order_detail(spark, sf), F.col("source_type").endswith("F")
    sinks.write_changes(rows.filter(shipped).select(*columns), path, 0)
    sinks.write_changes(rows.filter(~shipped).select(*columns), path, 1)
    return sinks.read_keyed(spark, path, ["id"], ["ts_ms", "sku_id", "split_total_amount"]).select(*columns)


@query("b4_olap_json_lines", using("log") + f"""
SELECT {bounds('ts', HOUR)}, item AS keyword, count(*) AS keyword_count FROM log
WHERE last_page_id = 'search' AND item_type = 'keyword' GROUP BY ALL""")
def b4_olap_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "keywords")
    found = logs.searches(T.app_log(spark, sf)).withColumnRenamed("fullword", "keyword")
    sinks.json_lines(windows.keyword_counts(found, "1 hour", "UTC"), path)
    return spark.read.schema("stt string, edt string, cur_date string, keyword string, keyword_count bigint").json(path)


@query("b8_bean_json", using("cart_info", d="""
  SELECT user_id, ts_ms // 86400000 AS d, min(ts_ms) AS ts_ms FROM cart_info GROUP BY ALL""") + f"""
SELECT '{{"stt":"' || stt || '","edt":"' || edt || '","cur_date":"' || cur_date || '","cart_add_uu_ct":' || n || '}}' AS value
FROM (SELECT {bounds('ts_ms', HOUR)}, count(*) AS n FROM d GROUP BY ALL)""")
def b8_bean_json(spark: SparkSession, sf: str) -> DataFrame:
    cart = C.cart_adds(T.cart_envelopes(spark, sf).withColumn("op", F.lit("r")))
    out = windows.cart_users(cart, "1 hour", "UTC").withColumnsRenamed(
        {"cur_date": "curDate", "cart_add_uu_ct": "cartAddUuCt"}).withColumn("ts", F.lit(0))
    return windows.snake_json(out)
