"""Scalar functions over whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.windows import bound_columns
from tidemark.plans import standins as T
from tidemark.plans.catalog.changes import TODAY, ZODIAC_SQL
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import dt, ms, using
from tidemark.schemas import APP_LOG
from tidemark.sources.cdc import to_values

_EVENTS_MS = f"(SELECT event_id, {ms('ts')} AS m FROM events)"
_BIRTH = "(SELECT c_custkey, DATE '1970-01-01' + CAST(3000 + c_custkey * 13 % 9000 AS INT) AS b FROM customer)"


def _events(spark, sf) -> DataFrame:
    return T.table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("m"))


def _birthdays(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return T.table(spark, sf, "customer").select("c_custkey", S.epoch_day_to_date(F.lit(3000) + key * 13 % 9000).alias("b"))


@query("e1_epoch_format", f"""
SELECT event_id, strftime(t, '%Y-%m-%d') AS d, strftime(t, '%Y-%m-%d %H:%M:%S') AS dt, strftime(t, '%Y%m%d') AS compact
FROM (SELECT event_id, make_timestamp((m + 28800000) * 1000) AS t FROM {_EVENTS_MS})""")
def e1_epoch_format(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("m")
    return _events(spark, sf).select(
        "event_id", S.ms_to_date(m).alias("d"), S.ms_to_datetime(m).alias("dt"), S.ms_to_compact_date(m).alias("compact"))


@query("e2_text_to_epoch", f"""
SELECT event_id, m // 1000 * 1000 - 28800000 AS from_datetime, m // 86400000 * 86400000 - 28800000 AS from_date FROM {_EVENTS_MS}""")
def e2_text_to_epoch(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("m")
    return _events(spark, sf).select(
        "event_id", S.text_to_ms(S.ms_to_datetime(m, "UTC")).alias("from_datetime"),
        S.text_to_ms(S.ms_to_date(m, "UTC")).alias("from_date"))


@query("e3_compact_day", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS day_int FROM orders")
def e3_compact_day(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "orders").select("o_orderkey", S.compact_date_int(F.to_date("o_orderdate")).alias("day_int"))


@query("e4_date_id", using("order_info") + """
SELECT id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS date_id FROM order_info""")
def e4_date_id(spark: SparkSession, sf: str) -> DataFrame:
    return T.order_info(spark, sf).select("id", S.date_id(F.col("create_time"), "UTC").alias("date_id"))


@query("e5_epoch_day", f"SELECT c_custkey, strftime(b, '%Y-%m-%d') AS birthday FROM {_BIRTH}")
def e5_epoch_day(spark: SparkSession, sf: str) -> DataFrame:
    return _birthdays(spark, sf).select("c_custkey", F.date_format("b", "yyyy-MM-dd").alias("birthday"))


@query("e6_age", f"""
SELECT c_custkey, CAST(2024 - year(b) - CASE WHEN month(b) * 100 + day(b) > 615 THEN 1 ELSE 0 END AS INT) AS age FROM {_BIRTH}""")
def e6_age(spark: SparkSession, sf: str) -> DataFrame:
    return _birthdays(spark, sf).select("c_custkey", S.age_years(F.col("b"), F.lit(TODAY).cast("date")).alias("age"))


@query("e7_decade", f"SELECT c_custkey, CAST(year(b) // 10 * 10 AS INT) AS decade FROM {_BIRTH}")
def e7_decade(spark: SparkSession, sf: str) -> DataFrame:
    return _birthdays(spark, sf).select("c_custkey", S.decade(F.col("b")).alias("decade"))


@query("e8_zodiac", f"""
SELECT c_custkey, {ZODIAC_SQL} AS sign, CASE WHEN md = 1023 THEN '天秤座' ELSE {ZODIAC_SQL} END AS sign_variant
FROM (SELECT *, month(b) * 100 + day(b) AS md FROM {_BIRTH})""")
def e8_zodiac(spark: SparkSession, sf: str) -> DataFrame:
    b = F.col("b")
    return _birthdays(spark, sf).select(
        "c_custkey", S.zodiac(b).alias("sign"), S.zodiac(b, late_scorpio=True).alias("sign_variant"))


@query("e9_pay_slot", f"""
SELECT event_id, CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
  WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END AS slot
FROM (SELECT event_id, (m + 28800000) // 3600000 % 24 AS h FROM {_EVENTS_MS})""")
def e9_pay_slot(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select("event_id", S.pay_slot(F.col("m")).alias("slot"))


@query("e10_map_element", using("order_detail") + "SELECT id, sku_id, 'order_detail' AS table_name, CAST(NULL AS VARCHAR) AS missing FROM order_detail")
def e10_map_element(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.cdc_snapshot(T.order_detail(spark, sf), "order_detail")
    after = F.col("after")
    return rows.select(
        after["id"].alias("id"), after["sku_id"].alias("sku_id"), F.col("source")["table"].alias("table_name"),
        after["no such field"].alias("missing"))


@query("e11_casts", using("order_detail") + """
SELECT id, ts_ms, CAST(sku_num AS INT) AS n, CAST(CAST(CAST(sku_num AS DECIMAL(16,2)) * CAST(order_price AS DECIMAL(16,2))
  AS DECIMAL(33,4)) AS VARCHAR) AS product, TRY_CAST(source_type AS INT) AS bad,
  CASE WHEN CAST(sku_num AS INT) > 25 THEN 'many' ELSE 'few' END AS size_class FROM order_detail""")
def e11_casts(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("sku_num").try_cast("int")
    return T.order_detail(spark, sf).select(
        "id", "ts_ms", n.alias("n"), S.product_text(F.col("sku_num"), F.col("order_price")).alias("product"),
        F.col("source_type").try_cast("int").alias("bad"), F.when(n > 25, "many").otherwise("few").alias("size_class"))


@query("e12_round_half_up", """
SELECT event_id, (CAST(round(value * 100) AS BIGINT) * 125 + 50) // 100 AS thousandths FROM events WHERE value >= 0
UNION ALL SELECT event_id, -((CAST(round(-value * 100) AS BIGINT) * 125 + 50) // 100) FROM events WHERE value < 0""")
def e12_round_half_up(spark: SparkSession, sf: str) -> DataFrame:
    exact = F.round(F.col("value") * 100).cast("bigint").cast("decimal(18,0)") * F.lit("0.00125").cast("decimal(6,5)")
    return T.table(spark, sf, "events").select(
        "event_id", (S.round_half_up(exact) * 1000).cast("bigint").alias("thousandths"))


@query("e13_json_access", using("log") + """
SELECT mid, page_id, during_time, has_err, ts FROM log""")
def e13_json_access(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, read nested fields, remove one, add one, serialise and read again."""
    log = to_values(T.app_log(spark, sf)).select(F.from_json("value", APP_LOG).alias("r")).select("r.*")
    changed = log.select(
        F.col("common").withField("has_err", F.col("err").isNotNull()).dropFields("sid").alias("common"), "page", "ts")
    text = to_values(changed).select(
        F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.page.page_id").alias("page_id"),
        F.get_json_object("value", "$.page.during_time").cast("bigint").alias("during_time"),
        F.get_json_object("value", "$.common.has_err").cast("boolean").alias("has_err"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))
    return text


@query("e14_json_array_explode", using("log") + """
SELECT mid, ts, CAST(unnest(generate_series(1, entries)) AS VARCHAR) AS pos_id FROM log""")
def e14_json_array_explode(spark: SparkSession, sf: str) -> DataFrame:
    log = to_values(T.app_log(spark, sf)).select(F.from_json("value", APP_LOG).alias("r"))
    return log.select("r.common.mid", "r.ts", F.explode("r.displays").alias("d")).select(
        "mid", "ts", F.col("d")["pos_id"].alias("pos_id"))


@query("e15_record_merge", using("user_info") + """
SELECT id, name, 'merged' AS note, user_level AS level FROM user_info""")
def e15_record_merge(spark: SparkSession, sf: str) -> DataFrame:
    left = F.create_map(F.lit("name"), F.col("name"), F.lit("note"), F.lit("left"))
    right = F.create_map(F.lit("note"), F.lit("merged"), F.lit("level"), F.col("user_level"))
    both = T.user_info(spark, sf).select("id", S.merged(left, right).alias("m"))
    m = F.col("m")
    return both.select("id", m["name"].alias("name"), m["note"].alias("note"), m["level"].alias("level"))


@query("e16_text_operations", using("log", distinct_="SELECT DISTINCT os, md, sid FROM log") + """
SELECT sid, os, split_part(os, ' ', 1) AS first, md || ',' || os AS both, replace(os || '-x', '-', '_') AS snake FROM distinct_""")
def e16_text_operations(spark: SparkSession, sf: str) -> DataFrame:
    os = F.col("os")
    rows = T.app_log(spark, sf).select("common.os", "common.md", "common.sid").distinct()
    return rows.select(
        "sid", "os", S.first_token(os).alias("first"), S.joined(F.array("md", "os")).alias("both"),
        F.replace(F.concat(os, F.lit("-x")), F.lit("-"), F.lit("_")).alias("snake"))


@query("e17_empty_test", using("user_info") + "SELECT id, gender IS NULL AS no_gender, false AS no_name FROM user_info")
def e17_empty_test(spark: SparkSession, sf: str) -> DataFrame:
    return T.user_info(spark, sf).select(
        "id", S.is_empty(F.col("gender")).alias("no_gender"), S.is_empty(F.col("name")).alias("no_name"))


@query("e18_name_styles", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def e18_name_styles(spark: SparkSession, sf: str) -> DataFrame:
    """Snake to camel and back."""
    rows = T.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    camel = rows.withColumnsRenamed({c: S.snake_to_camel(c) for c in rows.columns})
    return camel.withColumnsRenamed({c: S.camel_to_snake(c) for c in camel.columns})


@query("e19_negate", """
SELECT c_custkey, -CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer""")
def e19_negate(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return T.table(spark, sf, "customer").select("c_custkey", S.negated(amount).alias("cents"))


@query("f10_window_bounds", using("log") + f"""
SELECT ts, {dt('ts // 10000 * 10000')} AS stt, {dt('ts // 10000 * 10000 + 10000')} AS edt,
  strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS cur_date FROM log""")
def f10_window_bounds(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.app_log(spark, sf).select("ts", F.window(F.timestamp_millis("ts"), "10 seconds").alias("window"))
    return rows.select("ts", *bound_columns("UTC"))
