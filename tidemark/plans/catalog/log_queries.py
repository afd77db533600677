"""App-log parsing, splitting, filters and projections over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.tokens import register_tokens
from tidemark.operators import keyed
from tidemark.operators import logs as L
from tidemark.plans import standins as T
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import using
from tidemark.session import new_path

HEAD = ["common.mid", "page.page_id"]
_CLEAN = "ts % 89 <> 0 AND ts % 97 <> 0"


@query("c9_dirty_rows", using("log") + """
SELECT '{"ts": ' || ts AS value FROM log WHERE ts % 89 <> 0 AND ts % 97 = 0""")
def c9_dirty_rows(spark: SparkSession, sf: str) -> DataFrame:
    return L.dirty_rows(T.log_topic(spark, sf))


@query("c10_json_parse", using("log") + f"""
SELECT mid, page_id, during_time, is_new, ts FROM log WHERE {_CLEAN}""")
def c10_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    return L.parsed_log(T.log_topic(spark, sf)).select(
        *HEAD, "page.during_time", F.col("common.is_new").alias("is_new"), "ts")


@query("c11a_error_log", using("log") + f"""
SELECT mid, page_id, CAST(event_id % 500 + 1000 AS VARCHAR) AS error_code, entries AS n_displays, ts FROM log
WHERE has_err AND {_CLEAN}""")
def c11a_error_log(spark: SparkSession, sf: str) -> DataFrame:
    return L.error_log(L.parsed_log(T.log_topic(spark, sf))).select(
        *HEAD, F.col("err")["error_code"].alias("error_code"), F.size("displays").cast("bigint").alias("n_displays"), "ts")


@query("c11b_start_log", using("log") + """
SELECT mid, CAST(event_id % 1000 AS VARCHAR) AS loading_time, ts FROM log WHERE has_start""")
def c11b_start_log(spark: SparkSession, sf: str) -> DataFrame:
    return L.start_log(T.app_log(spark, sf)).select(
        F.col("common.mid").alias("mid"), F.col("start")["loading_time"].alias("loading_time"), "ts")


@query("c11c_display_log", using("log") + """
SELECT mid, page_id, CAST(event_id % 100 AS VARCHAR) AS item, CAST(unnest(generate_series(1, entries)) AS VARCHAR) AS pos_id, ts
FROM log WHERE NOT has_start""")
def c11c_display_log(spark: SparkSession, sf: str) -> DataFrame:
    show = F.col("display")
    return L.display_log(T.app_log(spark, sf)).select(*HEAD, show["item"].alias("item"), show["pos_id"].alias("pos_id"), "ts")


@query("c11d_action_log", using("log") + """
SELECT mid, page_id, 'cart_add' AS action_id, CAST(unnest(generate_series(1, entries)) AS VARCHAR) AS item
FROM log WHERE NOT has_start""")
def c11d_action_log(spark: SparkSession, sf: str) -> DataFrame:
    act = F.col("action")
    return L.action_log(T.app_log(spark, sf)).select(*HEAD, act["action_id"].alias("action_id"), act["item"].alias("item"))


@query("c11e_page_log", using("log") + "SELECT mid, page_id, last_page_id, ts FROM log WHERE NOT has_start")
def c11e_page_log(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_log(T.app_log(spark, sf)).select(*HEAD, "page.last_page_id", "ts")


@query("c11f_five_way_split", using("log", p="SELECT * FROM log WHERE NOT has_start") + """
SELECT 'err' AS output, count(*) AS n FROM log WHERE has_err UNION ALL SELECT 'start', count(*) FROM log WHERE has_start
UNION ALL SELECT 'display', CAST(sum(entries) AS BIGINT) FROM p UNION ALL SELECT 'action', CAST(sum(entries) AS BIGINT) FROM p
UNION ALL SELECT 'page', count(*) FROM p""")
def c11f_five_way_split(spark: SparkSession, sf: str) -> DataFrame:
    """All five outputs written to their folders in one pass, and counted back."""
    path = new_path(spark, "split")
    L.tagged_outputs(T.app_log(spark, sf)).write.partitionBy("output").parquet(path)
    return spark.read.parquet(path).groupBy("output").agg(F.count(F.lit(1)).alias("n"))


@query("c14_page_filter", using("log") + "SELECT mid, page_id, ts FROM log WHERE page_id IN ('home', 'good_detail')")
def c14_page_filter(spark: SparkSession, sf: str) -> DataFrame:
    return L.on_pages(T.app_log(spark, sf), "home", "good_detail").select(*HEAD, "ts")


@query("c15_login_filter", using("log") + """
SELECT uid, last_page_id, ts FROM log WHERE last_page_id = 'login' OR last_page_id IS NULL""")
def c15_login_filter(spark: SparkSession, sf: str) -> DataFrame:
    return L.logins(T.app_log(spark, sf)).select(F.col("common.uid").alias("uid"), "page.last_page_id", "ts")


@query("c16_search_filter", using("log") + """
SELECT item AS fullword, ts FROM log WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL""")
def c16_search_filter(spark: SparkSession, sf: str) -> DataFrame:
    return L.searches(T.app_log(spark, sf))


DEVICE_SQL = """SELECT uid, ts, vc, ch, ar, split_part(os, ' ', 1) AS os, md, ba, item AS search_item FROM log"""


@query("c17_device_search", using("log") + DEVICE_SQL)
def c17_device_search(spark: SparkSession, sf: str) -> DataFrame:
    return L.device_and_search(T.app_log(spark, sf))


@query("c24_page_measures", using("log") + """
SELECT mid, vc, ch, ar, is_new, ts, CAST(last_page_id IS NULL AS BIGINT) AS sv, CAST(1 AS BIGINT) AS pv, during_time AS dur
FROM log""")
def c24_page_measures(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_measures(T.app_log(spark, sf))


@query("g1_is_new_repair", using("log", s="""
  SELECT mid, CASE WHEN is_new = '1' THEN d ELSE d - 1 END AS stored FROM (
    SELECT *, ts // 86400000 AS d, row_number() OVER (PARTITION BY mid ORDER BY ts, is_new) AS rn FROM log) WHERE rn = 1""") + """
SELECT mid, ts, CASE WHEN is_new = '1' AND ts // 86400000 <> stored THEN '0' ELSE is_new END AS is_new
FROM log JOIN s USING (mid)""")
def g1_is_new_repair(spark: SparkSession, sf: str) -> DataFrame:
    return L.repair_is_new(T.app_log(spark, sf), "UTC").select(
        F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new"))


@query("g8_whole_record_dedup", using("log") + f"SELECT DISTINCT * FROM ({DEVICE_SQL})")
def g8_whole_record_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every record sent twice."""
    rows = L.device_and_search(T.app_log(spark, sf))
    return keyed.drop_repeats(rows.unionByName(rows))


_WORDS = """
SELECT keyword, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS keyword FROM documents) GROUP BY keyword"""


@query("j1_keyword_explode", _WORDS)
def j1_keyword_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of whole documents, counted."""
    words = L.words(T.table(spark, sf, "documents"), "text")
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


@query("j1_keyword_lateral", """
SELECT keyword, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}]+')) AS keyword FROM part) GROUP BY keyword""")
def j1_keyword_lateral(spark: SparkSession, sf: str) -> DataFrame:
    """The table-function form, called with LATERAL."""
    register_tokens(spark, "tokens")
    T.table(spark, sf, "part").createOrReplaceTempView("part_names")
    return spark.sql("""
        SELECT t.word AS keyword, count(*) AS n FROM part_names, LATERAL tokens(p_name) AS t GROUP BY t.word""")
