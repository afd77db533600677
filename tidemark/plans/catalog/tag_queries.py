"""Scoring models and label fusion over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scores as M
from tidemark.operators import logs, lookups, tags
from tidemark.plans import jobs
from tidemark.plans import standins as T
from tidemark.plans.catalog.changes import TODAY, USERS_SQL
from tidemark.plans.catalog.join_queries import (
    BRAND_LOOKUP, ORDER_DETAIL_JOIN, SEARCH_LOOKUP, brands, tree, user_join_sql,
)
from tidemark.plans.catalog.log_queries import DEVICE_SQL
from tidemark.plans.catalog.window_queries import PROFILES
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import using

DAY = 86_400_000


@T.once
def base2(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_device_search(T.app_log(spark, sf), tree(spark), T.category_compare(spark))


@T.once
def base4(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_orders(T.tag_change_log(spark, sf), brands(spark, sf), tree(spark), "UTC", skus=T.sku_info(spark, sf))


@T.once
def base6(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_user(T.tag_change_log(spark, sf), TODAY)


def table_sql(key: str, rows: dict[str, str], weight: str, band: int, otherwise: str | None) -> str:
    """A score table as CASE; scores in thousandths."""
    cases = "".join(f" WHEN {key} = '{k}' THEN {_milli(row, weight)[band]}" for k, row in rows.items())
    other = "NULL" if otherwise is None else str(_milli(otherwise, weight)[band])
    return f"CASE{cases} ELSE {other} END"


def _milli(row: str, weight: str) -> list[int]:
    return [int(v * 1000) for v in M.weighted(row, weight)]


def _bands(model: str, make) -> str:
    return ", ".join(f"{make(i)} AS {model}_{band}" for i, band in enumerate(M.BANDS))


CATEGORY_ROWS = {c: M.YOUNG_CATEGORY for c in M.YOUNG_CATEGORIES} | {c: M.HOME_CATEGORY for c in M.HOME_CATEGORIES}


def device_sql(key: str = "judge_os") -> str:
    return _bands("device", lambda i: table_sql(key, M.DEVICE, M.DEVICE_WEIGHT, i, None))


def search_sql(variant: bool = False) -> str:
    rows = M.SEARCH_VARIANT if variant else M.SEARCH
    return _bands("search", lambda i: table_sql("search_category", rows, M.SEARCH_WEIGHT, i, M.NO_SEARCH))


def pay_time_sql() -> str:
    return _bands("pay_time", lambda i: table_sql("pay_time_slot", M.PAY_TIME, M.TIME_WEIGHT, i, None))


def amount_sql() -> str:
    low, middle, high = (_milli(r, M.AMOUNT_WEIGHT) for r in (M.AMOUNT_LOW, M.AMOUNT_MIDDLE, M.AMOUNT_HIGH))
    amount = "coalesce(CAST(total_amount AS DECIMAL(18,4)), 0)"
    return _bands("amount", lambda i: (
        f"CASE WHEN {amount} < 1000 THEN {low[i]} WHEN {amount} > 1000 AND {amount} < 4000 THEN {middle[i]} ELSE {high[i]} END"))


def brand_sql() -> str:
    return _bands("tname", lambda i: (
        f"CASE WHEN tname IS NOT NULL THEN {table_sql('tname', M.BRAND, M.BRAND_WEIGHT, i, M.OTHER_BRAND)} END"))


def category_sql() -> str:
    return _bands("b1name", lambda i: (
        f"CASE WHEN b1_name IS NOT NULL THEN {table_sql('b1_name', CATEGORY_ROWS, M.CATEGORY_WEIGHT, i, M.OTHER_CATEGORY)} END"))


def milli(df: DataFrame, *models: str) -> DataFrame:
    """Score columns in thousandths, as integers."""
    names = [f"{m}_{b}" for m in models for b in M.BANDS]
    return df.withColumns({n: (F.col(n) * 1000).cast("int") for n in names})


BASE2 = {
    "d": f"SELECT DISTINCT * FROM ({DEVICE_SQL})",
    "profiles": PROFILES,
    "looked": SEARCH_LOOKUP,
    "base2": f"""
      SELECT * , {device_sql("split_part(os, ',', 1)")}, {search_sql()}, split_part(os, ',', 1) AS judge_os FROM looked""",
}
BASE4 = {
    "joined": f"""
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY ts_ms, split_total_amount,
        sku_id, sku_num, order_price, sku_name, split_activity_amount, split_coupon_amount) AS rn
      FROM ({ORDER_DETAIL_JOIN})) WHERE rn = 1""",
    "branded": BRAND_LOOKUP,
    "base4": f"SELECT *, {pay_time_sql()}, {amount_sql()}, {brand_sql()}, {category_sql()} FROM branded",
}
BASE6 = {"u": USERS_SQL, "base6": user_join_sql(5, "coalesce(gender, 'home')")}
NEEDS2 = ("log", "tree", "compare")
NEEDS4 = ("tag_order_info", "tag_order_detail", "brands", "tree")
NEEDS6 = ("user_info", "user_info_sup_msg")


@query("h1_device_scores", using(*NEEDS2, **BASE2) + f"""
SELECT uid, ts_ms, judge_os, {', '.join('device_' + b for b in M.BANDS)} FROM base2""")
def h1_device_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = base2(spark, sf)
    return milli(scored, "device").select("uid", "ts_ms", "judge_os", *[f"device_{b}" for b in M.BANDS])


_SEARCH = {"found": """
  SELECT l.uid, l.ts, l.os, c.search_category FROM (SELECT uid, ts, os, item AS search_item FROM log) l
  LEFT JOIN tree t ON l.search_item = t.b3name
  LEFT JOIN (SELECT category_name, arg_min(search_category, id) AS search_category FROM compare GROUP BY 1) c
    ON t.b1name = c.category_name"""}


def _searched(spark: SparkSession, sf: str) -> DataFrame:
    rows = logs.device_and_search(T.app_log(spark, sf)).select("uid", "ts", "os", "search_item")
    return lookups.search_category(rows, tree(spark), T.category_compare(spark))


@query("h2_search_scores", using(*NEEDS2, **_SEARCH) + f"SELECT uid, ts, search_category, {search_sql()} FROM found")
def h2_search_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = tags.score_device_and_search(_searched(spark, sf))
    return milli(scored, "search").select("uid", "ts", "search_category", *[f"search_{b}" for b in M.BANDS])


@query("h2b_search_scores_variant", using(*NEEDS2, **_SEARCH) + f"""
SELECT uid, ts, search_category, {search_sql(True)} FROM found""")
def h2b_search_scores_variant(spark: SparkSession, sf: str) -> DataFrame:
    scored = tags.score_device_and_search(_searched(spark, sf), variant=True)
    return milli(scored, "search").select("uid", "ts", "search_category", *[f"search_{b}" for b in M.BANDS])


def _order_scores(spark: SparkSession, sf: str, model: str, *extra: str) -> DataFrame:
    scored = base4(spark, sf)
    return milli(scored, model).select("detail_id", *extra, *[f"{model}_{b}" for b in M.BANDS])


def _order_sql(model: str, extra: str) -> str:
    return using(*NEEDS4, **BASE4) + f"SELECT detail_id, {extra}, {', '.join(f'{model}_{b}' for b in M.BANDS)} FROM base4"


@query("h3_pay_time_scores", _order_sql("pay_time", "pay_time_slot"))
def h3_pay_time_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _order_scores(spark, sf, "pay_time", "pay_time_slot")


@query("h4_amount_scores", _order_sql("amount", "total_amount"))
def h4_amount_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _order_scores(spark, sf, "amount", "total_amount")


@query("h5_brand_scores", _order_sql("tname", "tname"))
def h5_brand_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _order_scores(spark, sf, "tname", "tname")


@query("h6_category_scores", _order_sql("b1name", "b1_name"))
def h6_category_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _order_scores(spark, sf, "b1name", "b1_name")


_MODELS = ["device", "search", "pay_time", "amount", "tname", "b1name"]


def sum_sql(band: str, models: list[str] = _MODELS) -> str:
    return "(" + " + ".join(f"coalesce({m}_{band}, 0)" for m in models) + ")"


def pairs_sql(bound: int, logs: str = "base2", orders: str = "base4") -> str:
    sums = ", ".join(f"{sum_sql(b)} AS sum_{b}" for b in M.BANDS)
    as_written = ", ".join(
        f"{sum_sql(b, _MODELS[2:] if b in tags.ORDER_ONLY_BANDS else _MODELS[:2] if b in tags.LOG_ONLY_BANDS else _MODELS)} AS written_{b}"
        for b in M.BANDS)
    return f"""
  SELECT l.uid, l.ts_ms, pv, os, ch, md, ba, search_item, judge_os, detail_id, consignee, pay_time_slot, sku_name, sku_id, tname,
    b1_name, o.ts_ms AS order_ts_ms, {sums}, {as_written}
  FROM {logs} l JOIN {orders} o ON l.uid = o.uid WHERE o.ts_ms BETWEEN l.ts_ms - {bound} AND l.ts_ms + {bound}"""


_ALL = tuple(dict.fromkeys(NEEDS2 + NEEDS4 + NEEDS6))
FUSED = BASE2 | BASE4 | BASE6 | {"pairs": pairs_sql(DAY)}
_BEST = "greatest(" + ", ".join(f"sum_{b}" for b in M.BANDS) + ")"
LEVEL_SQL = "CASE " + " ".join(f"WHEN sum_{b} = {_BEST} THEN '{b}'" for b in M.BANDS) + " END"
BEST_NAME = "CASE " + " ".join(f"WHEN sum_{b} = {_BEST} THEN 'sum_{b}_score'" for b in M.BANDS) + " END"


@T.once
def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return tags.join_log_and_orders(base2(spark, sf), base4(spark, sf), DAY)


@query("h7_band_names", using(*_ALL, **FUSED) + f"""
SELECT uid, ts_ms, {', '.join('count(' + m + '_' + b + ') AS n_' + m + '_' + b for m in _MODELS[2:] for b in M.BANDS)}
FROM base4 GROUP BY uid, ts_ms""")
def h7_band_names(spark: SparkSession, sf: str) -> DataFrame:
    """Order-side scores under the same underscore names as the log side."""
    names = [f"{m}_{b}" for m in tags.ORDER_MODELS for b in M.BANDS]
    return base4(spark, sf).groupBy("uid", "ts_ms").agg(*[F.count(n).alias(f"n_{n}") for n in names])


@query("h8_age_level", using(*_ALL, **FUSED) + f"SELECT uid, ts_ms, sku_id, {LEVEL_SQL} AS \"ageLevel\" FROM pairs")
def h8_age_level(spark: SparkSession, sf: str) -> DataFrame:
    return tags.age_level(pairs(spark, sf)).select("uid", "ts_ms", "sku_id", "ageLevel")


@query("h9_band_sums", using(*_ALL, **FUSED) + f"""
SELECT uid, ts_ms, sku_id, {', '.join(f'CAST(sum_{b} AS INT) AS sum_{b}_score' for b in M.BANDS)} FROM pairs""")
def h9_band_sums(spark: SparkSession, sf: str) -> DataFrame:
    return _milli_sums(tags.band_sums(pairs(spark, sf)))


def _milli_sums(df: DataFrame) -> DataFrame:
    names = [f"sum_{b}_score" for b in M.BANDS]
    return df.select("uid", "ts_ms", "sku_id", *[(F.col(n) * 1000).cast("int").alias(n) for n in names])


@query("h9_band_sums_as_written", using(*_ALL, **FUSED) + f"""
SELECT uid, ts_ms, sku_id, {', '.join(f'CAST(written_{b} AS INT) AS sum_{b}_score' for b in M.BANDS)} FROM pairs""")
def h9_band_sums_as_written(spark: SparkSession, sf: str) -> DataFrame:
    return _milli_sums(tags.band_sums(pairs(spark, sf), compat=True))


@query("h10_max_score", using(*_ALL, **FUSED) + f"""
SELECT uid, ts_ms, sku_id, {BEST_NAME} AS name, CAST({_BEST} AS INT) AS best FROM pairs WHERE {_BEST} > 0""")
def h10_max_score(spark: SparkSession, sf: str) -> DataFrame:
    best = tags.max_score(tags.band_sums(pairs(spark, sf)))
    # An outer one: of the other, Spark makes a filter of the join that works out the highest sum for each pair once more.
    named = best.select("uid", "ts_ms", "sku_id", F.explode_outer("calculate_age").alias("name", "_v")).filter("name IS NOT NULL")
    return named.select("uid", "ts_ms", "sku_id", "name", (F.col("_v") * 1000).cast("int").alias("best"))


LABEL_SQL = using(*_ALL, **FUSED) + f"""
SELECT p.uid, consignee AS uname, b.ts_ms, strftime(make_timestamp(b.ts_ms * 1000), '%Y%m%d') AS ds, decade, zodiac_sign, gender,
  height, judge_os, birthday, age AS base_age, pv AS intraday_pv, search_item, os, ch, md, ba, pay_time_slot AS login_time_slot,
  CAST(sum_30_34 AS INT) AS age_sum30_40, CAST(sum_50 AS INT) AS age_sum50, {BEST_NAME} AS best_name, sku_name, b1_name, tname,
  CAST(sku_id AS VARCHAR) AS sku_id
FROM pairs p JOIN base6 b ON p.uid = b.uid
WHERE b.ts_ms BETWEEN greatest(p.ts_ms, p.order_ts_ms) - {DAY} AND greatest(p.ts_ms, p.order_ts_ms) + {DAY}"""


def flat_labels(df: DataFrame) -> DataFrame:
    base, calc = F.col("user_base_label"), F.col("user_calculate_label")
    info = calc["computer_age_info"]
    return df.select(
        "uid", "uname", "ts_ms", "ds",
        *[base[c].alias(c) for c in ("decade", "zodiac_sign", "gender", "height", "judge_os", "birthday", "base_age")],
        "user_log_label.intraday_pv", "user_log_label.search_item", "user_device_label.os", "user_device_label.ch",
        "user_device_label.md", "user_device_label.ba", "user_device_label.login_time_slot",
        (info["age_sum30_40"] * 1000).cast("int").alias("age_sum30_40"),
        (info["age_sum50"] * 1000).cast("int").alias("age_sum50"),
        F.map_keys(calc["calculate_age"])[0].alias("best_name"),
        "sup_info_message.sku_name", "sup_info_message.b1_name", "sup_info_message.tname", "sup_info_message.sku_id")


@query("h11_user_label", LABEL_SQL)
def h11_user_label(spark: SparkSession, sf: str) -> DataFrame:
    """The label record, flattened. One-day bounds, since the stand-in events are sparse."""
    return flat_labels(jobs.tag_label(base2(spark, sf), base4(spark, sf), base6(spark, sf), "UTC", DAY))


@query("d11_log_order_interval", using(*_ALL, **FUSED) + "SELECT uid, ts_ms, os, pay_time_slot, sku_id FROM pairs")
def d11_log_order_interval(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("uid", "ts_ms", "os", "pay_time_slot", "sku_id")


AGE_LEVEL_SQL = using(*_ALL, **FUSED) + f"""
SELECT p.uid, {LEVEL_SQL} AS "ageLevel", b.* EXCLUDE (uid) FROM pairs p JOIN base6 b ON p.uid = b.uid
WHERE b.ts_ms BETWEEN p.ts_ms - {DAY} AND p.ts_ms + {DAY}"""


@query("d12_age_level_user_interval", AGE_LEVEL_SQL)
def d12_age_level_user_interval(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.tag_age_level(base2(spark, sf), base4(spark, sf), base6(spark, sf))


@query("d13_label_interval_hour", using(*_ALL, **(BASE2 | BASE4 | BASE6 | {"pairs": pairs_sql(3_600_000)})) + f"""
SELECT p.uid, p.ts_ms, sku_id, {', '.join(f'CAST(sum_{b} AS INT) AS sum_{b}_score' for b in M.BANDS)} FROM pairs p""")
def d13_label_interval_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The first of the two one-hour joins, with its band sums."""
    hour = tags.join_log_and_orders(
        base2(spark, sf), base4(spark, sf), 3_600_000)
    return _milli_sums(tags.band_sums(hour))


#: Times folded into so many milliseconds, so that one-hour joins find partners.
DENSE = 6 * 3_600_000
_FOLD = f"SELECT * REPLACE (ts_ms % {DENSE} AS ts_ms) FROM"


@query("d13_label_two_hour_joins", using(*_ALL, **(BASE2 | BASE4 | BASE6 | {
    "l2": f"{_FOLD} base2", "o4": f"{_FOLD} base4", "u6": f"{_FOLD} base6", "pairs": pairs_sql(3_600_000, "l2", "o4")})) + f"""
SELECT p.uid, b.ts_ms, p.sku_id, gender, search_item, CAST(sum_30_34 AS INT) AS age_sum30_40, {BEST_NAME} AS best_name
FROM pairs p JOIN u6 b ON p.uid = b.uid
WHERE b.ts_ms BETWEEN greatest(p.ts_ms, p.order_ts_ms) - 3600000 AND greatest(p.ts_ms, p.order_ts_ms) + 3600000""")
def d13_label_two_hour_joins(spark: SparkSession, sf: str) -> DataFrame:
    """Both one-hour joins, the second on the later time of the first."""
    fold = lambda df: df.withColumn("ts_ms", F.col("ts_ms") % DENSE)
    out = flat_labels(jobs.tag_label(fold(base2(spark, sf)), fold(base4(spark, sf)), fold(base6(spark, sf)), "UTC", 3_600_000))
    return out.select("uid", "ts_ms", F.col("sku_id").cast("bigint").alias("sku_id"), "gender", "search_item", "age_sum30_40", "best_name")
