"""User tagging: projections, the six scoring models and their fusion into one label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions import scores as M
from tidemark.operators.intervals import HOUR, interval_join

# -- projections of the change log ----------------------------------------------------------------------


def _rows(envelopes: DataFrame, table: str) -> DataFrame:
    return envelopes.filter((F.col("source")["table"] == table) & F.col("after").isNotNull())


def _whole(name: str) -> Column:
    return F.coalesce(F.col("after")[name].try_cast("bigint"), F.lit(0).cast("bigint"))


def order_rows(envelopes: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Orders with the slot of day they were paid in."""
    after = F.col("after")
    return _rows(envelopes, "order_info").select(
        after["id"].alias("id"), after["user_id"].alias("uid"), after["consignee"].alias("consignee"),
        _whole("create_time").alias("create_time"), after["original_total_amount"].alias("original_total_amount"),
        after["total_amount"].alias("total_amount"), _whole("province_id").alias("province_id"),
        S.pay_slot(_whole("create_time"), tz).alias("pay_time_slot"), "ts_ms")


def detail_rows(envelopes: DataFrame) -> DataFrame:
    after = F.col("after")
    texts = ["split_coupon_amount", "sku_name", "order_price", "id", "order_id", "split_activity_amount", "split_total_amount"]
    sku_num = F.coalesce(after["sku_num"].try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))
    return _rows(envelopes, "order_detail").select(
        sku_num.alias("sku_num"), _whole("create_time").alias("create_time"), _whole("sku_id").alias("sku_id"),
        *[after[t].alias(t) for t in texts], "ts_ms")


def user_rows(
    envelopes: DataFrame, today: Column | str, default_gender: str | None = "home", nick_name: bool = False,
    late_scorpio: bool = False,
) -> DataFrame:
    """Users with birthday, age on ``today`` (a date or its text), decade and zodiac sign."""
    after = F.col("after")
    today = F.lit(today).cast("date")
    born = S.epoch_day_to_date(after["birthday"].try_cast("int"))
    gender = after["gender"] if default_gender is None else F.coalesce(after["gender"], F.lit(default_gender))
    nick = [after["nick_name"].alias("nick_name")] if nick_name else []
    return _rows(envelopes, "user_info").select(
        after["id"].alias("uid"), after["name"].alias("uname"), *nick, after["user_level"].alias("user_level"),
        after["login_name"].alias("login_name"), after["phone_num"].alias("phone_num"), after["email"].alias("email"),
        gender.alias("gender"), F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        S.age_years(born, today).alias("age"), S.decade(born).alias("decade"),
        S.zodiac(born, late_scorpio).alias("zodiac_sign"), "ts_ms")


def supplement_rows(envelopes: DataFrame) -> DataFrame:
    after = F.col("after")
    texts = ["uid", "unit_height", "height", "unit_weight", "weight"]
    return _rows(envelopes, "user_info_sup_msg").select(
        *[after[t].alias(t) for t in texts], after["create_ts"].try_cast("bigint").alias("create_ts"), "ts_ms")


# -- scoring ----------------------------------------------------------------------------------------------


def score_device_and_search(df: DataFrame, variant: bool = False) -> DataFrame:
    """Add ``judge_os``, device and search scores. Needs ``os`` (comma list) and ``search_category``."""
    search = M.search_scores("search_category", variant)
    if variant:  # this job passes a record without an operating system on unscored
        search = F.when(~S.is_empty(F.col("os")), search)
    judged = df.withColumn("judge_os", S.first_token(F.col("os"), ","))
    return judged.select("*", M.device_scores("judge_os").alias("_d"), search.alias("_s")).select(
        *judged.columns, *M.as_columns("_d", "device"), *M.as_columns("_s", "search"))


def score_orders(df: DataFrame) -> DataFrame:
    """Add pay-time, amount, brand and category scores. Needs ``pay_time_slot``, ``total_amount``, ``tname``, ``b1_name``."""
    priced = df.withColumn("_amount", F.col("total_amount").try_cast("decimal(18,4)"))
    return priced.select(
        *df.columns, M.pay_time_scores("pay_time_slot").alias("_t"), M.amount_scores("_amount").alias("_a"),
        M.brand_scores("tname").alias("_b"), M.category_scores("b1_name").alias("_c"),
    ).select(
        *df.columns, *M.as_columns("_t", "pay_time"), *M.as_columns("_a", "amount"), *M.as_columns("_b", "tname"),
        *M.as_columns("_c", "b1name"))


LOG_MODELS = ["device", "search"]
ORDER_MODELS = ["pay_time", "amount", "tname", "b1name"]
# The bands whose sum, as written, misses the device and search part or the order part.
ORDER_ONLY_BANDS = ["25_29", "30_34"]
LOG_ONLY_BANDS = ["35_39", "40_49"]


def _sum(models: list[str], band: str) -> Column:
    parts = " + ".join(f"coalesce(`{model}_{band}`, CAST(0 AS {M.SCORE}))" for model in models)
    return F.expr(f"CAST({parts} AS decimal(6,3))")


#: The two halves of a band's sum, by the record they come from.
_HALVES = {"_log": LOG_MODELS, "_order": ORDER_MODELS}


def _half_sums(half: str) -> list[Column]:
    return [_sum(_HALVES[half], band).alias(f"{half}_{band}") for band in M.BANDS]


def _band_sum(df: DataFrame, band: str, halves: list[str] | None = None) -> Column:
    """A band's sum, from its half sums where the rows hold them, else from the single scores."""
    halves = halves or list(_HALVES)
    if all(f"{half}_{band}" in df.columns for half in _HALVES):
        return F.expr(f"CAST({' + '.join(f'`{half}_{band}`' for half in halves)} AS decimal(6,3))")
    return _sum([model for half in halves for model in _HALVES[half]], band)


def band_sums(df: DataFrame, compat: bool = False) -> DataFrame:
    """Add ``sum_<band>_score`` over the six models; ``compat`` leaves out what mixed key spelling misses."""
    sums = {}
    for band in M.BANDS:
        halves = list(_HALVES)
        if compat and band in ORDER_ONLY_BANDS:
            halves = ["_order"]
        elif compat and band in LOG_ONLY_BANDS:
            halves = ["_log"]
        sums[f"sum_{band}_score"] = _band_sum(df, band, halves)
    return df.withColumns(sums)


def _highest(totals: dict[str, Column]) -> Column:
    """(total, name) of the highest total; the first one wins ties."""
    return F.greatest(*[
        F.struct(total.alias("total"), F.lit(-i).alias("place"), F.lit(name).alias("name")) for i, (name, total) in enumerate(totals.items())])


def age_level(df: DataFrame) -> DataFrame:
    """The band with the highest sum; the first one wins ties."""
    return df.withColumn("ageLevel", _highest({band: _band_sum(df, band) for band in M.BANDS})["name"])


def max_score(df: DataFrame) -> DataFrame:
    """Add ``calculate_age``: {name: value} of the highest positive band sum, or an empty map."""
    best = F.col("_best")
    empty = F.create_map().cast("map<string,decimal(6,3)>")
    picked = df.withColumn("_best", _highest({n: F.col(n) for n in (f"sum_{band}_score" for band in M.BANDS)}))
    age = F.when(best["total"] > 0, F.create_map(best["name"], best["total"])).otherwise(empty)
    return picked.withColumn("calculate_age", age).drop("_best")


# -- fusion -------------------------------------------------------------------------------------------------

_SCORE_COLUMNS = [f"{m}_{b}" for m in LOG_MODELS + ORDER_MODELS for b in M.BANDS]
_LOG_COLUMNS = ["pv", "os", "ch", "md", "ba", "search_item", "judge_os"]
_ORDER_COLUMNS = ["consignee", "pay_time_slot", "sku_name", "sku_id", "tname", "b1_name"]
_USER_COLUMNS = [
    "decade", "zodiac_sign", "gender", "login_name", "email", "phone_num", "height", "weight", "user_level", "birthday",
    "age",
]


def join_log_and_orders(base2: DataFrame, base4: DataFrame, bound: int) -> DataFrame:
    """Scored log rows joined to scored order rows of the same user within ``bound``; the time is the log row's.

    Each side brings its half of the band sums, which are then not added up anew for each pair, nor are the scores behind them moved.
    """
    left = base2.select(
        "uid", "ts_ms", *_LOG_COLUMNS, *[c for c in _SCORE_COLUMNS if c.startswith(("device", "search"))], *_half_sums("_log"))
    right = base4.select(
        "uid", F.col("ts_ms").alias("order_ts_ms"), *_ORDER_COLUMNS,
        *[c for c in _SCORE_COLUMNS if not c.startswith(("device", "search"))], *_half_sums("_order"))
    return interval_join(left, right, "uid", "ts_ms", "order_ts_ms", bound, bound, "left")


def user_age_levels(base2: DataFrame, base4: DataFrame, base6: DataFrame, bound: int = 24 * HOUR) -> DataFrame:
    """Age level of a user's log and order rows, merged into the user record."""
    levels = age_level(join_log_and_orders(base2, base4, bound)).select(
        "uid", F.col("ts_ms").alias("level_ts_ms"), "ageLevel")
    return interval_join(levels, base6, "uid", "level_ts_ms", "ts_ms", bound, bound).drop("level_ts_ms")


def user_labels(
    base2: DataFrame, base4: DataFrame, base6: DataFrame, bound: int = HOUR, tz: str = S.BUSINESS_TZ,
    compat: bool = False,
) -> DataFrame:
    """The final label record per matching log, order and user row. A joined log and order row has the later of its two times."""
    pairs = max_score(band_sums(join_log_and_orders(base2, base4, bound), compat))
    scored = pairs.withColumn("pair_ts_ms", F.greatest("ts_ms", "order_ts_ms")).drop("ts_ms", "order_ts_ms")
    users = base6.select("uid", "ts_ms", *_USER_COLUMNS)
    joined = interval_join(scored, users, "uid", "pair_ts_ms", "ts_ms", bound, bound)
    sums = {"age_sum30_40": "30_34", "age_sum50": "50", "age_sum25_29": "25_29", "age_sum40_49": "40_49",
            "age_sum18_24": "18_24", "age_sum35_39": "35_39"}
    base = ["decade", "zodiac_sign", "gender", "login_name", "email", "phone_num", "height", "judge_os", "weight",
            "user_level", "birthday"]
    return joined.select(
        "uid", F.col("consignee").alias("uname"), "ts_ms", S.ms_to_compact_date(F.col("ts_ms"), tz).alias("ds"),
        F.struct(*base, F.col("age").alias("base_age")).alias("user_base_label"),
        F.struct(F.col("pv").alias("intraday_pv"), "search_item").alias("user_log_label"),
        F.struct("md", "ba", "os", "ch", F.col("pay_time_slot").alias("login_time_slot")).alias("user_device_label"),
        F.struct(
            F.struct(*[F.col(f"sum_{band}_score").alias(name) for name, band in sums.items()]).alias("computer_age_info"),
            F.lit(None).cast("string").alias("spending_pow"),
            "calculate_age",
        ).alias("user_calculate_label"),
        F.struct("sku_name", "b1_name", "tname", F.col("sku_id").cast("string").alias("sku_id")).alias("sup_info_message"),
    )
