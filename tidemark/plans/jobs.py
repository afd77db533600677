"""The batch jobs: each composes operators from its inputs to its output table.

Jobs take DataFrames, so the same job reads files, tables or topics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import changelog as C
from tidemark.operators import facts, intervals, keyed, logs, lookups, tags, windows
from tidemark.sources.cdc import parse_envelopes

TWO_MINUTES = 2 * intervals.MINUTE

# -- ingest and dimensions ------------------------------------------------------------------------------


def ods_ingest(envelopes: DataFrame) -> DataFrame:
    """Envelopes unchanged, as topic values."""
    return envelopes.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))


def dim_sync(values: DataFrame, config_changes: DataFrame, db: str, keep_deletes: bool = True) -> DataFrame:
    """Dimension tables from the change log and the routing configuration.

    Rows written before their sink table was last dropped or re-created are gone with it.
    """
    changes = C.valid_changes(parse_envelopes(values), db, keep_deletes)
    routed = C.route(changes, C.active_config(config_changes))
    kept = routed.filter(F.col("emptied_at").isNull() | (F.col("ts_ms") > F.col("emptied_at")))
    return C.merge_dims(kept)


# -- detail layer -----------------------------------------------------------------------------------------


def dwd_base_log(values: DataFrame, tz: str = S.BUSINESS_TZ) -> dict[str, DataFrame]:
    """Dirty texts plus the five outputs of the repaired log, as separate tables."""
    repaired = logs.repair_is_new(logs.parsed_log(values), tz)
    return {"dirty": logs.dirty_rows(values), **logs.split_log(repaired)}


def dwd_base_log_outputs(values: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    """The same as one table (output, value), to be written by ``output``. The log is read twice: once for the first day of each
    device, for which only three fields are parsed, and once for all outputs, dirty texts among them."""
    return logs.tagged_texts(logs.repaired_checked(logs.checked_log(values), tz))


def dwd_comment(topic_db: DataFrame, dictionary: DataFrame) -> DataFrame:
    return facts.comment_facts(facts.latest_by_key(C.comments(topic_db), ["id"], ["ts_ms"]), dictionary)


def dwd_cart_add(topic_db: DataFrame, mode: str = "delta") -> DataFrame:
    return facts.latest_by_key(C.cart_adds(topic_db, mode), ["id"], ["ts_ms"])


def dwd_order_detail(topic_db: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    return facts.order_detail_facts(topic_db, tz)


def dwd_order_cancel(topic_db: DataFrame, detail_facts: DataFrame, tz: str = S.BUSINESS_TZ, strict: bool = True) -> DataFrame:
    return facts.order_cancel_facts(detail_facts, C.cancelled_orders(topic_db, strict), tz)


def dwd_pay_success(topic_db: DataFrame, detail_facts: DataFrame) -> DataFrame:
    return facts.payment_facts(detail_facts, C.payments(topic_db))


def dwd_refund(topic_db: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    return facts.refund_facts(C.refund_requests(topic_db), C.orders_in_status(topic_db), tz)


def dwd_refund_pay(topic_db: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    return facts.refund_payment_facts(
        C.refund_payments(topic_db), C.approved_refunds(topic_db), C.orders_in_status(topic_db), tz)


# -- summary layer ------------------------------------------------------------------------------------------


def dws_keyword(log: DataFrame, size: str = "5 seconds", tz: str = S.BUSINESS_TZ, tokens: Column | None = None) -> DataFrame:
    words = logs.words(logs.searches(log), "fullword", "ts", tokens=tokens)
    return windows.keyword_counts(words, size, tz)


def dws_traffic(log: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ) -> DataFrame:
    return windows.traffic(log, size, tz)


def dws_home_detail(log: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ) -> DataFrame:
    return windows.home_detail_visits(log, size, tz)


def dws_login(log: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ) -> DataFrame:
    return windows.login_users(log, size, tz)


def dws_cart_uu(cart: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ) -> DataFrame:
    return windows.cart_users(cart, size, tz)


def dws_province(
    details: DataFrame, provinces: DataFrame, size: str = "1 second", tz: str = S.BUSINESS_TZ,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Orders and amount per window and province. ``details`` holds all versions of the order lines.

    Where the lines do not carry their province, ``orders`` does (``order_id``, ``province_id``, ``ts_ms``).
    """
    settled = windows.settled_versions(details)
    if orders is None:
        measured = windows.province_orders(settled, size, tz)
    else:
        latest = facts.latest_by_key(orders, ["order_id"], ["ts_ms"]).drop("ts_ms")
        measured = windows.province_orders_by_order(settled, latest, size, tz)
    return lookups.province_names(measured, provinces)


def dws_sku(
    details: DataFrame, sku_dim: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ,
    skus: DataFrame | None = None,
) -> DataFrame:
    """Amounts per window and SKU of the newest line versions, with the SKU's dimension."""
    measured = windows.sku_orders(keyed.latest_orders(details), size, tz)
    return lookups.sku_lookups(measured, sku_dim, skus=skus)


# -- tagging --------------------------------------------------------------------------------------------------


def tag_log(log: DataFrame, width: int = TWO_MINUTES) -> DataFrame:
    """Profile of each user at the end of each window, over records counted once."""
    records = logs.not_empty(logs.device_and_search(log), "uid")
    return keyed.profile_by_window(keyed.drop_repeats(records), width)


def tag_device_search(log: DataFrame, tree: DataFrame, compare: DataFrame, width: int = TWO_MINUTES) -> DataFrame:
    """Profiles scored by device and search word."""
    return tags.score_device_and_search(lookups.search_category(tag_log(log, width), tree, compare))


def tag_score(profiles: DataFrame, tree: DataFrame, compare: DataFrame) -> DataFrame:
    """The stand-alone scoring job, with its own row for one search category."""
    return tags.score_device_and_search(lookups.search_category(profiles, tree, compare), variant=True)


def tag_orders(
    topic_db: DataFrame, brands: DataFrame, tree: DataFrame, tz: str = S.BUSINESS_TZ, bound: int = TWO_MINUTES,
    compat: bool = False, skus: DataFrame | None = None,
) -> DataFrame:
    """Order lines joined to their order, newest first time seen, scored by time, amount, brand and category.

    The versions of a line are of one order and time, mostly: then they meet their orders in one slice of the join, and the newest are found
    there. Lines with versions further apart are brought together anew.
    """
    orders = logs.not_empty(tags.order_rows(topic_db, tz), "id")
    details = logs.not_empty(tags.detail_rows(topic_db), "order_id")
    ties = ["split_total_amount", "sku_id", "sku_num", "order_price", "sku_name", "split_activity_amount", "split_coupon_amount"]
    near, apart, needed = keyed.by_agreement(details, "id", F.col("order_id"), intervals.line_slice(F.col("ts_ms"), bound))
    newest = keyed.strictly_newer(
        intervals.order_with_details(orders, near, bound, compat, sliced=True), "detail_id", "create_time", "ts_ms", ties=ties,
        within=["order_id", "_slice"]).drop("_slice")
    others = keyed.strictly_newer(
        intervals.order_with_details(needed(orders), apart, bound, compat), "detail_id", "create_time", "ts_ms", ties=ties)
    newest = newest.unionByName(others)
    return tags.score_orders(lookups.brand_and_category(newest, brands, tree, skus))


def tag_order(topic_db: DataFrame, bound: int = 5 * intervals.MINUTE) -> DataFrame:
    return intervals.trimmed_order_join(intervals.trimmed_orders(topic_db), intervals.trimmed_details(topic_db), bound)


def tag_user(topic_db: DataFrame, today: Column | str, bound: int = 5 * intervals.MINUTE) -> DataFrame:
    users = logs.not_empty(tags.user_rows(topic_db, today), "uid")
    return intervals.user_with_supplement(users, logs.not_empty(tags.supplement_rows(topic_db), "uid"), bound)


def tag_user_standalone(topic_db: DataFrame, today: Column | str) -> DataFrame:
    """The stand-alone user job: nick name, later Scorpio, one-hour bound, gender "null"."""
    users = tags.user_rows(topic_db, today, default_gender=None, nick_name=True, late_scorpio=True)
    return intervals.user_with_supplement(
        users, tags.supplement_rows(topic_db), 60 * intervals.MINUTE, default_gender="null")


def tag_age_level(base2: DataFrame, base4: DataFrame, base6: DataFrame, bound: int = 24 * intervals.HOUR) -> DataFrame:
    return tags.user_age_levels(base2, base4, base6, bound)


def tag_label(
    base2: DataFrame, base4: DataFrame, base6: DataFrame, tz: str = S.BUSINESS_TZ, bound: int = intervals.HOUR,
    compat: bool = False,
) -> DataFrame:
    return tags.user_labels(base2, base4, base6, bound, tz, compat)
