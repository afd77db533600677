"""Shop tables, change log and app log derived from the test tables.

The test data has orders, lines, parts, customers and events; this module maps them, whole, to the records
the jobs read. ``standin_sql`` holds the same mapping as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce, wraps
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import APP_LOG
from tidemark.session import new_path
from tidemark.sources.cdc import cdc_snapshot, text_map

# Fixed values of the stand-in: start of the tag month and its length in seconds.
MONTH_START_MS = 1_704_067_200_000
MONTH_SECONDS = 2_592_000
PAGE_OF = {"view": "home", "click": "good_detail", "signup": "login", "purchase": "payment", "error": "mine"}
OSES = ["iOS 13.2", "Android 11.0", "Harmony 4.0"]
CHANNELS = ["xiaomi", "Appstore", "web", "wandoujia"]
MODELS = ["iPhone 14", "Mi 13", "Mate 60", "vivo x90", "realme 8"]
MAKERS = ["iPhone", "Xiaomi", "Huawei"]
CATEGORY_WORDS = ["ECONOMY", "PROMO", "SMALL", "MEDIUM", "LARGE", "STANDARD"]
BRAND_NAMES = ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿"]
CATEGORY3 = [("ECONOMY", "ECONOMY", "21"), ("PROMO", "PROMO", "21"), ("SMALL", "SMALL", "22"), ("MEDIUM", "MEDIUM", "22"),
             ("LARGE", "LARGE", "23"), ("STANDARD", "STANDARD", "29")]
CATEGORY2 = [("21", "手机通讯", "11"), ("22", "大家电", "12"), ("23", "电子书刊", "13")]
CATEGORY1 = [("11", "手机"), ("12", "家用电器"), ("13", "图书、音像、电子书刊")]
COMPARE = [(1, "手机", "科技与数码"), (2, "家用电器", "性价比"), (3, "图书、音像、电子书刊", "学习与发展"), (4, "手机", "时尚与潮流")]


_PLANS: WeakKeyDictionary = WeakKeyDictionary()


def once(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build the (lazy) plan once per session: the test tables do not change, and analysis takes a while."""

    @wraps(make)
    def cached(spark: SparkSession, *args, **kwargs) -> DataFrame:
        plans = _PLANS.setdefault(spark, {})
        key = (make.__name__, args, tuple(sorted(kwargs.items())))
        if key not in plans:
            plans[key] = make(spark, *args, **kwargs)
        return plans[key]

    return cached


@once
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("decimal(16,2)").cast("string")


def _choice(values: list[str], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def _tag_ms(key: str, factor: int) -> Column:
    return F.lit(MONTH_START_MS) + (F.col(key) * factor) % MONTH_SECONDS * 1000


def tag_order_ms(key: str) -> Column:
    """Time of an order within the tag month."""
    return _tag_ms(key, 7919).cast("bigint")


def user_ms(key: str) -> Column:
    """Time of a user record within the tag month."""
    return _tag_ms(key, 104729).cast("bigint")


# -- shop tables ------------------------------------------------------------------------------------------


@once
def order_info(spark: SparkSession, sf: str, tag_month: bool = False) -> DataFrame:
    """Orders; ``tag_month`` places them in the month of the events."""
    buyers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    ms = _tag_ms("o_orderkey", 7919) if tag_month else _ms("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "1006").when(F.col("o_orderstatus") == "O", "1001").when(
        F.col("o_orderstatus") == "P", "1003")
    total = _money(_cents("o_totalprice"))
    joined = table(spark, sf, "orders").join(buyers, "o_custkey")
    return joined.select(
        _text("o_orderkey").alias("id"), _text("o_custkey").alias("user_id"), _text("c_nationkey").alias("province_id"),
        status.alias("order_status"), _text(ms).alias("operate_time"), F.col("c_name").alias("consignee"),
        _text(ms).alias("create_time"), total.alias("original_total_amount"), total.alias("total_amount"),
        ms.alias("ts_ms"))


def lines_of(lineitem: DataFrame, tag_month: bool = False) -> DataFrame:
    """Order lines with their versions and the flags other tables derive from, from a table or a stream."""
    cents, qty = F.col("cents"), F.col("qty")
    ms = _ms("l_shipdate")
    if tag_month:
        ms = _tag_ms("l_orderkey", 7919) + (F.col("l_linenumber") * 45 - 150) * 1000
    base = lineitem.withColumns({
        "cents": _cents("l_extendedprice"), "qty": F.col("l_quantity").cast("bigint"),
        "disc": F.round(F.col("l_discount") * 100).cast("bigint"), "tax": F.round(F.col("l_tax") * 100).cast("bigint"),
        "ts_ms": ms.cast("bigint"),
    })
    return base.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("sku_id"), F.concat(F.lit("sku "), _text("l_partkey")).alias("sku_name"),
        _text("ts_ms").alias("create_time"), _text("l_suppkey").alias("source_id"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("source_type"), _text("qty").alias("sku_num"),
        _money(F.expr("(cents * 2 + qty) div (qty * 2)")).alias("order_price"), _money(cents).alias("split_total_amount"),
        _money(F.expr("(cents * disc + 50) div 100")).alias("split_activity_amount"),
        _money(F.expr("(cents * tax + 50) div 100")).alias("split_coupon_amount"),
        "ts_ms", "disc", "tax", "l_returnflag", "l_linestatus", "l_linenumber")


@once
def lines(spark: SparkSession, sf: str, tag_month: bool = False) -> DataFrame:
    return lines_of(table(spark, sf, "lineitem"), tag_month)


DETAIL_FIELDS = [
    "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num", "order_price",
    "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts_ms",
]


def order_detail(spark: SparkSession, sf: str, tag_month: bool = False) -> DataFrame:
    return lines(spark, sf, tag_month).select(*DETAIL_FIELDS)


def order_detail_activity(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).filter("disc > 5").select(
        F.col("id").alias("order_detail_id"), F.col("source_id").alias("activity_id"),
        _text("disc").alias("activity_rule_id"), "ts_ms")


def order_detail_coupon(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).filter("tax > 4").select(
        F.col("id").alias("order_detail_id"), _text("tax").alias("coupon_id"), "ts_ms")


def payment_info(spark: SparkSession, sf: str) -> DataFrame:
    paid = _ms("o_orderdate") + 3_600_000
    return table(spark, sf, "orders").select(
        _text("o_custkey").alias("user_id"), _text("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"), _text(paid).alias("callback_time"),
        F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601").alias("payment_status"), paid.alias("ts_ms"))


def order_refund_info(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).filter("l_returnflag = 'R'").select(
        F.concat(F.lit("R"), "id").alias("id"), F.col("source_id").alias("user_id"), "order_id", "sku_id",
        F.concat(F.lit("150"), _text(F.col("l_linenumber") % 3)).alias("refund_type"), F.col("sku_num").alias("refund_num"),
        F.col("split_total_amount").alias("refund_amount"), F.concat(F.lit("13"), _text("disc")).alias("refund_reason_type"),
        F.concat(F.lit("reason "), _text("l_linenumber")).alias("refund_reason_txt"), "create_time",
        F.when(F.col("l_linestatus") == "O", "0705").otherwise("0701").alias("refund_status"), "ts_ms")


def refund_payment(spark: SparkSession, sf: str) -> DataFrame:
    back = F.col("ts_ms") + 3_600_000
    return lines(spark, sf).filter("l_returnflag = 'R'").select(
        F.concat(F.lit("P"), "id").alias("id"), "order_id", "sku_id",
        F.concat(F.lit("110"), _text(F.col("l_linenumber") % 3)).alias("payment_type"), _text(back).alias("callback_time"),
        F.col("split_total_amount").alias("total_amount"),
        F.when(F.col("tax") > 2, "1602").otherwise("1601").alias("refund_status"), back.alias("ts_ms"))


def comment_info(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_type = 'click'").select(
        _text("event_id").alias("id"), _text("user_id").alias("user_id"), _text(F.col("event_id") % 100).alias("sku_id"),
        _text(F.col("event_id") % 6).alias("appraise"), F.concat(F.lit("comment "), _text("event_id")).alias("comment_txt"),
        _text(_ms("ts")).alias("create_time"), _ms("ts").alias("ts_ms"))


@once
def cart_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Cart changes: snapshots, inserts and updates with their old quantity."""
    eid = F.col("event_id")
    rows = table(spark, sf, "events").filter("event_type = 'purchase'").select(
        _text("event_id").alias("id"), _text("user_id").alias("user_id"), _text(eid % 100).alias("sku_id"),
        _text(eid % 5 + 1).alias("sku_num"), _ms("ts").alias("ts_ms"),
        _choice(["r", "c", "u"], eid % 3).alias("_op"), _text(eid % 4 + 1).alias("_old"))
    fields = ["id", "user_id", "sku_id", "sku_num"]
    old = F.when(F.col("_op") == "u", text_map(["id", "user_id", "sku_id", "_old"], fields))
    return cdc_snapshot(rows, "cart_info", op=F.col("_op"), before=old, after=text_map(fields))


def user_info(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    ms = _tag_ms("c_custkey", 104729)
    return table(spark, sf, "customer").select(
        _text(key).alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("nick "), _text(key)).alias("nick_name"),
        _text(key % 3).alias("user_level"), F.lower("c_name").alias("login_name"),
        F.concat(F.lit("1380000"), _text(key)).alias("phone_num"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
        _text(F.lit(3000) + key * 13 % 9000).alias("birthday"), ms.alias("ts_ms"))


def user_info_sup_msg(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    ms = _tag_ms("c_custkey", 104729)
    return table(spark, sf, "customer").select(
        _text(key).alias("uid"), F.lit("cm").alias("unit_height"), _text(key % 50 + 150).alias("height"),
        F.lit("kg").alias("unit_weight"), _text(key % 50 + 45).alias("weight"), _text(ms).alias("create_ts"),
        (ms + (key % 13 - 6) * 60_000).alias("ts_ms"))


SHOP = {
    "order_info": order_info, "order_detail": order_detail, "order_detail_activity": order_detail_activity,
    "order_detail_coupon": order_detail_coupon, "payment_info": payment_info, "order_refund_info": order_refund_info,
    "refund_payment": refund_payment, "comment_info": comment_info, "user_info": user_info,
    "user_info_sup_msg": user_info_sup_msg,
}


TRADE = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


@once
def change_log(spark: SparkSession, sf: str, *tables: str) -> DataFrame:
    """One change log of the named shop tables, or of all. Selecting one of them prunes the others from the plan."""
    names = tables or (*SHOP, "cart_info")
    parts = [cart_envelopes(spark, sf) if n == "cart_info" else cdc_snapshot(SHOP[n](spark, sf), n) for n in names]
    return reduce(DataFrame.unionByName, parts)


@once
def tag_change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Change log of the tagging jobs: orders, lines and users within one month."""
    parts = [
        cdc_snapshot(order_info(spark, sf, tag_month=True), "order_info"),
        cdc_snapshot(order_detail(spark, sf, tag_month=True), "order_detail"),
        cdc_snapshot(user_info(spark, sf), "user_info"),
        cdc_snapshot(user_info_sup_msg(spark, sf), "user_info_sup_msg"),
    ]
    return reduce(DataFrame.unionByName, parts)


# -- app log --------------------------------------------------------------------------------------------------


def app_log(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """App-log records in their declared layout; pass ``events`` to build them on a stream."""
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    page_id = F.lit(PAGE_OF["error"])
    for event, page in PAGE_OF.items():
        page_id = F.when(kind == event, page).otherwise(page_id)
    last_page = F.when(e % 4 == 1, "search").when(e % 4 == 2, "login").when(e % 4 == 3, "home")
    search = e % 4 == 1
    entries = F.sequence(F.lit(1).cast("bigint"), e % 3)
    some = e % 3 > 0
    none = F.array().cast("array<map<string,string>>")
    displays = F.when(some, F.transform(entries, lambda i: F.create_map(
        F.lit("item"), _text(e % 100), F.lit("pos_id"), _text(i)))).otherwise(none)
    actions = F.when(some, F.transform(entries, lambda i: F.create_map(
        F.lit("action_id"), F.lit("cart_add"), F.lit("item"), _text(i)))).otherwise(none)
    common = F.struct(
        F.concat(F.lit("m"), _text(u)).alias("mid"), _text(u).alias("uid"),
        F.concat(F.lit("v2.1."), _text(u % 3)).alias("vc"), _choice(CHANNELS, u % 4).alias("ch"), _text(u % 25).alias("ar"),
        F.when(e % 2 == 0, "1").otherwise("0").alias("is_new"), _choice(OSES, (u + e) % 3).alias("os"),
        _choice(MODELS, (u + e) % 5).alias("md"), _choice(MAKERS, (u + e) % 3).alias("ba"),
        F.concat(F.lit("s"), _text(F.expr("event_id div 10"))).alias("sid"))
    page = F.struct(
        page_id.alias("page_id"), last_page.alias("last_page_id"),
        F.when(search, _choice(CATEGORY_WORDS, F.expr("event_id div 4") % 6)).alias("item"),
        F.when(search, "keyword").alias("item_type"), F.round(F.col("value") * 1000).cast("bigint").alias("during_time"))
    start = F.when((kind == "signup") & (e % 5 == 0), F.create_map(
        F.lit("entry"), F.lit("icon"), F.lit("loading_time"), _text(e % 1000)))
    err = F.when(kind == "error", F.create_map(
        F.lit("error_code"), _text(e % 500 + 1000), F.lit("msg"), F.concat(F.lit("fault "), _text(e))))
    source = table(spark, sf, "events") if events is None else events
    out = source.select(
        common.alias("common"), page.alias("page"), displays.alias("displays"), actions.alias("actions"),
        start.alias("start"), err.alias("err"), _ms("ts").alias("ts"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in APP_LOG.fields])


def raw_log(spark: SparkSession, sf: str, events: DataFrame | None = None, *more: Column) -> DataFrame:
    """The log as JSON lines, with further columns of its records. At a multiple of 89 milliseconds the payload is null, at one of 97 it is cut off."""
    log = app_log(spark, sf, events)
    text = F.to_json(F.struct(*[f.name for f in APP_LOG.fields]))
    broken = F.pmod(F.col("ts"), F.lit(97)) == 0
    gone = F.pmod(F.col("ts"), F.lit(89)) == 0
    return log.select(F.when(gone, F.lit(None).cast("string")).when(broken, F.concat(F.lit("{\"ts\": "), _text("ts"))).otherwise(text).alias("value"), *more)


@once
def log_topic(spark: SparkSession, sf: str) -> DataFrame:
    """``raw_log`` as a topic that has landed on storage: written once per session, then read."""
    path = new_path(spark, "log-topic")
    raw_log(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


# -- dimensions -------------------------------------------------------------------------------------------


def provinces(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def base_dic(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(_text("r_regionkey").alias("dic_code"), F.col("r_name").alias("dic_name"))


@once
def sku_info(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        _text("p_partkey").alias("id"), _text("p_size").alias("spu_id"), F.concat(F.lit("spu "), _text("p_size")).alias("spu_name"),
        F.col("p_brand").alias("tm_id"), F.col("p_type").alias("category3_id"))


@once
def spu_info(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(_text("p_size").alias("id")).agg(
        F.min("p_type").alias("category3_id"), F.min("p_brand").alias("tm_id"))


@once
def trademarks(spark: SparkSession, sf: str) -> DataFrame:
    number = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    name = F.when(number % 7 < 6, _choice(BRAND_NAMES, number % 7)).otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select(F.col("p_brand").alias("id"), name.alias("tm_name")).distinct()


def fixed_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table, known to the planner with its true size."""
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    names = ", ".join(part.split()[0] for part in schema.split(","))
    casts = [f"CAST({n} AS {t}) AS {n}" for n, t in (part.split() for part in schema.split(","))]
    return spark.sql(f"SELECT {', '.join(casts)} FROM VALUES {values} AS t({names})")


def category3(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, CATEGORY3, "id string, name string, category2_id string")


def category2(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, CATEGORY2, "id string, name string, category1_id string")


def category1(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, CATEGORY1, "id string, name string")


def category_compare(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, COMPARE, "id int, category_name string, search_category string")


# -- dimension sync ---------------------------------------------------------------------------------------

DIM_TABLES = ["nation", "region", "supplier", "customer", "part"]
DIM_COLUMNS = ["id,name,region_id", "id,name", "id,name,nation_id", "id,name,segment", "id,name,brand"]


@once
def config_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Routing configuration changes, one per nation row: five tables, each read once and then updated; the last is
    deleted in the end."""
    key = F.col("n_nationkey").cast("bigint")
    rows = table(spark, sf, "nation").select(
        _choice(DIM_TABLES, key % 5).alias("source_table"),
        F.concat(F.lit("dim_"), _choice(DIM_TABLES, key % 5)).alias("sink_table"),
        _choice(DIM_COLUMNS, key % 5).alias("sink_columns"), F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"), key.alias("ts_ms"),
        F.when(key < 5, "r").when(key == 24, "d").otherwise("u").alias("_op"))
    fields = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
    gone = F.col("_op") == "d"
    return cdc_snapshot(rows, "table_process_dim", db="config", op=F.col("_op"),
                        before=F.when(gone, text_map(fields)), after=F.when(~gone, text_map(fields)))


@once
def dim_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of dimension source tables: snapshots of all, then customer updates, deletes and re-creations."""
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id"),
        F.lit("x").alias("note"), F.lit(100).alias("ts_ms"))
    region = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") + 19).alias("ts_ms"))
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").alias("balance"), F.lit(100).alias("ts_ms"))
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.lit(100).alias("ts_ms"))
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    snapshot = customer.withColumn("ts_ms", F.lit(100))
    updates = customer.filter("id % 3 = 0").select(
        "id", F.concat("name", F.lit(" v2")).alias("name"), F.lit("").alias("segment"), F.lit(200).alias("ts_ms"))
    deletes = customer.filter("id % 7 = 0").withColumn("ts_ms", F.lit(300))
    again = customer.filter("id % 14 = 0").select("id", F.concat("name", F.lit(" v3")).alias("name"), F.lit(400).alias("ts_ms"))
    row = text_map(["id", "name", "segment"])
    parts = [
        cdc_snapshot(nation, "nation"), cdc_snapshot(region, "region"), cdc_snapshot(supplier, "supplier"),
        cdc_snapshot(part, "part"), cdc_snapshot(snapshot, "customer"), cdc_snapshot(updates, "customer", op="u"),
        cdc_snapshot(deletes, "customer", op="d", before=row, after=F.lit(None)), cdc_snapshot(again, "customer", op="c"),
    ]
    return reduce(DataFrame.unionByName, parts)
