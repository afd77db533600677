"""Record layouts of the change log, the app log, the routing configuration and the facts."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

ENVELOPE = T.StructType([
    T.StructField("before", _TEXT_MAP),
    T.StructField("after", _TEXT_MAP),
    T.StructField("source", _TEXT_MAP),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COMMON = _texts("mid", "uid", "vc", "ch", "ar", "is_new", "os", "md", "ba", "sid")
PAGE = T.StructType([
    *_texts("page_id", "last_page_id", "item", "item_type").fields,
    T.StructField("during_time", T.LongType()),
])

APP_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(_TEXT_MAP)),
    T.StructField("actions", T.ArrayType(_TEXT_MAP)),
    T.StructField("start", _TEXT_MAP),
    T.StructField("err", _TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# The same log as a SQL table of text maps.
LOG_MAPS = T.StructType([
    T.StructField("common", _TEXT_MAP),
    T.StructField("page", _TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

CONFIG = _texts("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op")

ORDER_DETAIL = T.StructType([
    *_texts(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount",
    ).fields,
    T.StructField("ts_ms", T.LongType()),
])
