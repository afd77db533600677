"""Selecting, routing and merging change-log envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.skew import lookup_join

# The operations of an envelope and the status codes the facts select on.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"
ORDER_PLACED = "1001"
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1006"
PAID = "1602"
REFUND_APPROVED = "0705"


def valid_changes(envelopes: DataFrame, db: str, keep_deletes: bool = True) -> DataFrame:
    """Envelopes of ``db`` with a known operation and a row in them.

    As the job is written, a delete never passes since it has no ``after``; ``keep_deletes=False`` gives that.
    """
    has_row = F.size("after") > 0
    if keep_deletes:
        has_row = has_row | ((F.col("op") == DELETE) & (F.size("before") > 0))
    return envelopes.filter(
        (F.col("source")["db"] == db) & F.col("op").isin(CREATE, UPDATE, DELETE, READ) & F.coalesce(has_row, F.lit(False))
    )


def _of(table: str, op: str = READ) -> Column:
    return (F.col("source")["table"] == table) & (F.col("op") == op)


def _fields(names: Sequence[str], renames: Mapping[str, str] | None = None) -> list[Column]:
    renames = renames or {}
    return [F.col("after")[n].alias(renames.get(n, n)) for n in names] + [F.col("ts_ms")]


def select_table(envelopes: DataFrame, table: str, fields: Sequence[str], where: Column | None = None) -> DataFrame:
    """Snapshot rows of one table with the named fields and ``ts_ms``."""
    condition = _of(table) if where is None else _of(table) & where
    return envelopes.filter(condition).select(*_fields(fields))


def order_details(envelopes: DataFrame) -> DataFrame:
    rows = select_table(envelopes, "order_detail", [
        "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num", "order_price",
        "split_total_amount", "split_activity_amount", "split_coupon_amount",
    ])
    original = S.product_text(F.col("sku_num"), F.col("order_price")).alias("split_original_amount")
    return rows.select(*[c for c in rows.columns if c != "order_price"], original)


def orders(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "order_info", ["id", "user_id", "province_id"])


def detail_activities(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "order_detail_activity", ["order_detail_id", "activity_id", "activity_rule_id"])


def detail_coupons(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "order_detail_coupon", ["order_detail_id", "coupon_id"])


def comments(envelopes: DataFrame) -> DataFrame:
    return select_table(
        envelopes, "comment_info", ["id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"])


def cart_adds(envelopes: DataFrame, mode: str = "delta") -> DataFrame:
    """Cart additions.

    ``delta``: new rows with their quantity, larger quantities with the increase.
    ``as_written``: snapshot rows only, whole quantity.
    """
    cart = F.col("source")["table"] == "cart_info"
    new = F.col("after")["sku_num"]
    if mode == "as_written":
        keep, amount = cart & (F.col("op") == READ), new
    elif mode == "delta":
        n, old = new.try_cast("int"), F.col("before")["sku_num"].try_cast("int")
        grown = (F.col("op") == UPDATE) & (n > old)
        keep = cart & (F.col("op").isin(CREATE, READ) | grown)
        amount = F.when(F.col("op") == UPDATE, (n - old).cast("string")).otherwise(new)
    else:
        raise ValueError(mode)
    after = F.col("after")
    return envelopes.filter(keep).select(
        after["id"].alias("id"), after["user_id"].alias("user_id"), after["sku_id"].alias("sku_id"),
        amount.alias("sku_num"), "ts_ms")


def cancelled_orders(envelopes: DataFrame, strict: bool = True) -> DataFrame:
    """Cancelled orders with their operate time.

    ``strict``: snapshot rows of the order table whose status is one of the two codes. Otherwise the OR
    binds as written: the second code is taken from any table and any operation.
    """
    status = F.col("after")["order_status"]
    if strict:
        keep = _of("order_info") & status.isin(ORDER_PLACED, ORDER_CANCELLED)
    else:
        keep = (_of("order_info") & (status == ORDER_PLACED)) | (status == ORDER_CANCELLED)
    return envelopes.filter(keep).select(*_fields(["id", "operate_time"]))


def payments(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "payment_info", ["user_id", "order_id", "payment_type", "callback_time"],
                        F.col("after")["payment_status"] == PAID)


def refund_requests(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "order_refund_info", [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount", "refund_reason_type",
        "refund_reason_txt", "create_time"])


def orders_in_status(envelopes: DataFrame, status: str = ORDER_REFUNDING) -> DataFrame:
    return select_table(envelopes, "order_info", ["id", "user_id", "province_id"],
                        F.col("after")["order_status"] == status)


def refund_payments(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "refund_payment",
                        ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"],
                        F.col("after")["refund_status"] == PAID)


def approved_refunds(envelopes: DataFrame) -> DataFrame:
    return select_table(envelopes, "order_refund_info", ["order_id", "sku_id", "refund_num"],
                        F.col("after")["refund_status"] == REFUND_APPROVED)


# -- routing configuration --------------------------------------------------------------------------

CONFIG_FIELDS = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]


def config_changes(envelopes: DataFrame) -> DataFrame:
    """Configuration rows from their envelopes: the old row for a delete, else the new one."""
    row = F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    return envelopes.select(row.alias("_row"), "op", "ts_ms").select(
        *[F.col("_row")[n].alias(n) for n in CONFIG_FIELDS], "op", "ts_ms")


def active_config(changes: DataFrame) -> DataFrame:
    """Configuration in force: last change per source table, unless it is a delete.

    ``emptied_at`` is the last time the sink table was dropped or re-created; rows up to it are gone.
    """
    last = F.max(F.struct("ts_ms", *CONFIG_FIELDS, "op"))
    emptied = F.max(F.when(F.col("op").isin(UPDATE, DELETE), F.col("ts_ms")))
    return (
        changes.groupBy("source_table").agg(last.alias("_c"), emptied.alias("emptied_at"))
        .filter(F.col("_c.op") != DELETE)
        .select("source_table", *[F.col(f"_c.{n}").alias(n) for n in CONFIG_FIELDS[1:]], "emptied_at")
    )


def config_versions(changes: DataFrame) -> DataFrame:
    """Every configuration there was, with the time it holds: from ``valid_from`` until before ``valid_to``.

    A snapshot holds for all time before it, too; the last version has no end, and a deleted table no version from then on. Of changes at one
    time the greatest counts. A source table has few versions, which one task sorts.
    """
    newest = changes.groupBy("source_table", "ts_ms").agg(F.max(F.struct(*CONFIG_FIELDS[1:], "op")).alias("_c"))
    following = F.lead("ts_ms").over(Window.partitionBy("source_table").orderBy("ts_ms"))
    versions = newest.select("source_table", *[F.col(f"_c.{n}").alias(n) for n in CONFIG_FIELDS[1:]], F.col("_c.op").alias("_op"),
                             F.col("ts_ms").alias("valid_from"), following.alias("valid_to"))
    return versions.filter(F.col("_op") != DELETE).withColumn("_ever", F.col("_op") == READ).drop("_op")


def _tagged(envelopes: DataFrame) -> DataFrame:
    row = F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    return envelopes.select(F.col("source")["table"].alias("source_table"), row.alias("_row"), "op", "ts_ms")


def route(envelopes: DataFrame, config: DataFrame) -> DataFrame:
    """Rows of configured tables, cut to the configured columns, with their configuration."""
    return _routed(lookup_join(_tagged(envelopes), config, ["source_table"]))


def route_as_of(envelopes: DataFrame, versions: DataFrame) -> DataFrame:
    """``route`` by the configuration that was in force at each row's own time, so that a replay gives the same whenever it runs.

    Spark broadcasts the versions by its own threshold and splits hot tables beyond it.
    """
    rows, v = _tagged(envelopes).alias("r"), versions.alias("v")
    holds = ((F.col("r.source_table") == F.col("v.source_table")) & (F.col("_ever") | (F.col("ts_ms") >= F.col("valid_from")))
             & (F.col("valid_to").isNull() | (F.col("ts_ms") < F.col("valid_to"))))
    joined = rows.join(v, holds).select("r.*", *[F.col(c) for c in CONFIG_FIELDS[1:]], "valid_from")
    return _routed(joined)


def _routed(joined: DataFrame) -> DataFrame:
    wanted = F.split("sink_columns", ",")
    return joined.withColumn("cells", F.map_filter("_row", lambda k, _: F.array_contains(wanted, k))).withColumn(
        "row_key", F.col("_row")[F.col("sink_row_key")]).drop("_row")


def dim_cells(routed: DataFrame) -> DataFrame:
    """Routed rows as single cells plus one marker per delete (``name`` null)."""
    cells = F.when(F.col("op") == DELETE, F.lit(None).cast("map<string,string>")).otherwise(F.col("cells"))
    return (
        routed.filter(F.col("row_key").isNotNull())
        .withColumn("_cells", cells)
        .select("sink_table", "sink_family", "row_key", "ts_ms", "op", F.explode_outer("_cells").alias("name", "value"))
        .filter((F.col("op") == DELETE) | ~S.is_empty(F.col("value")))
    )


def last_changes(routed: DataFrame) -> DataFrame:
    """Routed rows that are enough for ``merge_dims``, also together with later ones: of each cell the last, and the last delete of a row."""
    last = dim_cells(routed).groupBy("sink_table", "row_key", "name").agg(F.max(F.struct("ts_ms", "value", "sink_family")).alias("_c"))
    gone = F.col("name").isNull()
    cells = last.select("sink_table", F.col("_c.sink_family").alias("sink_family"), "row_key", "name", F.col("_c.value").alias("value"),
                        F.when(gone, F.lit(DELETE)).otherwise(F.lit(UPDATE)).alias("op"), F.col("_c.ts_ms").alias("ts_ms"))
    # At most one entry per configured column.
    entries = F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", "value")))
    return cells.groupBy("sink_table", "sink_family", "row_key", "op", "ts_ms").agg(F.map_from_entries(F.array_sort(entries)).alias("cells"))


def merge_dims(routed: DataFrame) -> DataFrame:
    """The dimension tables after all routed rows: one row per (sink table, row key) with its cells.

    An empty cell does not overwrite an older one; a delete drops every cell up to it. Both steps
    aggregate before they shuffle, the second over at most one entry per configured column.
    """
    per_cell = (
        dim_cells(routed)
        .groupBy("sink_table", "row_key", "name")
        .agg(F.max(F.struct("ts_ms", "value", "sink_family")).alias("_c"))
    )
    deleted_at = F.max(F.when(F.col("name").isNull(), F.col("_c.ts_ms")))
    entries = F.collect_list(
        F.when(F.col("name").isNotNull(), F.struct("name", F.col("_c.value").alias("value"), F.col("_c.ts_ms").alias("at"))))
    family = F.max(F.when(F.col("name").isNotNull(), F.col("_c.sink_family")))
    rows = per_cell.groupBy("sink_table", "row_key").agg(
        deleted_at.alias("_gone"), entries.alias("_e"), family.alias("sink_family"))
    alive = F.filter("_e", lambda e: F.col("_gone").isNull() | (e["at"] > F.col("_gone")))
    return (
        rows.withColumn("_e", alive)
        .filter(F.size("_e") > 0)
        .select(
            "sink_table", "row_key", "sink_family",
            F.map_from_entries(F.transform(F.array_sort("_e"), lambda e: F.struct(e["name"], e["value"]))).alias("cells"))
    )


def dim_table(merged: DataFrame, sink_table: str, columns: Sequence[str]) -> DataFrame:
    """One dimension as a plain table."""
    return merged.filter(F.col("sink_table") == sink_table).select(
        "row_key", *[F.col("cells")[c].alias(c) for c in columns])
