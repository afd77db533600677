"""Streaming forms of the jobs: file, topic or table streams in, idempotent folders out."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import changelog as C
from tidemark.operators import facts, logs, lookups, windows
from tidemark.operators.skew import lookup_join
from tidemark.operators.versions import latest_by_key
from tidemark.sources import sinks
from tidemark.sources.cdc import land_changes, parse_envelopes, with_event_time, with_source_time
from tidemark.streaming import stateful


#: What a run reports of each of its batches.
Progress = list[dict]


def run_once(writer, checkpoint: str) -> Progress:
    """Process what is there, then stop. Progress is kept in ``checkpoint``, so a re-run goes on from it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress]


def state_rows(progress: Progress) -> list[int]:
    """Rows in the state of all operators after each batch."""
    return [sum(op["numRowsTotal"] for op in batch["stateOperators"]) for batch in progress]


def late_rows(progress: Progress) -> int:
    """Rows that came after the watermark had passed them and were dropped."""
    return sum(op["numRowsDroppedByWatermark"] for batch in progress for op in batch["stateOperators"])


def append_to(df: DataFrame, path: str, checkpoint: str) -> Progress:
    return run_once(df.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> Progress:
    return run_once(df.writeStream.foreachBatch(write), checkpoint)


# -- ingest, log split, dimensions ----------------------------------------------------------------------


def ods_ingest(envelopes: DataFrame, path: str, checkpoint: str) -> None:
    """Envelopes unchanged to one topic folder, as text."""
    values = envelopes.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))
    run_once(values.writeStream.format("text").option("path", path).outputMode("append"), checkpoint)


def land_by_table(values: DataFrame, path: str, checkpoint: str) -> Progress:
    """The ingest job's topic landed by table, exactly once: each batch writes folders of its own, which a replay of it replaces."""

    run = sinks.run_of(values.sparkSession, checkpoint)
    return each_batch(values, lambda batch, batch_id: land_changes(batch, path, batch_id, run), checkpoint)


def split_log(values: DataFrame, path: str, checkpoint: str) -> None:
    """Dirty texts and the five log outputs, each batch read and parsed once and written by output."""

    run = sinks.run_of(values.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = logs.checked_log(batch)
        sinks.write_changes(logs.tagged_texts(checked), path, batch_id, "output", run)

    each_batch(values, write, checkpoint)


def split_repaired_log(
    values: DataFrame, path: str, checkpoint: str, offset: int = stateful.BUSINESS_OFFSET_MS, delay: str = "0 seconds", keep: int | None = None
) -> Progress:
    """``split_log`` of records whose ``is_new`` is repaired first, in one query: the log is read once, records wait in the state as texts
    until the watermark has passed them, and each batch writes all six outputs in one pass."""

    run = sinks.run_of(values.sparkSession, checkpoint)
    repaired = stateful.repair_texts(logs.claims(logs.checked_log(values)), offset=offset, delay=delay, keep=keep)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_changes(logs.repaired_texts(batch), path, batch_id, "output", run)

    return each_batch(repaired, write, checkpoint)


def dim_sync(
    values: DataFrame, read_config: Callable[[], DataFrame], db: str, path: str, checkpoint: str, as_of: bool = False
) -> None:
    """Route every batch by the configuration in force when it runs and add it to the dimension change log.

    ``as_of``: by the configuration in force at each row's time instead, which a replay finds again as long as the configuration's own change
    log is there. Rows from before a table was last emptied then stay in the log, and are left out when it is read.
    """

    run = sinks.run_of(values.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = C.valid_changes(parse_envelopes(batch), db)
        if as_of:
            kept = C.route_as_of(changes, C.config_versions(read_config()))
        else:
            routed = C.route(changes, C.active_config(read_config()))
            kept = routed.filter(F.col("emptied_at").isNull() | (F.col("ts_ms") > F.col("emptied_at")))
        version = ["valid_from"] if as_of else []
        sinks.write_changes(
            kept.select("sink_table", "sink_family", "row_key", "cells", "op", "ts_ms", *version), path, batch_id, run=run)

    each_batch(values, write, checkpoint)


#: Columns of the dimension change log that its tables come from.
DIM_CHANGES = ["sink_table", "sink_family", "row_key", "cells", "op", "ts_ms"]


def _manifest(spark: SparkSession, snapshots: str) -> tuple[str | None, dict[str, int]]:
    """The newest whole snapshot's folder, and up to which batch of each run it holds the changes."""
    try:
        rows = spark.read.option("basePath", f"{snapshots}/manifest").schema("run string, upto bigint, snapshot bigint").parquet(f"{snapshots}/manifest")
        newest = rows.agg(F.max("snapshot")).first()[0]
    except AnalysisException:  # none yet
        newest = None
    if newest is None:
        return None, {}
    held = rows.filter(F.col("snapshot") == newest).collect()  # a row for each run
    return f"{snapshots}/rows/snapshot={newest}", {r["run"]: r["upto"] for r in held}


def _dim_changes(spark: SparkSession, path: str, snapshots: str | None) -> DataFrame:
    """All changes, or those of the newest snapshot and of the batches after it: the folders of others are not read."""
    changes = spark.read.option("basePath", path).parquet(path)
    folder, held = _manifest(spark, snapshots) if snapshots else (None, {})
    if folder is None:
        return changes.select(*DIM_CHANGES, "run", "batch_id")
    for run, upto in held.items():
        changes = changes.filter((F.col("run") != run) | (F.col("batch_id") > upto))
    old = spark.read.parquet(folder).withColumn("run", F.lit(None).cast("string")).withColumn("batch_id", F.lit(None).cast("int"))
    return changes.select(*DIM_CHANGES, "run", "batch_id").unionByName(old.select(*DIM_CHANGES, "run", "batch_id"))


def snapshot_dims(spark: SparkSession, path: str, snapshots: str) -> None:
    """Write what the dimension changes so far come to, from the snapshot before and the batches after it.

    The manifest, which says what a snapshot holds, is written last: without it a snapshot does not count, so one that was cut off
    does no harm. Run it when no batch is being written.
    """
    batches = spark.read.option("basePath", path).parquet(path).groupBy("run").agg(F.max("batch_id").cast("bigint").alias("upto"))
    batches = spark.createDataFrame(batches.collect(), "run string, upto bigint")  # as it is now; a row for each run
    folder, _ = _manifest(spark, snapshots)
    number = int(folder.rpartition("=")[2]) + 1 if folder else 0
    C.last_changes(_dim_changes(spark, path, snapshots)).select(*DIM_CHANGES).write.mode("overwrite").parquet(f"{snapshots}/rows/snapshot={number}")
    batches.write.mode("overwrite").parquet(f"{snapshots}/manifest/snapshot={number}")


def read_dims(spark: SparkSession, path: str, config_changes: DataFrame, snapshots: str | None = None) -> DataFrame:
    """The dimension tables behind ``dim_sync`` under the configuration as it now is: tables no longer configured are gone,
    and so are rows from before their table was last dropped or re-created, whichever batch wrote them. With ``snapshots`` only the newest
    snapshot and the changes after it are read."""
    config = C.active_config(config_changes).select("sink_table", "emptied_at")
    changes = lookup_join(_dim_changes(spark, path, snapshots).drop("run", "batch_id"), config, ["sink_table"])
    alive = changes.filter(F.col("emptied_at").isNull() | (F.col("ts_ms") > F.col("emptied_at")))
    return C.merge_dims(alive.drop("emptied_at"))


def upsert(df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str) -> None:
    """Keyed changes: each batch is cut to its last row per key before it is written."""

    run = sinks.run_of(df.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_changes(latest_by_key(batch, list(keys), list(order)), path, batch_id, run=run)

    each_batch(df, write, checkpoint)


# -- joins --------------------------------------------------------------------------------------------------


def _millis(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str, bound: str, delay: str = "3 seconds", copied: str = "right"
) -> DataFrame:
    """Stream-stream inner join within ``bound`` on both sides. A pair's event time ``et`` is the later of both, so the result
    can be joined again. ``copied`` names the smaller side."""
    timed = with_event_time(left, left_ms, delay, "et")
    return chain_interval_join(timed, right, key, right_ms, bound, delay, left_ms=left_ms, lag="0 seconds", copied=copied)


def chain_interval_join(
    left: DataFrame, right: DataFrame, key: str, right_ms: str, bound: str, delay: str = "5 seconds", *, left_ms: str, lag: str,
    copied: str = "right"
) -> DataFrame:
    """Join a third stream to the result of ``interval_join``, on the time ``left_ms`` of its left rows. They come up to ``lag``, the widest
    bound of the joins before, behind the watermark."""
    b = with_event_time(right, right_ms, delay, "_et")
    return stateful.interval_join(left, b, key, left_ms, right_ms, _millis(bound), _millis(bound), _millis(lag), copied=copied)


def left_interval_join(
    left: DataFrame, right: DataFrame, key: str, right_ms: str, bound: str, delay: str = "5 seconds", *, left_ms: str, lag: str
) -> DataFrame:
    """``chain_interval_join`` that keeps left rows without a partner: they come with nulls once the watermark has passed the time
    within which one could have come."""
    b = with_event_time(right, right_ms, delay, "_et")
    return stateful.interval_join(left, b, key, left_ms, right_ms, _millis(bound), _millis(bound), _millis(lag), outer=True)


#: Which of a line's rows counts: the newest line, joined with the newest of the others.
FACT_ORDER = ["ts_ms", "order_ts_ms", "activity_ts_ms", "coupon_ts_ms"]


def _sides(activities: DataFrame, coupons: DataFrame) -> tuple[DataFrame, DataFrame]:
    line = F.col("order_detail_id").alias("id")
    return (activities.select(line, "activity_id", "activity_rule_id", F.col("ts_ms").alias("activity_ts_ms")),
            coupons.select(line, "coupon_id", F.col("ts_ms").alias("coupon_ts_ms")))


def order_detail(
    details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame, retention: str = "30 minutes",
    sides: str = "30 minutes", delay: str = "5 seconds", tz: str = S.BUSINESS_TZ
) -> DataFrame:
    """The order-detail fact: details joined to their order while both are retained, with the activity and the coupon that come within
    ``sides`` of them, or nulls. A line with several versions of its parts has a row for each; ``FACT_ORDER`` tells which counts."""
    right = orders.select(F.col("id").alias("order_id"), "user_id", "province_id", F.col("ts_ms").alias("order_ts_ms"))
    joined = interval_join(details, right, "order_id", "ts_ms", "order_ts_ms", retention, delay)
    activity, coupon = _sides(activities, coupons)
    joined = left_interval_join(joined, activity, "id", "activity_ts_ms", sides, delay, left_ms="ts_ms", lag=retention)
    joined = left_interval_join(joined, coupon, "id", "coupon_ts_ms", sides, delay, left_ms="ts_ms", lag=max(retention, sides, key=_millis))
    return joined.withColumn("date_id", S.date_id(F.col("create_time"), tz)).select(*facts.DETAIL_COLUMNS, *FACT_ORDER[1:])


def run_order_detail(envelopes: DataFrame, path: str, checkpoint: str, **options) -> None:
    """The order-detail job: facts as keyed changes, and beside them every activity and coupon by line, from one change-log stream.

    A fact that went out with nulls is corrected by an activity or coupon that comes later than the join waits: both are
    put together when the table is read.
    """
    activities, coupons = C.detail_activities(envelopes), C.detail_coupons(envelopes)
    joined = order_detail(C.order_details(envelopes), C.orders(envelopes), activities, coupons, **options)
    upsert(joined, ["id"], FACT_ORDER, f"{path}/facts", f"{checkpoint}/facts")
    activity, coupon = _sides(activities, coupons)
    both = activity.withColumn("kind", F.lit("activity")).unionByName(coupon.withColumn("kind", F.lit("coupon")), allowMissingColumns=True)
    upsert(both, ["id", "kind"], FACT_ORDER[2:], f"{path}/sides", f"{checkpoint}/sides")


def read_order_detail(spark: SparkSession, path: str) -> DataFrame:
    """The fact table behind ``run_order_detail``: of each line the newest row, with the newest activity and coupon known by now."""
    out = sinks.read_keyed(spark, f"{path}/facts", ["id"], FACT_ORDER)
    sides = sinks.read_keyed(spark, f"{path}/sides", ["id", "kind"], FACT_ORDER[2:])
    for kind, columns in (("activity", ["activity_id", "activity_rule_id"]), ("coupon", ["coupon_id"])):
        order = f"{kind}_ts_ms"
        side = sides.filter(F.col("kind") == kind).select("id", order, *columns)
        own, newer = F.col(f"f.{order}"), F.col(f"s.{order}")
        later = newer.isNotNull() & (own.isNull() | (newer >= own))
        picked = {c: F.when(later, F.col(f"s.{c}")).otherwise(F.col(f"f.{c}")) for c in columns}
        out = out.alias("f").join(side.alias("s"), "id", "left").select(*[picked.get(c, F.col("id" if c == "id" else f"f.{c}")).alias(c) for c in out.columns])
    return out.select(*facts.DETAIL_COLUMNS)


# -- windows ------------------------------------------------------------------------------------------------


def first_visits(log: DataFrame, delay: str = "0 seconds", offset: int = stateful.BUSINESS_OFFSET_MS, hand_on: str | None = None) -> DataFrame:
    """Page measures with a 1 in ``uv`` on the first of each device and day. By default a row waits for the watermark, so it would be late for
    a window behind it in the same query, and the windows are summed when the result is read. With ``hand_on`` it does not wait."""
    return stateful.flag_first_of_day(logs.page_measures(log), ["mid"], "uv", "ts", offset, delay, hand_on=hand_on)


def traffic_windows(flagged: DataFrame, size: str = "10 seconds", tz: str = S.BUSINESS_TZ, time: Column | None = None) -> DataFrame:
    """The window measures of ``first_visits``, stored or (with ``time``, the event time handed on) in the same query."""
    return windows.tumble(flagged, F.timestamp_millis("ts") if time is None else time, size, windows.TRAFFIC_KEYS, [
        F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"), F.sum("dur").alias("dur_sum")], tz)


def traffic(log: DataFrame, size: str = "10 seconds", delay: str = "0 seconds", offset: int = stateful.BUSINESS_OFFSET_MS,
            tz: str = S.BUSINESS_TZ) -> DataFrame:
    """The traffic job as one query: first visits are flagged as they come, and each window is given out once the watermark has passed it.
    Records that come out of order in different batches are flagged in the order they came, as in the original."""
    return traffic_windows(first_visits(log, delay, offset, "et"), size, tz, F.col("et"))


def login_users(log: DataFrame, size: str = "10 seconds", delay: str = "0 seconds", offset: int = stateful.BUSINESS_OFFSET_MS,
                tz: str = S.BUSINESS_TZ) -> DataFrame:
    """The login job as one query, like ``traffic``."""
    rows = logs.logins(log).select(F.col("common.uid").alias("uid"), "ts")
    days = stateful.login_days(rows, offset=offset, delay=delay, hand_on="et")
    return windows.tumble(days, F.col("et"), size, [], [F.sum("back").alias("back_ct"), F.sum("uu").alias("uu_ct")], tz)


def home_detail(log: DataFrame, size: str = "10 seconds", delay: str = "0 seconds", offset: int = stateful.BUSINESS_OFFSET_MS,
                tz: str = S.BUSINESS_TZ) -> DataFrame:
    """The home and product page job as one query, like ``traffic``."""
    visits = logs.on_pages(log, "home", "good_detail").select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    firsts = stateful.flag_first_of_day(visits, ["mid", "page_id"], "first", "ts", offset, delay, hand_on="et").filter("first = 1")
    return windows.tumble(firsts, F.col("et"), size, [], [
        F.count_if(F.col("page_id") == "home").alias("home_uv_ct"), F.count_if(F.col("page_id") == "good_detail").alias("good_detail_uv_ct")], tz)


def keyword_counts(log: DataFrame, size: str = "5 seconds", delay: str = "3 seconds", tz: str = S.BUSINESS_TZ,
                   tokens: Column | None = None) -> DataFrame:
    words = with_event_time(logs.words(logs.searches(log), "fullword", "ts", tokens=tokens), "ts", delay)
    return windows.tumble(words, F.col("et"), size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], tz)


def keyword_counts_by_source(values: DataFrame, size: str = "5 seconds", delay: str = "3 seconds", tz: str = S.BUSINESS_TZ,
                             tokens: Column | None = None) -> DataFrame:
    """``keyword_counts`` of a topic (value, timestamp), in windows of the source's own time, whatever time the payload holds."""
    timed = with_source_time(values, delay)
    found = logs.words(logs.searches(logs.parsed_log(timed, "et"), "et"), "fullword", "et", tokens=tokens)
    return windows.tumble(found, F.col("et"), size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], tz)


def first_of_day(df: DataFrame, keys: Sequence[str], ms: str, tz: str = S.BUSINESS_TZ, delay: str | None = None) -> DataFrame:
    """One row per key and day. ``dropDuplicatesWithinWatermark`` would forget keys within the day.

    With ``delay`` a day's keys are forgotten once the watermark has passed the day, as nothing of it comes any more; else they are kept.
    """
    if delay is not None:
        return drop_repeats(df, keys, ms, tz, delay)
    return df.withColumn("_day", S.ms_to_day(F.col(ms), tz)).dropDuplicates([*keys, "_day"]).drop("_day")


def drop_repeats(df: DataFrame, keys: Sequence[str], ms: str, tz: str = S.BUSINESS_TZ, delay: str = "0 seconds") -> DataFrame:
    """One row per value of ``keys`` and day, with a state of the days that the watermark has not passed.

    The original keeps whole records for ever. Here repeats within a day are dropped, and one of another day counts as new. Pass a
    record's hash as key to keep the state narrow.
    """
    ahead = F.to_utc_timestamp(F.lit("1970-01-02 00:00:00"), tz)  # where a day of the zone starts, in UTC
    start = F.pmod(F.unix_seconds(ahead), F.lit(86_400))
    timed = with_event_time(df, ms, delay, "_et")
    offset = df.sparkSession.range(1).select(start).first()[0]
    day = F.window("_et", "1 day", "1 day", f"{offset} seconds")
    return timed.withColumn("_day", day).dropDuplicates([*keys, "_day"]).drop("_day", "_et")


def province_orders(
    details: DataFrame, provinces: DataFrame, size: str = "1 second", delay: str = "0 seconds", tz: str = S.BUSINESS_TZ
) -> DataFrame:
    """Orders and amount per province and window. An order's lines are summed first, to one row per order and window, so
    that a province's window holds two numbers and no set of orders. Amounts are decimals."""
    timed = with_event_time(details, "ts_ms", delay)
    amount = F.sum(F.col("split_total_amount").cast("decimal(16,2)")).alias("amount")
    per_order = timed.groupBy(F.window("et", size).alias("w"), "province_id", "order_id").agg(amount)
    at = F.window_time("w").alias("at")
    measured = windows.tumble(per_order.select(at, "province_id", "amount"), F.col("at"), size, ["province_id"], [
        F.count(F.lit(1)).alias("order_count"), F.sum("amount").cast("decimal(16,2)").alias("order_amount")], tz)
    return lookups.province_names(measured, provinces)
