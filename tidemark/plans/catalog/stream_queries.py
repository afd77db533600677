"""Streaming jobs run to the end of the test tables and read back; their SQL is that of the batch form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import changelog as C
from tidemark.operators import logs as L
from tidemark.operators import windows
from tidemark.plans import standins as T
from tidemark.plans.catalog.changes import _CELLS, _DIM_ROWS, _MERGED
from tidemark.plans.catalog.fact_queries import FACT, FACT_NEEDS
from tidemark.plans.catalog.job_queries import _FIXED, _KEPT
from tidemark.plans.catalog.log_queries import DEVICE_SQL
from tidemark.plans.catalog.window_queries import (
    DAY, HOME_DETAIL_SQL, LOGIN_DAYS, LOGIN_SQL, RUNNING_ORDER, TRAFFIC_SQL, VERSIONS, line_versions, running_sql,
)
from tidemark.plans.registry import query
from tidemark.plans.standin_sql import bounds, latest, using
from tidemark.session import new_path, remove
from tidemark.sources import cdc, sinks
from tidemark.sources.sinks import read_keyed
from tidemark.streaming import jobs, stateful

HOUR = 3_600_000


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table as a file stream."""
    schema = T.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def log_stream(spark: SparkSession, sf: str) -> DataFrame:
    return T.app_log(spark, sf, stream(spark, sf, "events"))


def in_slices(
    spark: SparkSession, rows: DataFrame, ms: str, run: Callable[[DataFrame], object], later: Column | DataFrame | None = None, n: int = 3,
    read: Callable[[str], DataFrame] | None = None, drop: bool = False,
) -> None:
    """``rows`` land in ``n`` slices of time, one after the other, each in as many files as it has parts; ``run`` is called with the stream
    of what has landed once for each, and goes on where it stopped. A slice is selected from the rows as it lands, so they are stored once.

    With ``later`` the last slice also holds a copy of a row that fits it (or rows given), far later than all others: it moves the watermark
    past open windows, as the next day's rows would, and its own window is still open when the input ends. With ``drop`` what has landed goes when
    all of it has been run, as a topic forgets what its readers have had.
    """
    live = new_path(spark, "replay")
    low, high = rows.agg(F.min(ms), F.max(ms)).first()
    part = F.least(F.floor((F.col(ms) - low) * n / (high - low + 1)), F.lit(n - 1)).cast("int")
    for k in range(n):
        some = rows.filter(part == k)
        if later is not None and k + 1 == n:
            end = later if isinstance(later, DataFrame) else rows.filter(later).limit(1).withColumn(ms, F.lit(high + 400 * DAY).cast("bigint"))
            some = some.unionByName(end)
        some.write.mode("append").option("compression", "zstd").parquet(live)
        run(read(live) if read else spark.readStream.schema(rows.schema).parquet(live))
    if drop:
        remove(spark, live)


def over_slices(
    spark: SparkSession, rows: DataFrame, ms: str, transform: Callable[[DataFrame], DataFrame], name: str, later: Column | DataFrame | None = None,
    n: int = 3, read: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """What ``transform`` gives for the stream of ``rows``, read when all slices are done."""
    out, checkpoint = paths(spark, name)
    in_slices(spark, rows, ms, lambda landed: jobs.append_to(transform(landed), out, checkpoint), later, n, read)
    return spark.read.parquet(out)


def paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = new_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def finished(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run ``df`` to the end of its input and read the result."""
    out, checkpoint = paths(spark, name)
    jobs.append_to(df, out, checkpoint)
    return spark.read.parquet(out)


@query("a2_ods_ingest_stream", using("log") + "SELECT CAST(event_id AS VARCHAR) AS id, uid AS user_id, ts AS ts_ms FROM log")
def a2_ods_ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes through the ingest job, unchanged, as text."""
    rows = stream(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    out, checkpoint = paths(spark, "ods")
    jobs.ods_ingest(cdc.cdc_snapshot(rows, "cart_info"), out, checkpoint)
    return C.select_table(cdc.parse_envelopes(cdc.file_values(spark, out)), "cart_info", ["id", "user_id"])


@query("b3_upsert_stream", using("order_detail", d=latest(
    "(SELECT id, sku_id, split_total_amount, ts_ms FROM order_detail)", "id", "ts_ms", "sku_id,split_total_amount")) + """
SELECT id, sku_id, split_total_amount, ts_ms FROM d""")
def b3_upsert_stream(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["id", "sku_id", "split_total_amount", "ts_ms"]
    out, checkpoint = paths(spark, "upsert")
    rows = T.lines_of(stream(spark, sf, "lineitem")).select(*columns)
    jobs.upsert(rows, ["id"], ["ts_ms", "sku_id", "split_total_amount"], out, checkpoint)
    return read_keyed(spark, out, ["id"], ["ts_ms", "sku_id", "split_total_amount"]).select(*columns)


@query("b7_memory_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def b7_memory_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The sink for looking at a stream while developing."""
    counts = stream(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    writer = counts.writeStream.format("memory").queryName("event_counts").outputMode("complete")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.table("event_counts")


@query("c11f_five_way_split_stream", using("log", c="SELECT * FROM log WHERE ts % 89 <> 0 AND ts % 97 <> 0", p="SELECT * FROM c WHERE NOT has_start") + """
SELECT 'dirty' AS output, count(*) AS n FROM log WHERE ts % 89 <> 0 AND ts % 97 = 0
UNION ALL SELECT 'err', count(*) FROM c WHERE has_err UNION ALL SELECT 'start', count(*) FROM c WHERE has_start
UNION ALL SELECT 'display', CAST(sum(entries) AS BIGINT) FROM p UNION ALL SELECT 'action', CAST(sum(entries) AS BIGINT) FROM p
UNION ALL SELECT 'page', count(*) FROM p""")
def c11f_five_way_split_stream(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = paths(spark, "split")
    jobs.split_log(T.raw_log(spark, sf, stream(spark, sf, "events")), out, checkpoint)
    return spark.read.parquet(out).groupBy("output").agg(F.count(F.lit(1)).alias("n"))


def _written(outputs: DataFrame) -> DataFrame:
    """What the JSON texts of the log outputs say."""
    at = lambda *path: F.get_json_object("value", "$." + ".".join(path))
    entry = lambda name, a, b: F.concat_ws("/", at(name, a), at(name, b))
    kind = F.col("output")
    detail = (F.when(kind == "dirty", F.col("value")).when(kind == "err", at("err", "error_code")).when(kind == "start", at("start", "loading_time"))
              .when(kind == "display", entry("display", "item", "pos_id")).when(kind == "action", entry("action", "action_id", "item"))
              .otherwise(at("page", "page_id")))
    clean = lambda c: F.when(kind != "dirty", c)
    return outputs.select("output", clean(at("common", "mid")).alias("mid"), clean(at("common", "is_new")).alias("is_new"),
                          clean(at("ts")).cast("bigint").alias("ts"), detail.alias("detail"))


@query("c11_repaired_split_stream", using("log", f=_FIXED, p="SELECT * FROM f WHERE NOT has_start",
                                          e="SELECT *, unnest(range(1, entries + 1)) AS i FROM p WHERE entries > 0") + """
SELECT 'dirty' AS output, NULL AS mid, NULL AS is_new, NULL AS ts, '{"ts": ' || ts AS detail FROM log WHERE ts % 89 <> 0 AND ts % 97 = 0
UNION ALL SELECT 'err', mid, fixed, ts, CAST(event_id % 500 + 1000 AS VARCHAR) FROM f WHERE has_err
UNION ALL SELECT 'start', mid, fixed, ts, CAST(event_id % 1000 AS VARCHAR) FROM f WHERE has_start
UNION ALL SELECT 'display', mid, fixed, ts, (event_id % 100) || '/' || i FROM e
UNION ALL SELECT 'action', mid, fixed, NULL, 'cart_add/' || i FROM e
UNION ALL SELECT 'page', mid, fixed, ts, page_id FROM p""")
def c11_repaired_split_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The log job as one stream: repaired first, then written to its six outputs, over slices of the raw topic."""
    out, checkpoint = paths(spark, "repaired-split")
    topic = T.raw_log(spark, sf, None, F.col("ts").alias("at"))
    in_slices(spark, topic, "at", lambda s: jobs.split_repaired_log(s.select("value"), out, checkpoint, offset=0))
    return _written(spark.read.parquet(out))


@query("a5_source_time_stream", using("log", s="""
  SELECT ts + 7200000 + ts % 3600000 AS at_ms, item FROM log WHERE last_page_id = 'search' AND item_type = 'keyword'""") + f"""
SELECT {bounds('at_ms', HOUR)}, lower(item) AS keyword, count(*) AS keyword_count FROM s GROUP BY ALL""")
def a5_source_time_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Search words in windows of the time at which the source took a record, hours after the time the record holds."""
    log = T.app_log(spark, sf)
    at = F.col("ts") + 7_200_000 + F.col("ts") % 3_600_000
    records = log.select(F.to_json(F.struct(*log.columns)).alias("value"), F.timestamp_millis(at).alias("timestamp"), at.alias("at"))
    search = F.get_json_object("value", "$.page.last_page_id") == "search"
    end = records.filter(search).limit(1).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 400 DAYS"))
    return over_slices(spark, records, "at", lambda s: jobs.keyword_counts_by_source(s, "1 hour", tz="UTC"), "source-time", end,
                       read=lambda path: cdc.landed_topic(spark, path, streaming=True))


#: What tells the rows of a table apart, where it is not ``id``.
_KEY_OF = {"order_detail_activity": "order_detail_id", "order_detail_coupon": "order_detail_id", "user_info_sup_msg": "uid", "payment_info": "order_id"}


def _landed_sql(name: str) -> str:
    op = "op" if name == "cart_info" else "'r'"
    return (f"SELECT '{name}' AS name, {op} AS op, count(*) AS n, count(DISTINCT {_KEY_OF.get(name, 'id')}) AS n_keys, "
            f"CAST(sum(ts_ms % 1000003) AS BIGINT) AS times FROM {name} GROUP BY ALL")


@query("a2_land_by_table_stream", using(*T.SHOP, "cart_info") + " UNION ALL ".join(map(_landed_sql, (*T.SHOP, "cart_info"))))
def a2_land_by_table_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All eleven tables landed from slices of one topic, compacted, and read back by table."""
    out, checkpoint = paths(spark, "land")
    topic = T.change_log(spark, sf).select(F.to_json(F.struct("*")).alias("value"), "ts_ms")
    in_slices(spark, topic, "ts_ms", lambda s: jobs.land_by_table(s.select("value"), out, checkpoint), drop=True)
    cdc.compact_landed(spark, out, f"{out}-compact")
    name, after = F.col("source")["table"], F.col("after")
    key = F.coalesce(*[F.when(name == table, after[column]) for table, column in _KEY_OF.items()], after["id"])
    return cdc.landed_changes(spark, f"{out}-compact").groupBy(name.alias("name"), "op").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"), F.sum(F.col("ts_ms") % 1_000_003).alias("times"))


@query("b5_dim_merge_stream", using("active_config", all_rows=_DIM_ROWS, rows_=_KEPT, cells_=_CELLS) + _MERGED)
def b5_dim_merge_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change log as a text topic, routed batch by batch, and the dimensions read from its change folders."""
    out, checkpoint = paths(spark, "dims")
    topic = new_path(spark, "topic-db")
    sinks.append_values(cdc.to_values(T.dim_envelopes(spark, sf)), topic)
    values = spark.readStream.option("maxFilesPerTrigger", 4).text(topic)
    jobs.dim_sync(values, lambda: C.config_changes(T.config_envelopes(spark, sf)), "shop", out, checkpoint)
    merged = jobs.read_dims(spark, out, C.config_changes(T.config_envelopes(spark, sf)))
    return merged.select("sink_table", "row_key", F.explode("cells").alias("name", "value"))


@query("b5_dim_snapshot_stream", using("active_config", all_rows=_DIM_ROWS, rows_=_KEPT, cells_=_CELLS) + _MERGED)
def b5_dim_snapshot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The dimensions from a snapshot that is renewed after each slice but the last, and the changes after it."""
    out, checkpoint = paths(spark, "dims-snapshot")
    config = C.config_changes(T.config_envelopes(spark, sf))
    topic = T.dim_envelopes(spark, sf).select(F.to_json(F.struct("*")).alias("value"), F.col("ts_ms").cast("bigint").alias("at"))
    done = []

    def run(landed: DataFrame) -> None:
        if done:
            jobs.snapshot_dims(spark, out, f"{out}-snapshots")
        jobs.dim_sync(landed.select("value"), lambda: config, "shop", out, checkpoint)
        done.append(1)

    in_slices(spark, topic, "at", run)
    merged = jobs.read_dims(spark, out, config, f"{out}-snapshots")
    return merged.select("sink_table", "row_key", F.explode("cells").alias("name", "value"))


@query("b6_dim_lifecycle_stream", using("active_config", all_rows=_DIM_ROWS, rows_=_KEPT, cells_=_CELLS) + _MERGED)
def b6_dim_lifecycle_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Early changes are routed before any table is re-created or deleted, later ones after; what is read at the end is what
    one run under the last configuration gives."""
    out, checkpoint = paths(spark, "lifecycle")
    topic = new_path(spark, "lifecycle-topic")
    envelopes, config = T.dim_envelopes(spark, sf), C.config_changes(T.config_envelopes(spark, sf))
    for changes, known in ((envelopes.filter("ts_ms <= 100"), config.filter("op = 'r'")), (envelopes.filter("ts_ms > 100"), config)):
        sinks.append_values(cdc.to_values(changes), topic)
        jobs.dim_sync(spark.readStream.text(topic), lambda known=known: known, "shop", out, checkpoint)
    return jobs.read_dims(spark, out, config).select("sink_table", "row_key", F.explode("cells").alias("name", "value"))


@query("d7_order_interval_stream", using("tag_order_info", "tag_order_detail") + """
SELECT o.id AS order_id, o.user_id AS uid, d.id AS detail_id, d.sku_id, o.ts_ms, d.ts_ms AS detail_ts_ms
FROM tag_order_info o JOIN tag_order_detail d ON o.id = d.order_id
WHERE d.ts_ms BETWEEN o.ts_ms - 120000 AND o.ts_ms + 120000""")
def d7_order_interval_stream(spark: SparkSession, sf: str) -> DataFrame:
    orders = stream(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("uid"),
        T.tag_order_ms("o_orderkey").alias("ts_ms"))
    details = T.lines_of(stream(spark, sf, "lineitem"), tag_month=True).select(
        "order_id", F.col("id").alias("detail_id"), "sku_id", F.col("ts_ms").alias("detail_ts_ms"))
    joined = jobs.interval_join(orders, details, "order_id", "ts_ms", "detail_ts_ms", "2 minutes", copied="left")
    return finished(joined.drop("et"), spark, "order-interval")


def _marker(spark: SparkSession, ts_ms: int, *names: str) -> DataFrame:
    """An envelope of each table at one time, of rows that nothing joins."""
    rows = ", ".join(f"('{n}')" for n in names)
    return spark.sql(f"""
      SELECT CAST(NULL AS map<string,string>) AS before, map('id', 'later ' || t, 'order_id', 'none', 'order_detail_id', 'none') AS after,
        map('db', 'shop', 'table', t) AS source, 'r' AS op, {ts_ms}L AS ts_ms FROM VALUES {rows} AS v(t)""")


@query("d2_order_detail_stream", using(*FACT_NEEDS, **FACT) + "SELECT * FROM fact")
def d2_order_detail_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The whole fact from four slices of the change log. In the test tables an order and its lines lie years apart."""
    out, checkpoint = paths(spark, "order-detail")
    later = _marker(spark, 2_000_000_000_000, *T.TRADE)
    in_slices(spark, T.change_log(spark, sf, *T.TRADE), "ts_ms",
              lambda log: jobs.run_order_detail(log, out, checkpoint, retention="2600 days", tz="UTC"), later, n=4)
    return jobs.read_order_detail(spark, out)


@query("g12_idle_join_stream", using("tag_order_info", "tag_order_detail", near="""
  SELECT o.id AS order_id, o.user_id AS uid, d.id AS detail_id, o.ts_ms AS order_ms, d.ts_ms AS detail_ms
  FROM tag_order_info o JOIN tag_order_detail d ON o.id = d.order_id""", after_="""
  SELECT *, sum(pause) OVER (PARTITION BY order_id ORDER BY detail_ms RANGE UNBOUNDED PRECEDING) AS broken FROM (
    SELECT *, CASE WHEN detail_ms - coalesce(max(detail_ms) OVER (PARTITION BY order_id ORDER BY detail_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      order_ms) > 45000 THEN 1 ELSE 0 END AS pause FROM near WHERE detail_ms >= order_ms)""") + """
SELECT order_id, uid, detail_id, order_ms, detail_ms FROM near WHERE detail_ms < order_ms AND order_ms - detail_ms <= 45000
UNION ALL SELECT order_id, uid, detail_id, order_ms, detail_ms FROM after_ WHERE broken = 0""")
def g12_idle_join_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and lines that are remembered for 45 seconds after their last use: each line that joins keeps its order alive."""
    rows = T.tag_change_log(spark, sf)
    later = _marker(spark, T.MONTH_START_MS + 400 * DAY, "order_info", "order_detail")

    def join(log: DataFrame) -> DataFrame:
        orders = C.orders(log).select(F.col("id").alias("order_id"), F.col("user_id").alias("uid"), F.col("ts_ms").alias("order_ms"))
        lines = C.order_details(log).select("order_id", F.col("id").alias("detail_id"), F.col("ts_ms").alias("detail_ms"))
        return stateful.idle_join(orders, lines, "order_id", "order_ms", "detail_ms", 45_000)

    return over_slices(spark, rows, "ts_ms", join, "idle", later)


@query("f1_keyword_count_stream", using("log", k=f"""
  SELECT {bounds('ts', HOUR)}, lower(item) AS keyword, count(*) AS keyword_count, max(ts // {HOUR}) AS w FROM log
  WHERE last_page_id = 'search' AND item_type = 'keyword' GROUP BY ALL""") + "SELECT * EXCLUDE (w) FROM k")
def f1_keyword_count_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Windows are given out once the watermark has passed them."""
    log = T.app_log(spark, sf)
    search = (F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword")
    return over_slices(spark, log, "ts", lambda s: jobs.keyword_counts(s, "1 hour", tz="UTC"), "keywords", search)


@query("f6_province_orders_stream", using("order_detail", "order_info", v=VERSIONS) + f"""
SELECT {bounds('ts_ms', DAY)}, province_id, count(DISTINCT order_id) AS order_count, CAST(sum(amount) AS DOUBLE) AS order_amount
FROM v GROUP BY ALL""")
def f6_province_orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of the order lines, as the window before retraction sees them."""
    rows = line_versions(spark, sf).select("id", "order_id", "province_id", F.col("split_total_amount").cast("string").alias("split_total_amount"), "ts_ms")
    no_names = spark.createDataFrame([], "id string, name string")
    out = over_slices(spark, rows, "ts_ms", lambda s: jobs.province_orders(s, no_names, "1 day", tz="UTC"), "province", F.lit(True))
    return out.drop("province_name").withColumn("order_amount", F.col("order_amount").cast("double"))


@query("f3_home_detail_stream", using("log") + HOME_DETAIL_SQL)
def f3_home_detail_stream(spark: SparkSession, sf: str) -> DataFrame:
    """First home and product-page visits of the day; the windows are summed when the result is read."""
    visits = L.on_pages(T.app_log(spark, sf), "home", "good_detail").select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    flagged = over_slices(spark, visits, "ts", lambda s: stateful.flag_first_of_day(s, ["mid", "page_id"], "first", offset=0), "home")
    return windows.tumble(flagged.filter("first = 1"), F.timestamp_millis("ts"), "1 hour", [], [
        F.count_if(F.col("page_id") == "home").alias("home_uv_ct"),
        F.count_if(F.col("page_id") == "good_detail").alias("good_detail_uv_ct")], "UTC")


@query("f4_login_users_stream", using("log", days_=LOGIN_DAYS) + LOGIN_SQL)
def f4_login_users_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.logins(T.app_log(spark, sf)).select(F.col("common.uid").alias("uid"), "ts")
    days = over_slices(spark, rows, "ts", lambda s: stateful.login_days(s, offset=0), "login-users")
    return windows.tumble(days, F.timestamp_millis("ts"), "1 hour", [], [
        F.sum("back").alias("back_ct"), F.sum("uu").alias("uu_ct")], "UTC")


@query("g1_is_new_repair_stream", using("log", s="""
  SELECT mid, CASE WHEN is_new = '1' THEN d ELSE d - 1 END AS stored FROM (
    SELECT *, ts // 86400000 AS d, row_number() OVER (PARTITION BY mid ORDER BY ts, is_new) AS rn FROM log) WHERE rn = 1""") + """
SELECT mid, ts, CASE WHEN is_new = '1' AND ts // 86400000 <> stored THEN '0' ELSE is_new END AS is_new
FROM log JOIN s USING (mid)""")
def g1_is_new_repair_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.app_log(spark, sf).select(F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new"))
    return over_slices(spark, rows, "ts", lambda s: stateful.repair_is_new(s, offset=0), "is-new")


@query("g2_first_visit_stream", using("log") + """
SELECT mid, ts, CAST(row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts) = 1 AS BIGINT) AS uv FROM log""")
def g2_first_visit_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.app_log(spark, sf).select(F.col("common.mid").alias("mid"), "ts")
    return over_slices(spark, rows, "ts", lambda s: stateful.flag_first_of_day(s, ["mid"], "uv", offset=0), "first-visit")


@query("g4_login_days_stream", using("log") + LOGIN_DAYS)
def g4_login_days_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.logins(T.app_log(spark, sf)).select(F.col("common.uid").alias("uid"), "ts")
    return over_slices(spark, rows, "ts", lambda s: stateful.login_days(s, offset=0), "login-days")


_CENTS = "SELECT id, CAST(round(CAST(split_total_amount AS DOUBLE) * 100) AS BIGINT) AS cents, ts_ms FROM order_detail"


@query("g5_retract_versions_stream", using("order_detail", c=_CENTS) + """
SELECT id, arg_max(cents, (ts_ms, cents)) AS cents, 2 * count(*) - 1 AS n FROM c GROUP BY id""")
def g5_retract_versions_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Per line what remains after all retractions, and how many records that took."""
    rows = T.lines(spark, sf).select(
        "id", F.round(F.col("split_total_amount").cast("double") * 100).cast("bigint").alias("cents"), "ts_ms")
    out = over_slices(spark, rows, "ts_ms", lambda s: stateful.retract_versions(s, "id", "cents"), "retract")
    return out.groupBy("id").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))


@query("g6_latest_after_wait_stream", using("order_detail") + f"""
SELECT * FROM {latest("(SELECT id, sku_id, split_total_amount, ts_ms FROM order_detail)", "id", "ts_ms", "sku_id,split_total_amount")}""")
def g6_latest_after_wait_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Newest version per line once its wait is over. All versions come in one batch, as they lie years apart."""
    rows = T.lines(spark, sf).select("id", "sku_id", "split_total_amount", "ts_ms")
    later = spark.range(1).select(F.lit("later").alias("id"), F.lit("0").alias("sku_id"), F.lit("0").alias("split_total_amount"),
                                  F.lit(4_000_000_000_000).cast("bigint").alias("ts_ms"))
    return over_slices(spark, rows, "ts_ms", lambda s: stateful.latest_after_wait(s, "id", 5_000), "latest", later, n=1)


@query("g7_first_cart_add_stream", using("cart_info") + """
SELECT DISTINCT user_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day FROM cart_info WHERE op <> 'u' OR sku_num > old_num""")
def g7_first_cart_add_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Cart additions as the batch form selects them, from slices of the cart's change log."""
    firsts = lambda log: jobs.first_of_day(C.cart_adds(log).select("user_id", "ts_ms"), ["user_id"], "ts_ms", "UTC", "0 seconds")
    out = over_slices(spark, T.cart_envelopes(spark, sf), "ts_ms", firsts, "cart-first")
    return out.select("user_id", S.ms_to_date(F.col("ts_ms"), "UTC").alias("day"))


@query("g8_whole_record_dedup_stream", using("log") + f"SELECT DISTINCT * FROM ({DEVICE_SQL})")
def g8_whole_record_dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.device_and_search(log_stream(spark, sf))
    return finished(rows.unionByName(L.device_and_search(log_stream(spark, sf))).dropDuplicates(), spark, "dedup")


@query("g8_daily_dedup_stream", using("log") + f"SELECT DISTINCT uid, ts, vc, ch, ar, os, md, ba, search_item FROM ({DEVICE_SQL})")
def g8_daily_dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Each record twice, an hour's part of a day apart at most: repeats go by the hash of the record, days are forgotten in turn."""
    rows = L.device_and_search(T.app_log(spark, sf))
    again = rows.unionByName(rows).withColumn("_hash", F.xxhash64(*rows.columns))
    return over_slices(spark, again, "ts", lambda s: jobs.drop_repeats(s, ["_hash"], "ts", "UTC"), "daily-dedup").drop("_hash")


_AS_OF = """
  SELECT r.*, c.sink_table, c.valid_from FROM rows_ r JOIN (
    SELECT *, ts_ms AS valid_from, lead(ts_ms) OVER (PARTITION BY source_table ORDER BY ts_ms) AS valid_to FROM config) c
  ON r.source_table = c.source_table AND (c.op = 'r' OR r.ts_ms >= c.valid_from) AND (valid_to IS NULL OR r.ts_ms < valid_to) WHERE c.op <> 'd'"""
_AS_OF_ROWS = "SELECT sink_table, row_key, op, CAST(ts_ms AS BIGINT) AS ts_ms, CAST(valid_from AS BIGINT) AS valid_from FROM (SELECT *, id AS row_key FROM a_)"


@query("d17_config_as_of", using("config", rows_=_DIM_ROWS, a_=_AS_OF) + _AS_OF_ROWS)
def d17_config_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Changes routed by the configuration of their own time."""
    versions = C.config_versions(C.config_changes(T.config_envelopes(spark, sf)))
    routed = C.route_as_of(C.valid_changes(T.dim_envelopes(spark, sf), "shop"), versions)
    return routed.select("sink_table", "row_key", "op", "ts_ms", "valid_from")


@query("d17_config_as_of_stream", using("config", rows_=_DIM_ROWS, a_=_AS_OF) + _AS_OF_ROWS)
def d17_config_as_of_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from slices of the change log, all of them run long after the last change of the configuration."""
    out, checkpoint = paths(spark, "as-of")
    topic = T.dim_envelopes(spark, sf).select(F.to_json(F.struct("*")).alias("value"), F.col("ts_ms").cast("bigint").alias("at"))
    config = C.config_changes(T.config_envelopes(spark, sf))
    in_slices(spark, topic, "at", lambda s: jobs.dim_sync(s.select("value"), lambda: config, "shop", out, checkpoint, as_of=True))
    return spark.read.option("basePath", out).parquet(out).select("sink_table", "row_key", "op", "ts_ms", "valid_from")


@query("g10_strictly_newer_stream", using("log") + """
SELECT uid, ts, during_time FROM (
  SELECT *, max(during_time) OVER (PARTITION BY uid ORDER BY ts, during_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM log) WHERE m IS NULL OR during_time > m""")
def g10_strictly_newer_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.app_log(spark, sf).select(F.col("common.uid").alias("uid"), "ts", "page.during_time")
    return over_slices(spark, rows, "ts", lambda s: stateful.strictly_newer(s, "uid", "during_time", "ts"), "newer")


@query("f9_running_profile_stream", using("log", d=DEVICE_SQL) + running_sql(RUNNING_ORDER, "d"))
def f9_running_profile_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.device_and_search(T.app_log(spark, sf))
    return over_slices(spark, rows, "ts", lambda s: stateful.running_profile(s, ["os", "ch", "md", "ba", "search_item"]), "profile")


@query("f2_traffic_stream", using("log") + TRAFFIC_SQL)
def f2_traffic_stream(spark: SparkSession, sf: str) -> DataFrame:
    """First visits are flagged and stored by the stream; the windows are summed when the result is read."""
    flagged = over_slices(spark, T.app_log(spark, sf), "ts", lambda s: jobs.first_visits(s, offset=0), "traffic")
    return jobs.traffic_windows(flagged, "1 hour", "UTC")


def _windows_closed(spark: SparkSession, sf: str, job: Callable[..., DataFrame], name: str, like: Column) -> DataFrame:
    """The windows that ``job`` gives out over slices of the log, whose last row is a copy of one ``like`` this, much later."""
    return over_slices(spark, T.app_log(spark, sf), "ts", lambda s: job(s, "1 hour", offset=0, tz="UTC"), name, like)


@query("f2_traffic_windows_stream", using("log") + TRAFFIC_SQL)
def f2_traffic_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """First visits and their windows in one query."""
    return _windows_closed(spark, sf, jobs.traffic, "traffic-windows", F.lit(True))


@query("f3_home_detail_windows_stream", using("log") + HOME_DETAIL_SQL)
def f3_home_detail_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _windows_closed(spark, sf, jobs.home_detail, "home-windows", F.col("page.page_id") == "home")


@query("f4_login_users_windows_stream", using("log", days_=LOGIN_DAYS) + LOGIN_SQL)
def f4_login_users_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _windows_closed(spark, sf, jobs.login_users, "login-windows", F.col("page.last_page_id") == "login")


@query("g14_watermark_stream", using("log") + f"""
SELECT {bounds('ts', HOUR)}, count(*) AS n FROM log GROUP BY ALL""")
def g14_watermark_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Windows closed by the watermark. A second copy of the first rows comes after the last of the log, too late to count."""
    rows = T.app_log(spark, sf).select("ts")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    path = new_path(spark, "late")
    out, checkpoint = paths(spark, "late")
    end = spark.range(1).select(F.lit(last + 400 * DAY).cast("bigint").alias("ts"))
    # A batch is checked against the watermark of the one before, so a batch without rows of its own comes between.
    for part in (rows.filter(F.col("ts") < last - DAY), rows.filter(F.col("ts") >= last - DAY).unionByName(end), end,
                 rows.filter(F.col("ts") < first + DAY).unionByName(end)):
        part.write.mode("append").parquet(path)
        timed = cdc.with_event_time(spark.readStream.schema(rows.schema).parquet(path), "ts", "3 seconds")
        jobs.append_to(windows.tumble(timed, F.col("et"), "1 hour", [], [F.count(F.lit(1)).alias("n")], "UTC"), out, checkpoint)
    return spark.read.parquet(out)


@query("d12_chained_interval_stream", using("log", "tag_order_info", "user_info") + """
SELECT l.uid, l.ts AS ts_ms, o.id AS order_id, u.name FROM log l
JOIN tag_order_info o ON l.uid = o.user_id AND o.ts_ms BETWEEN l.ts - 86400000 AND l.ts + 86400000
JOIN user_info u ON l.uid = u.id AND u.ts_ms BETWEEN l.ts - 86400000 AND l.ts + 86400000""")
def d12_chained_interval_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Log, orders and users joined one after the other within a day; one event time survives each join."""
    log = log_stream(spark, sf).select(F.col("common.uid").alias("uid"), F.col("ts").alias("ts_ms"))
    orders = stream(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("uid"), F.col("o_orderkey").cast("string").alias("order_id"),
        T.tag_order_ms("o_orderkey").alias("order_ts_ms"))
    users = stream(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("name"), T.user_ms("c_custkey").alias("user_ts_ms"))
    first = jobs.interval_join(log, orders, "uid", "ts_ms", "order_ts_ms", "1 day").drop("order_ts_ms")
    both = jobs.chain_interval_join(first, users, "uid", "user_ts_ms", "1 day", left_ms="ts_ms", lag="1 day")
    return finished(both.select("uid", "ts_ms", "order_id", "name"), spark, "chain")


