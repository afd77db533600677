"""Streaming forms over several micro-batches, late rows, and replayed batches."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.operators import changelog as C
from tidemark.operators import keyed, logs
from tidemark.operators.intervals import interval_join
from tidemark.plans import standins as T
from tidemark.plans.jobs import dim_sync
from tidemark.session import new_path, shared_dir
from tidemark.sources import cdc, sinks
from tidemark.streaming import jobs, stateful


def in_batches(spark, df, order, n=4):
    """``df`` as a file stream of ``n`` micro-batches in the order of a column."""
    path = new_path(spark, "source")
    low, high = df.agg(F.min(order), F.max(order)).first()
    cut = F.least(F.floor((F.col(order) - low) * n / (high - low + 1)), F.lit(n - 1))
    for i in range(n):
        df.filter(cut == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, df):
    base = new_path(spark, "run")
    jobs.append_to(df, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def bag(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def log(spark, sf):
    return T.app_log(spark, sf)


def test_is_new_repair_over_batches(spark, log):
    rows = log.select("common.mid", "ts", "common.is_new")
    out = run(spark, stateful.repair_is_new(in_batches(spark, rows, "ts"), offset=0))
    assert bag(out) == bag(logs.repair_is_new(log, "UTC").select("common.mid", "ts", "common.is_new"))


def test_first_visit_over_batches(spark, log):
    rows = log.select("common.mid", "ts")
    out = run(spark, stateful.flag_first_of_day(in_batches(spark, rows, "ts"), ["mid"], "uv", offset=0))
    assert bag(out) == bag(keyed.flag_first_of_day(rows, ["mid"], "uv", "ts", "UTC"))


def test_login_days_over_batches(spark, log):
    rows = logs.logins(log).select("common.uid", "ts")
    out = run(spark, stateful.login_days(in_batches(spark, rows, "ts"), offset=0))
    assert bag(out) == bag(keyed.login_days(logs.logins(log), "UTC"))


def test_strictly_newer_over_batches(spark, log):
    rows = log.select("common.uid", "ts", "page.during_time")
    out = run(spark, stateful.strictly_newer(in_batches(spark, rows, "ts"), "uid", "during_time", "ts"))
    assert bag(out) == bag(keyed.strictly_newer(rows, "uid", "during_time", "ts"))


def test_running_profile_over_batches(spark, log):
    rows = logs.device_and_search(log)
    out = run(spark, stateful.running_profile(in_batches(spark, rows, "ts"), keyed.RUNNING_FIELDS))
    assert bag(out) == bag(keyed.running_profile(rows))


def test_retract_over_batches(spark, sf):
    rows = T.lines(spark, sf).select(
        "id", F.round(F.col("split_total_amount").cast("double") * 100).cast("bigint").alias("cents"), "ts_ms")
    out = run(spark, stateful.retract_versions(in_batches(spark, rows, "ts_ms"), "id", "cents"))
    assert bag(out) == bag(keyed.retract_versions(rows, "id", "cents"))


@pytest.fixture(scope="module")
def one_key(spark):
    """30,000 rows of one key over three days, in no order."""
    n = F.col("id")
    ms = F.pmod(n * 7_919_777, F.lit(3 * 86_400_000)) + 86_400_000
    return spark.range(30_000).select(
        F.lit("k").alias("k"), ms.alias("ts"), F.pmod(n * 104_729, F.lit(30_000)).alias("v"), F.when(n % 3 == 0, "1").otherwise("0").alias("is_new"),
        (n % 5).cast("string").alias("os"), n.alias("nr"))


def _forms(rows):
    """Of each operator the stream form of a stream and the batch form, over the same rows."""
    k, ties = ["k"], ["v", "is_new", "os", "nr"]
    log = rows.select(F.struct(F.col("k").alias("mid"), F.col("k").alias("uid"), "is_new").alias("common"), "ts")
    return {
        "first of day": (lambda s: stateful.flag_first_of_day(s, k, "uv", offset=0), keyed.flag_first_of_day(rows, k, "uv", "ts", "UTC", ["ts", *ties])),
        "login days": (lambda s: stateful.login_days(s.select(F.col("k").alias("uid"), "ts"), offset=0), keyed.login_days(log, "UTC")),
        "retraction": (lambda s: stateful.retract_versions(s, "k", "v", "ts"), keyed.retract_versions(rows, "k", "v", ("ts",))),
        "strictly newer": (lambda s: stateful.strictly_newer(s.select("k", "ts", "v"), "k", "v", "ts"),
                           keyed.strictly_newer(rows.select("k", "ts", "v"), "k", "v", "ts")),
        "running profile": (lambda s: stateful.running_profile(s.select(F.col("k").alias("uid"), "ts", "os"), ["os"]),
                            keyed.running_profile(rows.select(F.col("k").alias("uid"), "ts", "os"), ["os"])),
        "is_new": (lambda s: stateful.repair_is_new(s.select(F.col("k").alias("mid"), "ts", "is_new"), offset=0),
                   logs.repair_is_new(log, "UTC").select("common.mid", "ts", "common.is_new")),
    }


@pytest.mark.parametrize("batches", [1, 4])
@pytest.mark.parametrize("name", ["first of day", "login days", "retraction", "strictly newer", "running profile", "is_new"])
def test_one_key_with_many_rows_equals_the_batch_form(spark, one_key, name, batches):
    form, want = _forms(one_key)[name]
    assert bag(run(spark, form(in_batches(spark, one_key, "ts", batches)))) == bag(want)


def test_rows_out_of_order_within_the_delay_still_agree(spark, one_key):
    """Batches cut by a column that has nothing to do with time."""
    out = run(spark, stateful.strictly_newer(in_batches(spark, one_key.select("k", "ts", "v", "nr"), "nr", 4).drop("nr"), "k", "v", "ts", "10 days").filter("true"))
    assert out.count() == 0  # the watermark has not come so far
    late = one_key.select("k", "ts", "v", "nr").unionByName(spark.sql("SELECT 'z' AS k, 9000000000L AS ts, 1L AS v, 40000L AS nr"))
    out = run(spark, stateful.strictly_newer(in_batches(spark, late, "nr", 4).drop("nr"), "k", "v", "ts", "10 days"))
    assert bag(out) == bag(keyed.strictly_newer(one_key.select("k", "ts", "v"), "k", "v", "ts"))


def test_state_is_forgotten_after_its_time(spark):
    rows = spark.createDataFrame([("a", 5, 1_000), ("a", 3, 2_000), ("z", 1, 50_000), ("a", 3, 60_000), ("z", 1, 90_000)], "k string, v bigint, ts bigint")
    kept = run(spark, stateful.strictly_newer(in_batches(spark, rows, "ts", 5), "k", "v", "ts"))
    assert bag(kept) == [("a", 1_000, 5), ("z", 50_000, 1)]
    gone = run(spark, stateful.strictly_newer(in_batches(spark, rows, "ts", 5), "k", "v", "ts", keep=10_000))
    assert bag(gone) == [("a", 1_000, 5), ("a", 60_000, 3), ("z", 50_000, 1), ("z", 90_000, 1)]


def test_latest_after_wait_gives_one_row_per_wait(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1_000), ("a", 2, 2_000), ("b", 1, 3_000), ("a", 3, 60_000), ("z", 0, 200_000)], "id string, v bigint, ts_ms bigint")
    out = run(spark, stateful.latest_after_wait(in_batches(spark, rows, "ts_ms", 2), "id", 5_000))
    assert ("b", 1) in {(r.id, r.v) for r in out.collect()}
    assert {r.v for r in out.collect() if r.id == "a"} <= {2, 3}


def test_late_rows_are_dropped_from_closed_windows(spark):
    """A batch is checked against the watermark its predecessor closed windows by, so the late row comes in batch 3."""
    rows = spark.createDataFrame(
        [(0, 1_000), (1, 100_000), (2, 100_500), (3, 2_000), (4, 200_000)], "batch bigint, ts bigint")
    stream = cdc.with_event_time(in_batches(spark, rows, "batch", 5), "ts", "3 seconds")
    out = run(spark, stream.groupBy(F.window("et", "10 seconds")).agg(F.count("*").alias("n")).select(
        F.unix_millis("window.start").alias("start"), "n"))
    assert dict(map(tuple, out.collect())) == {0: 1, 100_000: 2}


def test_interval_join_over_batches(spark, sf):
    orders = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") * 1_000 + 10_000).alias("a"))
    lines = spark.range(400).select(
        (F.col("id") % 200).cast("string").alias("k"), ((F.col("id") % 200) * 1_000 + F.col("id") * 20 + 6_000).alias("b"))
    joined = jobs.interval_join(
        in_batches(spark, orders, "a"), in_batches(spark, lines, "b"), "k", "a", "b", "2 seconds", "1 hour").drop("et")
    assert bag(run(spark, joined)) == bag(interval_join(orders, lines, "k", "a", "b", 2_000, 2_000))


def near_sides(spark):
    """Rows of 20 keys and of none, the right ones with several types of columns."""
    n = F.col("id")
    key = F.when(n % 20 > 0, (n % 20).cast("string"))
    left = spark.range(300).select(key.alias("k"), n.alias("l"), (n * 1_000 + 1_000_000).alias("a"))
    right = spark.range(400).select(
        key.alias("k"), (n + 9_007_199_254_740_993).alias("r"), (n * 750 + 1_000_000).alias("b"), F.when(n % 3 > 0, F.concat(F.lit('"\\\n'), n)).alias("t"),
        F.when(n % 7 > 0, n.cast("decimal(20,4)") / 8).cast("decimal(20,4)").alias("d"), F.timestamp_micros(n * 1_000_001).alias("at"))
    return left, right


@pytest.mark.parametrize("copied", ["left", "right"])
def test_stream_interval_join_keeps_rows_in_pieces(spark, copied, monkeypatch):
    """Keys and rows of a group share state rows, whichever side is copied, and what the watermark has passed is forgotten."""
    monkeypatch.setattr(stateful, "JOIN_BUCKETS", 4)
    left, right = near_sides(spark)
    joined = jobs.interval_join(in_batches(spark, left, "a"), in_batches(spark, right, "b"), "k", "a", "b", "20 seconds", "1 second", copied)
    base = new_path(spark, "pieces")
    progress = jobs.append_to(joined.drop("et"), f"{base}/out", f"{base}/checkpoint")
    found = spark.read.parquet(f"{base}/out")
    assert found.schema == joined.drop("et").schema
    assert bag(found) == bag(interval_join(left, right, "k", "a", "b", 20_000, 20_000)) and found.count() > 300
    held = jobs.state_rows(progress)
    assert max(held) < 100 and held[-1] < 40


def test_stream_left_joins_follow_an_inner_join(spark):
    """Left rows alone come once, with nulls; a join after that takes its rows although they come behind the watermark."""
    left, right = near_sides(spark)
    other = right.select("k", (F.col("b") + 5).alias("c"), F.col("r").alias("s")).filter("s % 2 = 0")
    sides = [in_batches(spark, df, at) for df, at in ((left, "a"), (right, "b"), (other, "c"))]
    first = jobs.interval_join(sides[0], sides[1].select("k", "b", "r"), "k", "a", "b", "20 seconds", "1 second")
    both = jobs.left_interval_join(first, sides[2], "k", "c", "2 seconds", "1 second", left_ms="a", lag="20 seconds")
    third = sides[1].select("k", F.col("b").alias("e"), F.col("r").alias("u")).filter("u % 5 = 0")
    out = jobs.left_interval_join(both, third, "k", "e", "3 seconds", "1 second", left_ms="a", lag="20 seconds")
    inner = interval_join(left, right.select("k", "b", "r"), "k", "a", "b", 20_000, 20_000)
    near = lambda ms, by: F.col(ms).between(F.col("a") - by, F.col("a") + by)
    want = inner.alias("x").join(other.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & near("c", 2_000), "left").drop("k2")
    late = right.select(F.col("k").alias("k3"), F.col("b").alias("e"), F.col("r").alias("u")).filter("u % 5 = 0")
    want = want.join(late, (F.col("k") == F.col("k3")) & near("e", 3_000), "left").drop("k3")
    # What the last watermark has passed: the times of the last rows may still wait.
    end = 1_000_000 + 299_000 - 30_000
    found = run(spark, out).drop("et")
    assert bag(found.filter(F.col("a") < end)) == bag(want.filter(F.col("a") < end))
    assert found.filter("s is null").count() > 0 and found.filter("u is null").count() > 0 and found.filter("s is not null").count() > 0


def test_a_batch_written_twice_counts_once(spark):
    path = new_path(spark, "keyed")
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "id string, v bigint, ts_ms bigint")
    newer = spark.createDataFrame([("a", 2, 2)], "id string, v bigint, ts_ms bigint")
    for _ in range(2):
        sinks.write_changes(rows, path, 0)
        sinks.write_changes(newer, path, 1)
    assert bag(sinks.read_keyed(spark, path, ["id"], ["ts_ms"])) == [("a", 2, 2), ("b", 1, 1)]


def test_deletes_and_compaction(spark):
    path, target = new_path(spark, "keyed"), new_path(spark, "compact")
    schema = "id string, v bigint, ts_ms bigint, op string"
    sinks.write_changes(spark.createDataFrame([("a", 1, 1, "c"), ("b", 1, 1, "c")], schema), path, 0)
    sinks.write_changes(spark.createDataFrame([("a", None, 2, "d")], schema), path, 1)
    gone = F.col("op") == "d"
    assert [r.id for r in sinks.read_keyed(spark, path, ["id"], ["ts_ms"], gone).collect()] == ["b"]
    sinks.compact(spark, path, target, ["id"], ["ts_ms"], gone)
    assert bag(sinks.read_keyed(spark, target, ["id"], ["ts_ms"])) == [("b", "c", 1, 1)]


def test_dim_sync_restarts_where_it_stopped(spark, sf):
    """Two runs over a growing topic give what one run over all of it gives."""
    topic, base = new_path(spark, "topic"), new_path(spark, "dims")
    log = T.dim_envelopes(spark, sf)
    config = lambda: C.config_changes(T.config_envelopes(spark, sf))
    for part in (F.col("ts_ms") <= 100, F.col("ts_ms") > 100):
        sinks.append_values(cdc.to_values(log.filter(part)), topic)
        jobs.dim_sync(spark.readStream.text(topic), config, "shop", f"{base}/out", f"{base}/checkpoint")
    whole = dim_sync(cdc.to_values(log), config(), "shop")
    pick = lambda df: df.select("sink_table", "row_key", F.to_json("cells").alias("cells"))
    assert bag(pick(jobs.read_dims(spark, f"{base}/out", config()))) == bag(pick(whole))


def test_a_new_checkpoint_does_not_overwrite(spark):
    base = new_path(spark, "two-streams")
    for name in ("a", "b"):
        rows = spark.createDataFrame([(name, 1, 1)], "id string, v bigint, ts_ms bigint")
        for _ in range(2):  # the second run finds its checkpoint and nothing new
            jobs.upsert(in_batches(spark, rows, "ts_ms", 1), ["id"], ["ts_ms"], f"{base}/out", f"{base}/checkpoint-{name}-{_}")
    assert bag(sinks.read_keyed(spark, f"{base}/out", ["id"], ["ts_ms"])) == [("a", 1, 1), ("b", 1, 1)]


def test_dropped_dimensions_are_gone_on_read(spark):
    base, fields = new_path(spark, "dropped"), ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
    row = ("t", "dim_t", "id,name", "info", "id")
    config = spark.createDataFrame([(*row, "r", 1), (*row, "u", 20), (*row, "d", 40)], [*fields, "op", "ts_ms"])
    envelope = lambda k, ts: spark.sql(
        f"SELECT CAST(NULL AS map<string,string>) before, map('id', '{k}', 'name', 'n{k}') after, map('db', 'shop', 'table', 't') source, 'c' op, {ts}L ts_ms")
    for upto, rows in ((1, envelope(1, 10)), (20, envelope(2, 30))):
        sinks.append_values(cdc.to_values(rows), f"{base}/topic")
        jobs.dim_sync(spark.readStream.text(f"{base}/topic"), lambda upto=upto: config.filter(f"ts_ms <= {upto}"), "shop", f"{base}/out", f"{base}/checkpoint")
    read = lambda upto: {r["row_key"] for r in jobs.read_dims(spark, f"{base}/out", config.filter(f"ts_ms <= {upto}")).collect()}
    assert (read(1), read(20), read(40)) == ({"1", "2"}, {"2"}, set())


def table_stream(spark, rows, schema):
    """Rows as a file stream that can grow: (stream, function that adds rows)."""
    path = new_path(spark, "growing")
    add = lambda more: spark.createDataFrame(more, schema).write.mode("append").parquet(path)
    add(rows)
    return spark.readStream.schema(schema).parquet(path), add


def envelope(table, ts, **after):
    return (None, {k: str(v) for k, v in after.items()}, {"db": "shop", "table": table}, "r", ts)


LOG = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"


def test_order_detail_gives_nulls_on_the_watermark_and_corrects_them(spark):
    """A line without activity goes out once the watermark has passed it; the activity that comes after that is put right on reading."""
    base = new_path(spark, "fact")
    line = lambda k, ts: envelope("order_detail", ts, id=f"l{k}", order_id="o", sku_id="s", create_time=ts, sku_num=1, order_price="2.5")
    side = lambda k, ts: envelope("order_detail_activity", ts, order_detail_id=f"l{k}", activity_id="A", activity_rule_id="R")
    ends = lambda ts: [envelope("order_info", ts, id="x", user_id="u"), envelope("order_detail", ts, id="x", order_id="none"),
                       envelope("order_detail_activity", ts, order_detail_id="none"), envelope("order_detail_coupon", ts, order_detail_id="none")]
    day = 86_400_000
    slices = [[envelope("order_info", day, id="o", user_id="u1", province_id="7"), line(1, day + 1000), line(2, day + 2000), side(1, day + 1500)],
              ends(day + 7_200_000),  # both lines are out of the joins from here on
              [side(2, day + 8_000_000), *ends(day + 9_000_000)]]
    seen = []
    stream, add = None, None
    for some in slices:
        if stream is None:
            stream, add = table_stream(spark, some, LOG)
        else:
            add(some)
        jobs.run_order_detail(stream, f"{base}/out", f"{base}/checkpoint", tz="UTC")
        try:
            seen.append({(r["id"], r["user_id"], r["activity_id"], r["activity_rule_id"]) for r in jobs.read_order_detail(spark, f"{base}/out").collect()})
        except Exception:  # nothing is written yet
            seen.append(set())
    assert seen[0] <= {("l1", "u1", "A", "R")}
    assert seen[1] == {("l1", "u1", "A", "R"), ("l2", "u1", None, None)}
    assert seen[2] == {("l1", "u1", "A", "R"), ("l2", "u1", "A", "R")}
    assert len(jobs.read_order_detail(spark, f"{base}/out").columns) == 17


def test_joined_rows_stay_and_idle_rows_go(spark):
    """1,805 seconds after its last use a row is forgotten; being joined is use."""
    at = lambda seconds: (seconds + 5_000) * 1_000
    orders = [("a", "A", at(0)), ("b", "B", at(0)), ("z", "Z", at(9_000)), ("z", "Z", at(19_000))]
    lines = [("a", 1, at(1_805)), ("a", 2, at(3_610)), ("a", 3, at(5_416)), ("b", 4, at(1_806)), ("z", 5, at(9_001)), ("z", 6, at(19_000))]
    left, _ = table_stream(spark, orders, "k string, name string, a bigint")
    right, _ = table_stream(spark, lines, "k string, nr bigint, b bigint")
    base = new_path(spark, "idle")
    progress = jobs.append_to(stateful.idle_join(left, right, "k", "a", "b", 1_805_000), f"{base}/out", f"{base}/checkpoint")
    rows = {(r["name"], r["nr"]) for r in spark.read.parquet(f"{base}/out").collect()}
    assert rows == {("A", 1), ("A", 2), ("Z", 5), ("Z", 6)}
    held = jobs.state_rows(progress)
    assert max(held) > held[-1]


def test_idle_join_over_batches_equals_one_batch(spark):
    rows = spark.range(600).select((F.col("id") % 20).cast("string").alias("k"), (F.col("id") % 3).alias("side"), F.col("id").alias("nr"),
                                   (F.pmod(F.col("id") * 7919, F.lit(100_000)) + 1_000_000).alias("ts"))

    def join(s):
        one = s.filter("side = 0").select("k", F.col("nr").alias("a"), F.col("ts").alias("a_ms"))
        other = s.filter("side > 0").select("k", F.col("nr").alias("b"), F.col("ts").alias("b_ms"))
        return stateful.idle_join(one, other, "k", "a_ms", "b_ms", 8_000)

    found = [bag(run(spark, join(in_batches(spark, rows, "ts", n)))) for n in (1, 4)]
    want, live = [], {}
    for r in sorted(rows.collect(), key=lambda r: (r["ts"], min(r["side"], 1), r["nr"])):
        side = min(r["side"], 1)
        for e in live.get((r["k"], 1 - side), []):
            if r["ts"] - e[0] <= 8_000:
                e[0] = r["ts"]
                a, b = (r, e[1]) if side == 0 else (e[1], r)
                want.append((a["nr"], a["ts"], b["nr"], b["ts"], r["k"]))
        live.setdefault((r["k"], side), []).append([r["ts"], r])
    assert found[0] == found[1] == sorted(want, key=str) and want


def test_repaired_split_writes_the_json_of_the_batch_job(spark, sf):
    """All six outputs, text for text, over batches; texts that are no records, or have no device, pass."""
    from tidemark.plans import jobs as batch

    topic = T.raw_log(spark, sf, None, F.col("ts").alias("at"))
    odd = spark.createDataFrame([('{"ts": 5}', 1_704_100_000_000), ("[1]", 1_704_100_000_001), ('{"common": {"mid": null, "is_new": "1"}, "ts": 7}', 1_704_100_000_002),
                                 ("", 1_704_100_000_003)], "value string, at bigint")
    topic = topic.unionByName(odd)
    base = new_path(spark, "split")
    jobs.split_repaired_log(in_batches(spark, topic, "at").select("value"), f"{base}/out", f"{base}/checkpoint", offset=0)
    got = bag(spark.read.parquet(f"{base}/out").select("output", "value"))
    assert got == bag(batch.dwd_base_log_outputs(topic.select("value"), "UTC").select("output", "value"))
    assert {o for o, _ in got} == {"dirty", "err", "start", "display", "action", "page"}


def test_windows_follow_the_time_of_the_source(spark):
    """Payloads of one hour that the source took in two others."""
    text = lambda word: f'{{"page": {{"last_page_id": "search", "item_type": "keyword", "item": "{word}"}}, "ts": 1000}}'
    rows = [(text("red"), 5), (text("red"), 6), (text("blue"), 3_600_005), (text("end"), 90_000_000)]
    path = new_path(spark, "taken")
    spark.createDataFrame(rows, "value string, ms bigint").select("value", F.timestamp_millis("ms").alias("timestamp")).write.parquet(path)
    out = run(spark, jobs.keyword_counts_by_source(cdc.landed_topic(spark, path, streaming=True), "1 hour", tz="UTC"))
    assert {(r["stt"], r["keyword"], r["keyword_count"]) for r in out.collect()} == {
        ("1970-01-01 00:00:00", "red", 2), ("1970-01-01 01:00:00", "blue", 1)}


def test_text_files_have_the_time_they_were_written(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    import os

    os.utime(tmp_path / "a.txt", (1_000_000, 1_000_000))
    rows = cdc.landed_texts(spark, str(tmp_path)).select("value", F.unix_seconds("timestamp")).collect()
    assert sorted(map(tuple, rows)) == [("one", 1_000_000), ("two", 1_000_000)]


def test_landing_a_batch_twice_changes_nothing(spark, sf):
    path, target = new_path(spark, "landed"), new_path(spark, "landed-compact")
    values = cdc.to_values(T.change_log(spark, sf, "order_info", "cart_info"))
    for batch_id in (0, 1, 1):
        jobs.land_changes(values.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == batch_id), path, batch_id, "one")
    cdc.compact_landed(spark, path, target)
    want = bag(cdc.parse_envelopes(values).select(F.to_json(F.struct("*")).alias("v")))
    for place in (path, target):
        assert bag(cdc.landed_changes(spark, place).select(F.to_json(F.struct("*")).alias("v"))) == want


def test_slices_are_stored_once(spark):
    """What lands for a stream is not stored a second time, and all of it is read."""
    from tidemark.plans.catalog.stream_queries import in_slices

    base = Path(shared_dir(spark)) / "tidemark"
    before = set(base.glob("*"))
    seen = []
    rows = spark.range(300).select((F.col("id") * 1_000).alias("ts"))
    in_slices(spark, rows, "ts", lambda s: seen.append(s.isStreaming))
    stored = [spark.read.parquet(str(p)).count() for p in set(base.glob("*")) - before]
    assert seen == [True] * 3 and sum(stored) == 300


def test_compaction_needs_no_shuffle(spark, monkeypatch):
    """Tables are read one by one; what is written has no exchange, and writing by table no sort."""
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.col("id").alias("ts_ms"))
    path = new_path(spark, "landing")
    for batch, name in enumerate(("order_info", "cart_info", "order_info")):
        cdc.land_changes(cdc.to_values(cdc.cdc_snapshot(rows, name)), path, batch)
    plans = []
    write = DataFrame.write.fget
    monkeypatch.setattr(DataFrame, "write", property(lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)))
    cdc.compact_landed(spark, path, f"{path}-compact")
    assert plans and not any("Exchange" in plan for plan in plans)
    assert cdc.landed_changes(spark, f"{path}-compact").count() == 120


def test_late_rows_are_counted(spark):
    rows = spark.createDataFrame([(0, 1_000), (1, 100_000), (2, 100_500), (3, 2_000), (4, 3_000), (5, 200_000)], "batch bigint, ts bigint")
    timed = cdc.with_event_time(in_batches(spark, rows, "batch", 6), "ts", "3 seconds")
    base = new_path(spark, "late")
    progress = jobs.append_to(timed.groupBy(F.window("et", "10 seconds")).count().select("count"), f"{base}/out", f"{base}/checkpoint")
    assert jobs.late_rows(progress) == 2


def test_a_hot_key_is_held_by_slices(spark, one_key, monkeypatch):
    """No more rows than those of one slice are in a list at once."""
    rows = one_key.select("k", "ts", "v")
    most = rows.groupBy(F.floor(F.col("ts") / stateful.SLICE_MS)).count().agg(F.max("count")).first()[0]

    class Watched(stateful.StrictlyNewer):
        def _take(self, part, pieces):
            found = super()._take(part, pieces)
            assert len(found) <= most, len(found)
            return found

    monkeypatch.setattr(stateful, "StrictlyNewer", Watched)
    out = run(spark, stateful.strictly_newer(in_batches(spark, rows, "ts", 2), "k", "v", "ts"))
    assert bag(out) == bag(keyed.strictly_newer(rows, "k", "v", "ts")) and most < 1_000


def test_state_is_kept_for_many_keys_at_once(spark):
    """Keys and hours of one row each do not cost a state row each, while they wait or after."""
    rows = spark.range(6_000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 3_600_000 + 86_400_000).alias("ts"), F.col("id").alias("v"))
    base = new_path(spark, "many")
    progress = jobs.append_to(stateful.strictly_newer(in_batches(spark, rows, "ts", 2), "k", "v", "ts"), f"{base}/out", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/out").count() == 6_000
    assert max(jobs.state_rows(progress)) < 6_000


def test_daily_deduplication_keeps_a_day_of_state(spark):
    """Thirty days of rows, each twice on its day: the state never holds more than two days of them."""
    n = F.col("id")
    rows = spark.range(30 * 40).select((n % 40).alias("v"), (F.expr("id div 40") * 86_400_000 + 86_400_000 + n % 40 * 1_000).alias("ts"))
    twice = rows.unionByName(rows.withColumn("ts", F.col("ts") + 3_600_000))
    base = new_path(spark, "daily")
    progress = jobs.append_to(jobs.drop_repeats(in_batches(spark, twice, "ts", 10), ["v"], "ts", "UTC"), f"{base}/out", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/out").count() == 30 * 40
    held = jobs.state_rows(progress)
    assert max(held) <= 4 * 40 and held[-1] <= 40


def test_days_of_deduplication_are_those_of_the_zone(spark):
    rows = spark.createDataFrame([("a", 86_400_000 + 57_599_000), ("a", 86_400_000 + 57_600_000), ("a", 86_400_000 + 60_000_000)], "k string, ts bigint")
    out = run(spark, jobs.drop_repeats(in_batches(spark, rows, "ts", 3), ["k"], "ts", "Asia/Shanghai"))
    assert sorted(r["ts"] for r in out.collect()) == [86_400_000 + 57_599_000, 86_400_000 + 57_600_000]


def test_rows_are_routed_by_the_configuration_of_their_time(spark):
    fields = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
    versions = [("t", "old", "id", "info", "id", "r", 10), ("t", "new", "id,name", "info", "id", "u", 20), ("t", "new", "id,name", "info", "id", "d", 40)]
    config = spark.createDataFrame(versions, [*fields, "op", "ts_ms"])
    envelope_of = lambda k, ts: spark.sql(
        f"SELECT CAST(NULL AS map<string,string>) before, map('id', '{k}', 'name', 'n') after, map('db', 'shop', 'table', 't') source, 'c' op, {ts}L ts_ms")
    base = new_path(spark, "as-of")
    for batch in ([(1, 5), (4, 25)], [(2, 19), (3, 20), (5, 40), (6, 50)]):
        for k, ts in batch:
            sinks.append_values(cdc.to_values(envelope_of(k, ts)), f"{base}/topic")
        jobs.dim_sync(spark.readStream.text(f"{base}/topic"), lambda: config, "shop", f"{base}/out", f"{base}/checkpoint", as_of=True)
    rows = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out").collect()
    assert {(r["row_key"], r["sink_table"], len(r["cells"])) for r in rows} == {("1", "old", 1), ("2", "old", 1), ("3", "new", 2), ("4", "new", 2)}


def test_dimensions_are_read_from_a_snapshot_and_the_changes_after_it(spark, sf):
    base, log = new_path(spark, "snapshots"), T.dim_envelopes(spark, sf)
    config = C.config_changes(T.config_envelopes(spark, sf))
    pick = lambda df: bag(df.select("sink_table", "row_key", F.to_json("cells").alias("cells")))
    for k, part in enumerate(("ts_ms < 100", "ts_ms = 100", "ts_ms = 200", "ts_ms >= 300")):
        sinks.append_values(cdc.to_values(log.filter(part)), f"{base}/topic")
        jobs.dim_sync(spark.readStream.text(f"{base}/topic"), lambda: config, "shop", f"{base}/out", f"{base}/checkpoint")
        if k in (1, 2):
            jobs.snapshot_dims(spark, f"{base}/out", f"{base}/snapshots")
    whole = pick(jobs.read_dims(spark, f"{base}/out", config))
    assert pick(jobs.read_dims(spark, f"{base}/out", config, f"{base}/snapshots")) == whole == pick(dim_sync(cdc.to_values(log), config, "shop"))
    # A snapshot without its manifest, as one that was cut off, does not count.
    spark.range(1).write.parquet(f"{base}/snapshots/rows/snapshot=9")
    read = jobs._dim_changes(spark, f"{base}/out", f"{base}/snapshots")
    assert pick(jobs.read_dims(spark, f"{base}/out", config, f"{base}/snapshots")) == whole
    assert {r["batch_id"] for r in read.select("batch_id").distinct().collect()} == {None, 3}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan


def test_a_topic_goes_when_it_has_landed(spark):
    """What lands for a stream can go once all of it has been run; what the stream wrote stays."""
    from tidemark.plans.catalog.stream_queries import in_slices

    base = Path(shared_dir(spark)) / "tidemark"
    before = set(base.glob("*"))
    out, checkpoint = new_path(spark, "passed"), new_path(spark, "passed-checkpoint")
    rows = spark.range(300).select((F.col("id") * 1_000).alias("ts"))
    in_slices(spark, rows, "ts", lambda s: jobs.append_to(s, out, checkpoint), drop=True)
    assert {p.name for p in set(base.glob("*")) - before} == {Path(out).name, Path(checkpoint).name}
    assert spark.read.parquet(out).count() == 300
