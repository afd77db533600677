"""Hand-made rows for the rules that whole-table checks may not reach."""

from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions import scores as M
from tidemark.operators import changelog as C
from tidemark.operators import facts, intervals, keyed, logs, tags, windows
from tidemark.plans import jobs
from tidemark.schemas import APP_LOG, ENVELOPE
from tidemark.sources.cdc import cdc_snapshot

DAY = 86_400_000


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def log_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# -- parsing and splitting ------------------------------------------------------------------------------


def test_dirty_texts_and_null_payload(spark):
    values = log_of(spark, "not json", "", None, '{"ts": 1}', '[1]', '{"common": null, "ts": 2}', '{"ts": 3')
    assert sorted(r[0] for r in logs.dirty_rows(values).collect()) == ["", "[1]", "not json", '{"ts": 3']
    assert sorted(r.ts for r in logs.parsed_log(values).collect()) == [1, 2]


def test_record_with_error_and_start(spark):
    both = logs.parsed_log(log_of(spark, '{"common":{"mid":"m"},"err":{"c":"1"},"start":{"e":"2"},"displays":[{"i":"1"}],"ts":1}'))
    counts = {name: part.count() for name, part in logs.split_log(both).items()}
    assert counts == {"err": 1, "start": 1, "display": 0, "action": 0, "page": 0}
    assert "err" not in logs.start_log(both).columns


def test_empty_arrays_give_no_displays_but_a_page(spark):
    log = logs.parsed_log(log_of(spark, '{"common":{"mid":"m"},"page":{"page_id":"home"},"displays":[],"actions":[{"a":"1"}],"ts":1}'))
    counts = {name: part.count() for name, part in logs.split_log(log).items()}
    assert counts == {"err": 0, "start": 0, "display": 0, "action": 1, "page": 1}
    assert logs.action_log(log).columns == ["common", "page", "action"]
    assert "ts" in logs.action_log(log, with_ts=True).columns


def test_device_projection_defaults(spark):
    log = logs.parsed_log(log_of(
        spark, '{"common":{"os":"iOS 13.2"},"page":{"item_type":"keyword","item":"w"},"ts":5}', '{"ts":6}',
        '{"common":{"uid":"u","os":"Android 11"},"page":{"item_type":"sku","item":"w"},"ts":7}'))
    rows = {r.ts: (r.uid, r.os, r.search_item) for r in logs.device_and_search(log).collect()}
    assert rows == {5: ("-1", "iOS", "w"), 7: ("u", "Android", None)}


@pytest.mark.parametrize("flags, fixed", [
    ([("1", 0), ("1", 1)], ["1", "0"]),
    ([("0", 0), ("1", 1)], ["0", "0"]),
    ([("0", 1), ("1", 1)], ["0", "0"]),
    ([("1", 0), ("1", 0), ("0", 3)], ["1", "1", "0"]),
])
def test_is_new_repair(spark, flags, fixed):
    texts = [f'{{"common":{{"mid":"m","is_new":"{f}"}},"ts":{d * DAY + i}}}' for i, (f, d) in enumerate(flags)]
    out = logs.repair_is_new(logs.parsed_log(log_of(spark, *texts)), "UTC").orderBy("ts")
    assert [r[0] for r in out.select("common.is_new").collect()] == fixed


# -- change log -----------------------------------------------------------------------------------------


def envelopes(spark, *rows):
    return spark.createDataFrame([
        (before, after, {"db": db, "table": table}, op, ts) for db, table, op, before, after, ts in rows], ENVELOPE)


def test_cart_delta(spark):
    rows = envelopes(
        spark, ("s", "cart_info", "r", None, {"id": "1", "sku_num": "2"}, 1),
        ("s", "cart_info", "u", {"sku_num": "2"}, {"id": "2", "sku_num": "5"}, 1),
        ("s", "cart_info", "u", {"sku_num": "5"}, {"id": "3", "sku_num": "5"}, 1),
        ("s", "cart_info", "u", {"sku_num": "5"}, {"id": "4", "sku_num": "1"}, 1),
        ("s", "cart_info", "c", None, {"id": "5", "sku_num": "4"}, 1), ("s", "cart_info", "d", {"id": "6"}, None, 1))
    assert {r.id: r.sku_num for r in C.cart_adds(rows).collect()} == {"1": "2", "2": "3", "5": "4"}
    assert {r.id: r.sku_num for r in C.cart_adds(rows, "as_written").collect()} == {"1": "2"}


def test_order_cancel_precedence(spark):
    rows = envelopes(
        spark, ("s", "order_info", "r", None, {"id": "1", "order_status": "1001"}, 1),
        ("s", "order_info", "u", None, {"id": "2", "order_status": "1001"}, 1),
        ("s", "order_info", "u", None, {"id": "3", "order_status": "1003"}, 1),
        ("s", "other", "c", None, {"id": "4", "order_status": "1003"}, 1))
    assert sorted(r.id for r in C.cancelled_orders(rows).collect()) == ["1"]
    assert sorted(r.id for r in C.cancelled_orders(rows, strict=False).collect()) == ["1", "3", "4"]


def test_valid_changes(spark):
    rows = envelopes(
        spark, ("s", "t", "c", None, {"id": "1"}, 1), ("s", "t", "c", None, {}, 1), ("s", "t", "x", None, {"id": "2"}, 1),
        ("o", "t", "c", None, {"id": "3"}, 1), ("s", "t", "d", {"id": "4"}, None, 1), ("s", "t", "u", None, None, 1))
    assert [r.op for r in C.valid_changes(rows, "s").orderBy("op").collect()] == ["c", "d"]
    assert [r.op for r in C.valid_changes(rows, "s", keep_deletes=False).collect()] == ["c"]


def config(spark, *rows):
    return spark.createDataFrame(
        [(t, f"dim_{t}", cols, "info", "id", op, ts) for t, cols, op, ts in rows],
        "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, op string, ts_ms bigint")


def test_config_insert_update_delete(spark):
    rows = config(spark, ("a", "id", "r", 1), ("a", "id,n", "u", 5), ("b", "id", "c", 2), ("b", "id", "d", 6), ("c", "id", "c", 3))
    got = {r.source_table: (r.sink_columns, r.emptied_at) for r in C.active_config(rows).collect()}
    assert got == {"a": ("id,n", 5), "c": ("id", None)}


def test_blank_cell_keeps_the_older_one_and_delete_drops_all(spark):
    log = envelopes(
        spark, ("s", "a", "r", None, {"id": "1", "n": "x", "drop": "y"}, 1), ("s", "a", "u", None, {"id": "1", "n": ""}, 2),
        ("s", "a", "r", None, {"id": "2", "n": "x"}, 1), ("s", "a", "d", {"id": "2", "n": "x"}, None, 3),
        ("s", "a", "r", None, {"id": "3", "n": "x"}, 1), ("s", "a", "d", {"id": "3"}, None, 2),
        ("s", "a", "c", None, {"id": "3"}, 4), ("s", "unknown", "c", None, {"id": "9"}, 4))
    merged = C.merge_dims(C.route(log, C.active_config(config(spark, ("a", "id,n", "r", 0)))))
    assert {r.row_key: r.cells for r in merged.collect()} == {"1": {"id": "1", "n": "x"}, "3": {"id": "3"}}
    table = C.dim_table(merged, "dim_a", ["n"])
    assert {r.row_key: r.n for r in table.collect()} == {"1": "x", "3": None}


# -- state ----------------------------------------------------------------------------------------------


def test_login_back_after_eight_days(spark):
    late = DAY - 1
    rows = [("a", 0), ("a", 7 * DAY + late), ("b", late), ("b", 8 * DAY), ("c", 0), ("c", 9 * DAY), ("c", 9 * DAY + 5)]
    log = spark.createDataFrame(rows, "uid string, ts bigint").select(F.struct("uid").alias("common"), "ts")
    got = sorted((r.uid, r.ts, r.back) for r in keyed.login_days(log, "UTC").collect())
    assert got == [("a", 0, 0), ("a", 7 * DAY + late, 0), ("b", late, 0), ("b", 8 * DAY, 1), ("c", 0, 0), ("c", 9 * DAY, 1)]


def versions(spark):
    rows = [("1", "o", "p", -5.0, 10), ("1", "o", "p", 7.0, 20), ("1", "o", "p", 7.0, 20), ("2", "o", "p", 1.0, 5)]
    return spark.createDataFrame(rows, "id string, order_id string, province_id string, split_total_amount double, ts_ms bigint").withColumn(
        "split_total_amount", F.col("split_total_amount").cast("decimal(18,2)"))


def test_retract_negates_every_superseded_version(spark):
    out = keyed.retract_versions(versions(spark), "id", "split_total_amount")
    got = sorted((r.id, float(r.split_total_amount), r.ts_ms) for r in out.collect())
    assert got == [("1", -7.0, 20), ("1", -5.0, 10), ("1", 5.0, 10), ("1", 7.0, 20), ("1", 7.0, 20), ("2", 1.0, 5)]


def test_settled_versions_equal_the_retracting_stream(spark):
    retracting = keyed.retract_versions(versions(spark), "id", "split_total_amount")
    a = windows.province_orders(retracting, "1 millisecond", "UTC").collect()
    b = windows.province_orders(windows.settled_versions(versions(spark)), "1 millisecond", "UTC").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_summing_by_order_first_gives_the_same_provinces(spark):
    settled = windows.settled_versions(versions(spark))
    orders = spark.createDataFrame([("o", "p")], "order_id string, province_id string")
    a = windows.province_orders(settled, "1 millisecond", "UTC").collect()
    b = windows.province_orders_by_order(settled.drop("province_id"), orders, "1 millisecond", "UTC").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_latest_is_settled_by_the_other_columns_on_equal_times(spark):
    assert sorted((r.id, float(r.split_total_amount)) for r in keyed.latest_orders(versions(spark)).collect()) == [("1", 7.0), ("2", 1.0)]


def test_strictly_newer_drops_equal_values(spark):
    rows = spark.createDataFrame([("k", 1, 5), ("k", 2, 5), ("k", 3, 4), ("k", 4, 6), ("l", 9, 1)], "k string, at bigint, v bigint")
    assert sorted((r.k, r.at) for r in keyed.strictly_newer(rows, "k", "v", "at", slice_ms=2).collect()) == [("k", 1), ("k", 4), ("l", 9)]


def test_interval_bounds_are_inclusive(spark):
    left = spark.createDataFrame([("k", 1_000)], "k string, a bigint")
    right = spark.createDataFrame([("k", t) for t in (899, 900, 1_000, 1_200, 1_201)] + [("x", 1_000), ("k", None)], "k string, b bigint")
    out = intervals.interval_join(left, right, "k", "a", "b", before=100, after=200)
    assert sorted(r.b for r in out.collect()) == [900, 1_000, 1_200]


def test_interval_join_of_equal_times(spark):
    left = spark.createDataFrame([("k", 5), ("k", 6)], "k string, a bigint")
    right = spark.createDataFrame([("k", 5)], "k string, b bigint")
    assert [r.a for r in intervals.interval_join(left, right, "k", "a", "b", 0, 0).collect()] == [5]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id string, order_id string, province_id string, split_total_amount decimal(18,2), ts_ms bigint")
    assert windows.province_orders(windows.settled_versions(empty)).count() == 0
    assert keyed.retract_versions(empty, "id", "split_total_amount").count() == 0


# -- scalars ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("birth, today, age", [
    ("2004-02-29", "2025-02-28", 20), ("2004-02-29", "2025-03-01", 21), ("2000-06-15", "2024-06-15", 24),
    ("2000-06-16", "2024-06-15", 23)])
def test_age(spark, birth, today, age):
    assert one(spark, S.age_years(F.lit(date.fromisoformat(birth)), F.lit(date.fromisoformat(today)))) == age


@pytest.mark.parametrize("day, sign, variant", [
    ("2000-10-22", "天秤座", "天秤座"), ("2000-10-23", "天蝎座", "天秤座"), ("2000-10-24", "天蝎座", "天蝎座"),
    ("2000-12-21", "射手座", "射手座"), ("2000-12-22", "摩羯座", "摩羯座"), ("2000-01-19", "摩羯座", "摩羯座"),
    ("2000-01-20", "水瓶座", "水瓶座")])
def test_zodiac(spark, day, sign, variant):
    born = F.lit(date.fromisoformat(day))
    assert (one(spark, S.zodiac(born)), one(spark, S.zodiac(born, late_scorpio=True))) == (sign, variant)


def test_pay_slots(spark):
    hours = [5, 6, 8, 9, 11, 12, 13, 14, 17, 18, 21, 22]
    slots = [one(spark, S.pay_slot(F.lit(h * 3_600_000), "UTC")) for h in hours]
    assert slots == ["凌晨", "早晨", "早晨", "上午", "上午", "中午", "中午", "下午", "下午", "晚上", "晚上", "夜间"]
    assert one(spark, S.pay_slot(F.lit(0))) == "早晨"  # midnight UTC is 8 in the business zone


def test_texts(spark):
    assert one(spark, S.text_to_ms(F.lit("1970-01-01 08:00:00"))) == 0
    assert one(spark, S.text_to_ms(F.lit("no date"))) is None
    assert one(spark, S.date_id(F.lit("x"))) is None
    assert one(spark, S.product_text(F.lit("3"), F.lit("19.90"))) == "59.7000"
    assert (S.snake_to_camel("sink_row_key"), S.camel_to_snake("sinkRowKey")) == ("sinkRowKey", "sink_row_key")


# -- scores -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("amount, first", [
    ("999.99", "0.120"), ("1000", "0.015"), ("1000.01", "0.030"), ("3999.99", "0.030"), ("4000", "0.015"), (None, "0.120")])
def test_amount_classes(spark, amount, first):
    df = spark.createDataFrame([(amount,)], "t string").select(F.col("t").cast("decimal(18,4)").alias("a"))
    assert str(df.select(M.amount_scores("a")[0]).first()[0]) == first


def scored(spark, **values):
    names = [f"{m}_{b}" for m in tags.LOG_MODELS + tags.ORDER_MODELS for b in M.BANDS]
    return spark.range(1).select(*[F.lit(values.get(n)).cast(M.SCORE).alias(n) for n in names])


def test_ties_go_to_the_first_band_and_no_scores_give_no_maximum(spark):
    tied = scored(spark, **{f"device_{b}": "0.5" for b in M.BANDS})
    assert tags.age_level(tied).first().ageLevel == "18_24"
    assert list(tags.max_score(tags.band_sums(tied)).first().calculate_age) == ["sum_18_24_score"]
    assert tags.max_score(tags.band_sums(scored(spark))).first().calculate_age == {}


def test_sums_as_written_miss_parts(spark):
    every = scored(spark, **{f"{m}_{b}": "0.1" for m in tags.LOG_MODELS + tags.ORDER_MODELS for b in M.BANDS})
    sums = lambda compat: [float(tags.band_sums(every, compat).first()[f"sum_{b}_score"]) for b in M.BANDS]
    assert sums(False) == pytest.approx([0.6] * 6)
    assert sums(True) == pytest.approx([0.6, 0.4, 0.4, 0.2, 0.2, 0.6])


def test_unknown_keys(spark):
    df = spark.createDataFrame([("Harmony", None), ("iOS", "other")], "os string, b string")
    rows = df.select(M.device_scores("os").alias("d"), M.brand_scores("b").alias("b")).collect()
    assert rows[0].d is None and rows[0].b is None
    assert [str(v) for v in rows[1].b] == ["0.020", "0.040", "0.060", "0.080", "0.100", "0.120"]


def test_empty_brand_and_category_have_no_score(spark):
    from tidemark.functions import scores

    rows = spark.createDataFrame([("",), (None,), ("nobody knows",)], "b string")
    got = [tuple(x is None for x in r) for r in rows.select(scores.brand_scores("b"), scores.category_scores("b")).collect()]
    assert got == [(True, True), (True, True), (False, False)]


def test_latest_by_key_takes_rows_with_maps(spark):
    from tidemark.operators.versions import latest_by_key

    rows = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"x": "2", "y": None}), ("b", 1, None)], "k string, ts bigint, m map<string,string>")
    assert {r["k"]: r["m"] for r in latest_by_key(rows, ["k"], ["ts"]).collect()} == {"a": {"x": "2", "y": None}, "b": None}


def test_landed_changes_are_selected_by_folder_and_not_parsed(spark, sf):
    from tidemark.operators import changelog as C
    from tidemark.plans.catalog.job_queries import landed

    plan = C.order_details(landed(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "order_detail" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "from_json" not in plan and C.order_details(landed(spark, sf)).count() > 0


def test_copied_side_of_an_interval_join_does_not_matter(spark):
    left = spark.range(200).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 > 0, F.col("id") * 13 % 997 - 300).alias("a"))
    right = spark.range(300).select((F.col("id") % 9).alias("k"), F.when(F.col("id") % 13 > 0, F.col("id") * 17 % 997 - 300).alias("b"))
    near = F.col("b").between(F.col("a") - 40, F.col("a") + 25)
    want = sorted(map(tuple, left.join(right, "k").filter(near).select("k", "a", "b").collect()))
    assert want
    for copied, span in (("right", 1), ("left", 1), ("left", 4), ("right", 4)):
        out = intervals.interval_join(left, right, "k", "a", "b", 40, 25, copied, span)
        assert sorted(map(tuple, out.select("k", "a", "b").collect())) == want


def _below(plan, name):
    """The lines of a plan's text below the first node of that name."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if name in line)
    depth = lines[at].index(name)
    rest = lines[at + 1:]
    end = next((i for i, line in enumerate(rest) if len(line) - len(line.lstrip(" :+-")) <= depth), len(rest))
    return "\n".join(rest[:end])


def test_orders_are_copied_and_not_their_lines(spark):
    """Each order has several lines, so the lines go to one slice only."""
    orders = spark.sql("SELECT 'o' id, 'u' uid, 'c' consignee, 0L create_time, '1' original_total_amount, '1' total_amount, 1L province_id, '' pay_time_slot, 0L ts_ms")
    lines = spark.sql("SELECT 'o' order_id, 'd' id, 1L sku_num, 1L sku_id, 's' sku_name, '1' order_price, '0' split_activity_amount, '0' split_coupon_amount, '1' split_total_amount, 5L ts_ms")
    joined = intervals.order_with_details(orders, lines)
    assert joined.count() == 1
    copied = _below(joined._jdf.queryExecution().analyzed().toString(), "Generate explode")
    assert "consignee" in copied and "sku_name" not in copied


def test_strictly_newer_sends_no_first_slices_to_the_join(spark):
    """Rows without key or time are left out; a key with a null value first keeps it; later slices see what earlier ones had."""
    rows = spark.sql("""SELECT * FROM VALUES ('k', 5L, 1L), ('k', 4L, 11L), ('k', 6L, 21L), ('k', 6L, 22L), ('n', NULL, 1L), ('n', NULL, 15L),
        ('n', 1L, 25L), ('n', NULL, 35L), (NULL, 9L, 1L), ('t', 9L, NULL) AS t(k, v, at)""")
    out = keyed.strictly_newer(rows, "k", "v", "at", slice_ms=10)
    assert sorted((r.k, r.at) for r in out.collect()) == [("k", 1), ("k", 21), ("n", 1), ("n", 15), ("n", 25)]
    assert "isnotnull(_carried" in out._jdf.queryExecution().optimizedPlan().toString()


def _scored_sides(spark):
    models = {"left": tags.LOG_MODELS, "right": tags.ORDER_MODELS}
    def scores(side, n):
        return {f"{m}_{b}": F.when((F.col("id") + i + j) % n > 0, F.col("id") * (i + 2) % 5 * 0.1 + j * 0.015).cast("decimal(4,3)")
                for i, m in enumerate(models[side]) for j, b in enumerate(M.BANDS)}
    texts = lambda names: {c: F.lit(c) for c in names}
    ids = spark.range(20)
    logs_ = ids.select(F.lit("u").alias("uid"), (F.col("id") * 10).alias("ts_ms"), *[v.alias(c) for c, v in {**texts(tags._LOG_COLUMNS), **scores("left", 3)}.items()])
    orders = ids.select(F.lit("u").alias("uid"), (F.col("id") * 10 + 3).alias("ts_ms"), *[v.alias(c) for c, v in {**texts(tags._ORDER_COLUMNS), **scores("right", 4)}.items()])
    return logs_, orders


def test_pairs_bring_half_sums(spark):
    """A band is summed on each side before the join; the sums, the best and the level are those of the single scores."""
    pairs = tags.join_log_and_orders(*_scored_sides(spark), 25)
    plain = pairs.drop(*[f"{half}_{b}" for half in ("_log", "_order") for b in M.BANDS])
    for compat in (False, True):
        fast, slow = (tags.age_level(tags.max_score(tags.band_sums(df, compat))) for df in (pairs, plain))
        names = [*[f"sum_{b}_score" for b in M.BANDS], "ageLevel", "calculate_age"]
        rows = sorted(fast.select(names).collect(), key=str)
        assert len(rows) > 50 and rows == sorted(slow.select(names).collect(), key=str)
        for r in rows:
            sums = [r[f"sum_{b}_score"] for b in M.BANDS]
            assert r.calculate_age == ({f"sum_{M.BANDS[sums.index(max(sums))]}_score": max(sums)} if max(sums) > 0 else {})
    shown = tags.band_sums(pairs).select("uid", "sum_50_score")._jdf.queryExecution().optimizedPlan().toString()
    above = shown[:shown.index("Join")]
    assert "device_" not in above and "amount_" not in above


def _tag_topic(spark):
    """Lines with one version, two of one time, and versions of another order or another hour; all meet several versions of their order."""
    orders = [(o, f"u{o}", "c", str(created), "5", "5", "1", ms) for o, hour in (("a", 0), ("b", 1), ("c", 30))
              for created, ms in ((5, hour * 3_600_000 + 600_000), (5, hour * 3_600_000 + 610_000), (9, hour * 3_600_000 + 620_000), (7, hour * 3_600_000 + 630_000))]
    orders.append(("a", "ua", "c", "8", "5", "5", "1", 4_200_000))
    line = lambda id, order, total, ms: (id, order, "1", "s", "2", "1.0", total, "0", "0", "1", ms)
    lines = [line("one", "a", "3.0", 600_000), line("same", "b", "4.0", 4_200_000), line("same", "b", "2.0", 4_200_000),
             line("moved", "a", "6.0", 600_000), line("moved", "b", "1.0", 4_200_000), line("hours", "a", "6.0", 600_000),
             line("hours", "a", "1.0", 4_200_000), line("hours", "a", "0.5", 600_000), line(None, "a", "1.0", 600_000)]
    names = ["id", "user_id", "consignee", "create_time", "original_total_amount", "total_amount", "province_id", "ts_ms"]
    parts = ["id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount", "create_time", "ts_ms"]
    frame = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} {'bigint' if n == 'ts_ms' else 'string'}" for n in names))
    return cdc_snapshot(frame(orders, names), "order_info").unionByName(cdc_snapshot(frame(lines, parts), "order_detail"))


def test_newest_lines_are_found_where_they_are_joined(spark):
    """Versions of a line that lie together are not shuffled by line; those of another order or hour are, and all give what one window gives."""
    brands = spark.sql("SELECT '2' skuid, '3' c3id, 'TCL' tname")
    tree = spark.sql("SELECT '3' id, 'b3' b3name, 'b2' b2name, 'b1' b1name")
    topic = _tag_topic(spark)
    columns = ["detail_id", "uid", "ts_ms", "create_time", "split_total_amount"]
    out = jobs.tag_orders(topic, brands, tree, "UTC").select(columns)
    joined = intervals.order_with_details(tags.order_rows(topic, "UTC"), tags.detail_rows(topic))
    ties = ["split_total_amount", "sku_id", "sku_num", "order_price", "sku_name", "split_activity_amount", "split_coupon_amount"]
    before = Window.partitionBy("detail_id").orderBy("ts_ms", *ties).rowsBetween(Window.unboundedPreceding, -1)
    plain = joined.filter("detail_id IS NOT NULL").withColumn("_m", F.max("create_time").over(before)).filter("_m IS NULL OR create_time > _m")
    want = sorted(map(tuple, plain.select(columns).collect()))
    assert sorted(map(tuple, out.collect())) == want and {r[0] for r in want} == {"one", "same", "moved", "hours"}
    assert ("same", "ub", 4_200_000, 5, "2.0") in want and ("same", "ub", 4_200_000, 5, "4.0") not in want
    near, apart, needed = keyed.by_agreement(tags.detail_rows(topic), "id", F.col("order_id"), intervals.line_slice(F.col("ts_ms"), 120_000))
    assert {r.id for r in near.collect()} == {"one", "same", None} and {r.id for r in apart.collect()} == {"moved", "hours"}
    assert needed(topic).count() == topic.count()
    agreeing = topic.filter("coalesce(after['id'], '') NOT IN ('moved', 'hours')")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = jobs.tag_orders(agreeing, brands, tree, "UTC").select(columns)
        rows = sorted(map(tuple, out.collect()))
        ran = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows == [r for r in want if r[0] in ("one", "same")]
    assert "Window [max(create_time" in ran and "hashpartitioning(detail_id" not in ran


def test_lines_go_whole_to_their_id_only(spark):
    """Only the keys of lines are shuffled by order. A line without id has its buyer all the same, one without order has none."""
    line = lambda id, order, ms: (id, order, "1", "s", "9", "8", "7", "2", "1.0", "2.0", "0", "0", ms)
    frame = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} {'bigint' if n == 'ts_ms' else 'string'}" for n in names))
    parts = ["id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num", "order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts_ms"]
    log = cdc_snapshot(frame([line("a", "o", 1), line("a", "p", 2), line(None, "o", 3), line("", "p", 3), line(".", "o", 3), line("x", "gone", 3), line("y", None, 3)], parts), "order_detail")
    log = log.unionByName(cdc_snapshot(frame([("o", "u1", "1", 1), ("p", "u2", "1", 1), ("p", "u3", "2", 5), (None, "u4", "1", 1)], ["id", "user_id", "province_id", "ts_ms"]), "order_info"))
    log = log.unionByName(cdc_snapshot(frame([("a", "A", "R", 1), (None, "B", "R", 1)], ["order_detail_id", "activity_id", "activity_rule_id", "ts_ms"]), "order_detail_activity"))
    log = log.unionByName(cdc_snapshot(frame([("", "C", 1), (None, "D", 1)], ["order_detail_id", "coupon_id", "ts_ms"]), "order_detail_coupon"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = facts.order_detail_facts(log, "UTC")
        rows = {(r.id, r.order_id, r.user_id, r.province_id, r.activity_id, r.coupon_id) for r in out.collect()}
        plan = facts.order_detail_facts(log, "UTC")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows == {("a", "p", "u3", "2", "A", None), (None, "o", "u1", "1", None, None), ("", "p", "u3", "2", None, "C"), (".", "o", "u1", "1", None, None)}
    by_order = [below for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning(order_id" in line]
    assert by_order and not any("sku_name" in below for below in by_order)


def test_texts_are_parsed_once_for_all_outputs(spark):
    """No filter parses the texts again, and a record without fields is still a record."""
    values = log_of(spark, "{}", "bad", None, '{"ts": 1}', '[1]')
    out = logs.tagged_texts(logs.checked_log(values))
    assert sorted((r.output, r.value) for r in out.collect()) == [("dirty", "[1]"), ("dirty", "bad"), ("page", '{"ts":1}'), ("page", "{}")]
    records = logs.parsed_log(values)
    assert sorted(str(r.ts) for r in records.collect()) == ["1", "None"] and records.columns == [f.name for f in APP_LOG.fields]
    for df in (out, records):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 1
