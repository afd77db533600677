"""Hot keys: sketches, salted joins, and the same answers on every join path."""

from pyspark.sql import functions as F

from tidemark.operators import facts, keyed, logs, skew
from tidemark.plans import standins as T


def _skewed(spark):
    hot = spark.range(9_000).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("v"))
    rest = spark.range(18_000).select((F.col("id") % 3_000 + 100).alias("k"), F.col("id").alias("v"))
    return hot.unionByName(rest)


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_hot_keys_finds_the_hot_key_only(spark):
    found = skew.hot_keys(_skewed(spark), ["k"]).collect()
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert [r[0] for r in found] == [want]


def test_salted_join_equals_plain_join(spark):
    big = _skewed(spark)
    other = spark.range(0, 2_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left"):
        assert _rows(skew.salted_join(big, other, ["k"], how)) == _rows(big.join(other, "k", how))


def test_salted_join_spreads_the_hot_key(spark):
    big = _skewed(spark)
    salts = (
        big.join(F.broadcast(skew.hot_keys(big, ["k"])), F.xxhash64("k") == F.col("_hot"))
        .select(skew._row_salt(big, 64).alias("s")).distinct().count())
    assert salts > 32


def test_salt_spreads_exact_copies_over_input_partitions(spark):
    copies = spark.range(1000).repartition(16).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert copies.select(skew._row_salt(copies, 64).alias("s")).distinct().count() > 8


def test_lookup_join_broadcasts_only_within_the_limit(spark):
    big = _skewed(spark)
    other = spark.range(2_000).select(F.col("id").alias("k"))
    small = skew.lookup_join(big, other, ["k"])._jdf.queryExecution().executedPlan().toString()
    large = skew.lookup_join(big, other, ["k"], limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in small
    assert "broadcast" not in large


def test_sized_by_stands_for_the_other_side(spark):
    other = spark.range(2_000).select(F.col("id").alias("k"))
    huge = spark.range(10_000_000_000)
    plan = skew.lookup_join(_skewed(spark), other, ["k"], sized_by=huge)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_without_adaptive_skew_splitting_the_join_is_salted(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    spark.conf.set(key, "false")
    try:
        big, other = _skewed(spark), spark.range(2_000).select(F.col("id").alias("k"))
        out = skew.lookup_join(big, other, ["k"], limit=0)
        assert "approx_top_k" in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == big.join(other, "k").count()
    finally:
        spark.conf.set(key, "true")


def test_facts_do_not_depend_on_the_join_path(spark, sf):
    log = T.change_log(spark, sf, *T.TRADE)
    assert _rows(facts.order_detail_facts(log, "UTC")) == _rows(facts.order_detail_facts(log, "UTC", limit=0))


def test_is_new_repair_does_not_depend_on_the_join_path(spark, sf):
    log = T.app_log(spark, sf)
    pick = ["common.mid", "ts", "common.is_new"]
    assert _rows(logs.repair_is_new(log, "UTC").select(*pick)) == _rows(logs.repair_is_new(log, "UTC", limit=0).select(*pick))


def test_running_profile_does_not_depend_on_the_slice(spark, sf):
    rows = logs.device_and_search(T.app_log(spark, sf))
    hour, week = keyed.running_profile(rows), keyed.running_profile(rows, slice_ms=7 * 24 * 3_600_000)
    assert _rows(hour) == _rows(week)


def test_strictly_newer_does_not_depend_on_the_slice(spark, sf):
    rows = T.app_log(spark, sf).select("common.uid", "ts", "page.during_time")
    a = keyed.strictly_newer(rows, "uid", "during_time", "ts", slice_ms=60_000)
    b = keyed.strictly_newer(rows, "uid", "during_time", "ts", slice_ms=10**12)
    assert _rows(a) == _rows(b)
