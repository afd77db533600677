"""Shuffle files of a staged table do not stay until the driver collects its garbage."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm.stage import ready, staged
from tidemark.session import local_session


@pytest.fixture(scope="module")
def spark():
    return ready(local_session(4, "tests"))


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: int(tracker.shuffleStatuses().size())
    before = held()
    rows = spark.range(100_000).groupBy((F.col("id") * 7919 % 5_000).alias("k")).agg(F.max("id").alias("most"))
    out = [staged(spark, rows, "rows") for _ in range(4)]
    end = time.time() + 20
    while held() > before and time.time() < end:
        time.sleep(0.2)
    assert held() <= before
    # What is read again is worked out again.
    assert rows.count() == len(rows.collect()) == rows.count() == 5_000 and all(t.count() == 5_000 for t in out)
