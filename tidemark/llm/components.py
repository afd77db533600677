"""Connected components of links between keys, by passing the smallest key along."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import staged


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(key, component) of every key in ``links`` (a, b); a component is named by its smallest key.

    After ``rounds`` it may stop early: keys with one name then hang together, but a component may still have several names.

    Each round hangs the larger neighbours of a key on its smallest one, then the smaller ones, until nothing changes
    (large star and small star). A round writes its links to the shared folder.
    """
    spark = links.sparkSession
    edges = staged(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    signature, done = None, 0
    while rounds is None or done < rounds:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(spark, small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "links")
        done += 1
        if rounds is None:
            row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
            if row == signature:
                break
            signature = row
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("key"), "component").unionByName(
        edges.select("b").distinct().join(edges.select(F.col("a").alias("b")), "b", "left_anti").select(F.col("b").alias("key"), F.col("b").alias("component")))
