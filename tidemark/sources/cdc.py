"""Change-log sources: envelopes from topics, files or table snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENVELOPE

_TEXT_MAP = "map<string,string>"


def text_map(columns: Sequence[str | Column], names: Sequence[str] | None = None) -> Column:
    """Columns as a map of texts."""
    names = names or list(columns)
    pairs = []
    for name, column in zip(names, columns):
        column = F.col(column) if isinstance(column, str) else column
        pairs += [F.lit(name), column.cast("string")]
    return F.create_map(*pairs)


def cdc_snapshot(
    df: DataFrame, table: str, db: str = "shop", ts: str = "ts_ms", op: str | Column = "r",
    before: Column | None = None, after: Column | None = None,
) -> DataFrame:
    """The rows of ``df`` as envelopes of ``table``. ``ts`` names the change time and stays out of the row.

    The row goes through a struct first: the optimizer then turns a later ``after['x']`` into the column itself
    and never builds the map.
    """
    names = [c for c in df.columns if c != ts]
    rows = df
    if after is None:
        rows = df.withColumn("_row", F.struct(*[F.col(c).cast("string").alias(c) for c in names]))
        after = text_map([f"_row.{c}" for c in names], names)
    return rows.select(
        (F.lit(None) if before is None else before).cast(_TEXT_MAP).alias("before"),
        after.cast(_TEXT_MAP).alias("after"),
        F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(table)).alias("source"),
        (F.lit(op) if isinstance(op, str) else op).alias("op"),
        F.col(ts).cast("bigint").alias("ts_ms"),
    )


def to_values(df: DataFrame) -> DataFrame:
    """Any record as one JSON text column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def parse_envelopes(values: DataFrame) -> DataFrame:
    """Envelope columns from JSON text."""
    return values.select(F.from_json("value", ENVELOPE).alias("_e")).select("_e.*")


def by_table(values: DataFrame) -> DataFrame:
    """A topic of envelopes parsed once, with the source database and table of each as columns."""
    source = F.col("source")
    return parse_envelopes(values).select(
        "before", "after", "op", "ts_ms", source["db"].alias("source_db"), source["table"].alias("source_table"))


def land_changes(values: DataFrame, path: str, batch_id: int = 0, run: str = "batch") -> None:
    """A topic of envelopes stored by source database and table. A batch that is written twice replaces itself, and nothing of others."""
    by_table(values).write.mode("overwrite").option("compression", "zstd").partitionBy("source_db", "source_table").parquet(f"{path}/run={run}/batch_id={batch_id}")


_LANDED = f"before {_TEXT_MAP}, after {_TEXT_MAP}, op string, ts_ms bigint, run string, batch_id bigint, source_db string, source_table string"


def landed_changes(spark: SparkSession, path: str) -> DataFrame:
    """The envelopes behind ``land_changes``. Selecting a table reads its folders only, and parses nothing."""
    rows = spark.read.schema(_LANDED).option("basePath", path).parquet(path)
    return rows.select("before", "after", F.create_map(F.lit("db"), F.col("source_db"), F.lit("table"), F.col("source_table")).alias("source"), "op", "ts_ms")


def compact_landed(spark: SparkSession, path: str, target: str) -> None:
    """The landed log of many batches as one batch below ``target``: the files of a table are written anew, by Spark's own file size."""
    rows = spark.read.schema(_LANDED).option("basePath", path).parquet(path).drop("run", "batch_id")
    names = rows.select("source_db", "source_table").distinct().collect()  # a row for each table
    # Each table is read by itself, so that a task packs files of one table only and nothing is shuffled.
    tables = [rows.filter(F.col("source_db").eqNullSafe(n[0]) & F.col("source_table").eqNullSafe(n[1])) for n in names]
    if tables:
        together = reduce(DataFrame.unionByName, tables).write.mode("overwrite").option("compression", "zstd")
        together.partitionBy("source_db", "source_table").parquet(f"{target}/run=compact/batch_id=0")


def topic_values(spark: SparkSession, servers: str, topic: str, streaming: bool = True, start: str = "earliest"):
    """Values and source timestamps of a Kafka topic. A null payload stays null. Needs the Kafka package."""
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp")


def file_values(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text files as a stand-in topic: one record per line."""
    return (spark.readStream if streaming else spark.read).text(path)


def landed_topic(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A topic that landed on storage: ``value``, and the source's own ``timestamp`` of each record, which the value does not hold."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema("value string, timestamp timestamp").parquet(path)


def landed_texts(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The same of text files. The time at which a file was written, from the hidden ``_metadata`` column, is that of its records."""
    lines = (spark.readStream if streaming else spark.read).text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def json_table(values: DataFrame, schema, view: str | None = None) -> DataFrame:
    """A topic of JSON records as a table with declared columns, optionally registered as a view."""
    out = values.select(F.from_json("value", schema).alias("_r")).select("_r.*")
    if view:
        out.createOrReplaceTempView(view)
    return out


def with_source_time(df: DataFrame, delay: str = "0 seconds", source: str = "timestamp", name: str = "et") -> DataFrame:
    """Event time from the source's own timestamp instead of the payload's, plus a watermark."""
    return df.withColumn(name, F.col(source)).withWatermark(name, delay)


def with_event_time(df: DataFrame, ms: str, delay: str = "0 seconds", name: str = "et") -> DataFrame:
    """Event time from epoch milliseconds plus a watermark; a missing or bad time counts as 0."""
    ts = F.timestamp_millis(F.coalesce(F.col(ms).try_cast("bigint"), F.lit(0)))
    return df.withColumn(name, ts).withWatermark(name, delay)
