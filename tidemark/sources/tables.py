"""Dimension, reference and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import snake_to_camel


def read_table(spark: SparkSession, path: str, streaming: bool = False, schema=None) -> DataFrame:
    """A parquet table, whole or as a file stream (which needs its schema)."""
    reader = spark.readStream if streaming else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def query_rows(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query against a reference database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def camel_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: snake_to_camel(c) for c in df.columns})


def dim_scan(df: DataFrame, key: str, family: str = "info") -> DataFrame:
    """A keyed table as (key, struct of its other columns), all text."""
    cells = [F.col(c).cast("string").alias(c) for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias(key), F.struct(*cells).alias(family))
