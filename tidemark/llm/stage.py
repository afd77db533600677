"""Tables in the shared folder: they cut lineage, outlive lost executors and are removed when no longer read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import new_path, tune


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder, and read again."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings that these operators rely on. Whole texts are long, so fewer of them go to Python at once. Many tables
    are staged in turn: the shuffle files of a finished one go at once, not when the driver happens to collect its garbage."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return tune(spark)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
