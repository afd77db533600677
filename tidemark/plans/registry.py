"""The registered queries: name, Spark form, and SQL form where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune

MODULES = [
    "sources_sinks", "changes", "log_queries", "fact_queries", "join_queries", "scalar_queries", "window_queries",
    "state_queries", "tag_queries", "job_queries", "stream_queries",
]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated (spark, sf) -> DataFrame function under ``name``."""

    def add(run):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")

        def tuned(spark: SparkSession, sf: str) -> DataFrame:
            return run(tune(spark), sf.rstrip("/"))

        tuned.__doc__ = run.__doc__
        tuned.__name__ = name
        _QUERIES[name] = Query(tuned, sql)
        return run

    return add


def load() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"tidemark.plans.catalog.{module}")
    return dict(_QUERIES)
