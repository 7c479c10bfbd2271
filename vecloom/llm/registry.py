"""Named queries of this subpackage, each with checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Arrow batches are cut by bytes, so that a batch of very long texts stays small.
BATCH_BYTES = "8m"
BATCH_ROWS = "4000"


def prepare(spark: SparkSession) -> None:
    """Session settings every operator here relies on, and this package for the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``; ``sql`` gives the same columns in DuckDB."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
