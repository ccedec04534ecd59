"""Named queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import small_tasks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            small_tasks(spark)
            return run(spark, sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def seconds(column: str) -> Column:
    """A timestamp as text, under its own name."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)
