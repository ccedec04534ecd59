"""Dimensions rebuilt from staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.time import date_key, day


def calendar(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """Every day from the earliest to the latest date of a column.

    Both ends come from one aggregate row, which then grows into the days.
    """
    ends = df.agg(
        F.coalesce(F.min(date_col), day(as_of)).alias("first"),
        F.coalesce(F.max(date_col), day(as_of)).alias("last"),
    )
    days = ends.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        date_key(F.col("date")).alias("date_id"),
        "date",
        F.date_format("date", "EEEE").alias("day_of_week"),
        F.month("date").cast("bigint").alias("month"),
        F.year("date").cast("bigint").alias("year"),
    )


def representative(df: DataFrame, key: str, id_name: str, examples: dict[str, str]) -> DataFrame:
    """One row per key value: its md5 id, the smallest example of other columns, the key."""
    return (
        df.groupBy(key)
        .agg(*[F.min(source).alias(name) for name, source in examples.items()])
        .select(F.md5(F.col(key).cast("binary")).alias(id_name), *examples, key)
    )


def locations(staging: DataFrame) -> DataFrame:
    return representative(staging, "location_normalized", "location_id",
                          {"location_raw": "location_raw"})


def accumulate(previous: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """A rebuilt dimension that keeps members no longer seen, so old facts still resolve."""
    gone = previous.join(rebuilt.select(key), key, "left_anti")
    return rebuilt.unionByName(gone.select(*rebuilt.columns))
