"""Streams that lose no row to a watermark: late first arrivals are told from repeats and kept."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake import vocabulary as V
from postlake.operators.dedup import keep_first
from postlake.session import stored
from postlake.sources.archive import present
from postlake.sources.snapshots import overwrite_touched
from postlake.streaming.streams import for_each

FIRST, LATE, REPEAT = "first", "late", "repeat"


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Every arrival with its ``fate``, the day of its time and its batch."""
    return spark.read.parquet(path)


def arrivals(records: DataFrame, keys: list[str], ts: str, path: str, checkpoint: str,
             horizon_days: int = V.RAW_RETENTION_DAYS) -> StreamingQuery:
    """Write every row of a stream as a first arrival, a late one, or a repeat.

    A row is a repeat if its key was written before, or comes earlier in its micro-batch.  A first
    arrival is late if its time is more than the horizon before the newest time of earlier
    batches, which is where a watermark would have dropped it unseen.  Rows go to partitions by
    ``fate``, ``day`` and ``batch``, which a replayed batch overwrites; a batch reads the keys
    that are stored, and no state is held in memory.
    """
    def divide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = stored(batch, "arrivals")
        held = read_arrivals(spark, path).filter(F.col("batch") < batch_id) if present(spark, path) else None
        newest = held.agg(F.max(ts).alias("at")).first()["at"] if held is not None else None
        order = [F.asc(ts), F.xxhash64(*batch.columns)]
        placed = keep_first(batch, keys, order, k=(1 << 31) - 1, rank="place")
        if held is not None:
            known = held.filter(F.col("fate") != REPEAT).select(*keys).withColumn("known", F.lit(True))
            placed = placed.join(known, keys, "left")
        else:
            placed = placed.withColumn("known", F.lit(None).cast("boolean"))
        behind = F.col(ts) < F.lit(newest - timedelta(days=horizon_days)) if newest is not None else F.lit(False)
        fate = F.when(F.col("known").isNotNull() | (F.col("place") > 1), REPEAT).when(behind, LATE).otherwise(FIRST)
        rows = placed.select(*batch.columns, fate.alias("fate"), F.to_date(ts).alias("day"), F.lit(batch_id).alias("batch"))
        overwrite_touched(spark, path, rows, "fate", "day", "batch")

    return for_each(records, divide, checkpoint, "append")


def daily_partials(records: DataFrame, ts: str, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Add each micro-batch's rows per day and key to a table of partial counts.

    A day is never closed: a late row adds to its day.  Partitions are by day and batch of a
    stream, so a replay overwrites its own part and counts nothing twice.
    """
    name = F.lit(checkpoint.rstrip("/").rsplit("/", 1)[-1])

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.to_date(ts).alias("day"), *keys).agg(F.count(F.lit(1)).alias("n"))
        rows = counts.withColumn("batch", F.concat(name, F.lit(f".{batch_id}")))
        overwrite_touched(batch.sparkSession, path, rows, "day", "batch")

    return for_each(records, add, checkpoint, "append")


def daily_totals(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Rows per day and key, and in how many batches they came."""
    return spark.read.parquet(path).groupBy("day", *keys).agg(F.sum("n").alias("n"), F.count_distinct("batch").alias("batches"))
