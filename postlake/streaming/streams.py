"""Streaming twins of the batch operators: same results, arrived at incrementally."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake import vocabulary as V
from postlake.operators.dedup import keep_first
from postlake.operators.merge import Rule, merge_upsert
from postlake.plans.star import upsert_fact_months
from postlake.sources.snapshots import Snapshots


def land_stream(records: DataFrame, path: str, checkpoint: str,
                partition_by: tuple[str, ...] = ("source_id",)) -> StreamingQuery:
    """Append a stream of stamped raw rows; all that is there now, then stop."""
    return (records.writeStream.format("parquet").outputMode("append")
            .partitionBy(*partition_by).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def drop_repeats(records: DataFrame, keys: list[str], ts: str,
                 horizon_days: int = V.RAW_RETENTION_DAYS) -> DataFrame:
    """First arrival per key within a horizon, which also bounds the state kept."""
    return (records.withWatermark(ts, f"{horizon_days} days")
            .dropDuplicatesWithinWatermark(keys))


def sink_append(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (records.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def daily_counts(records: DataFrame, ts: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Rows per day and key; rows later than the watermark are dropped."""
    return (records.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.to_date("w.start").alias("day"), *keys, "n"))


def upsert_stream(records: DataFrame, store: Snapshots, table: str, keys: list[str],
                  update: dict[str, Rule], checkpoint: str, order: list[Column] | None = None,
                  mode: str = "append",
                  prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> StreamingQuery:
    """Merge every micro-batch into a snapshot table with the batch operator.

    ``prepare`` shapes a micro-batch first, for one to aggregate it by key.
    The snapshot carries the stream's id and the batch's number, so a batch
    replayed after a failure finds its commit done and changes nothing, whatever
    other commits the table has.  A stream with a new checkpoint has a new id and
    applies all it reads.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        merged = merge_upsert(store.read(table), prepare(batch), keys, update, order)
        store.commit(table, merged, batch=(stream_id(store.spark, checkpoint), batch_id))

    return for_each(records, merge, checkpoint, mode)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it made the checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def fact_stream(staged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge staged fact rows into a fact table partitioned by posting month.

    Only the months a micro-batch touches are rewritten, and the fact rules give
    the same row when a batch is applied again.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        unique = keep_first(batch, ["posting_id", "date_posted"],
                            [F.desc("last_seen_at"), F.desc("first_seen_at")])
        upsert_fact_months(batch.sparkSession, path, unique)

    return for_each(staged, merge, checkpoint, "append")


def for_each(records: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
              mode: str) -> StreamingQuery:
    return (records.writeStream.foreachBatch(work).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
