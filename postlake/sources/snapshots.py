"""Parquet tables that can be replaced while being read.

Each commit writes a new ``v=N`` folder; Spark's own ``_SUCCESS`` marker makes it
visible, so a lost driver or executor leaves the previous snapshot current.  A
table has one writer at a time; that is for the scheduler of the runs to see to.

A commit made for a stream's micro-batch carries the stream and the batch in the
folder's name, apart from the version: the marker makes both visible at once.
A clean-up of old versions must leave the newest folder of each stream.
"""

from __future__ import annotations

import hashlib
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.sources import schemas

LABEL = re.compile(r"v=(\d+)(?:-b(\d+))?(?:-s([0-9a-f-]+)\.(\d+))?$")


class Snapshots:
    """Named tables under one root folder.

    The large gold tables are bucketed by posting, all into the same number of
    buckets, so that joins between them and merges into them need no shuffle of
    the stored side.  The number is part of the folder's name; by default it is
    the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _folders(self, name: str) -> dict[int, tuple[str, bool]]:
        """Version number to its folder's name and whether it is complete."""
        jvm = self.spark._jvm
        base = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return {}
        found = {}
        for status in fs.listStatus(base):
            label = status.getPath().getName()
            parts = LABEL.match(label)
            if parts:
                marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
                found[int(parts[1])] = (label, fs.exists(marker))
        return found

    def current(self, name: str) -> int | None:
        return max((n for n, (_, done) in self._folders(name).items() if done), default=None)

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def read(self, name: str) -> DataFrame:
        """The current snapshot, or an empty table of the registered schema."""
        complete = {n: label for n, (label, done) in self._folders(name).items() if done}
        if not complete:
            return schemas.empty(self.spark, name)
        label = complete[max(complete)]
        path = f"{self.root}/{name}/{label}"
        buckets = LABEL.match(label)[2]
        if buckets:
            return self._bucketed(name, path, int(buckets))
        reader = self.spark.read
        if name in schemas.TABLES:
            reader = reader.schema(schemas.TABLES[name])
        return reader.parquet(path)

    def _table(self, name: str, path: str) -> str:
        """Catalog name of a bucketed snapshot: bucketing is known only to catalog tables."""
        digest = hashlib.md5(path.encode()).hexdigest()[:16]
        return f"postlake_{name}_{digest}"

    def _bucketed(self, name: str, path: str, buckets: int) -> DataFrame:
        table, key = self._table(name, path), schemas.BUCKETED[name]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({schemas.TABLES[name]}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def last_batch(self, name: str, stream: str) -> int | None:
        """The last micro-batch of a stream that a complete snapshot holds."""
        parts = [LABEL.match(label) for label, done in self._folders(name).values() if done]
        return max((int(p[4]) for p in parts if p[3] == stream), default=None)

    def commit(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> DataFrame:
        """Write the next snapshot and return it.

        With a stream's id and batch number, a batch that a complete snapshot
        already holds changes nothing; a half-written one is written again.
        """
        if batch is not None:
            done = self.last_batch(name, batch[0])
            if done is not None and done >= batch[1]:
                return self.read(name)
        number = max(self._folders(name), default=0) + 1
        path = f"{self.root}/{name}/v={number:010d}"
        suffix = f"-s{batch[0]}.{batch[1]}" if batch is not None else ""
        if name in schemas.BUCKETED:
            key = schemas.BUCKETED[name]
            path = f"{path}-b{self.buckets}{suffix}"
            (df.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key)
             .mode("errorifexists").option("path", path).saveAsTable(self._table(name, path)))
        else:
            df.write.mode("errorifexists").parquet(f"{path}{suffix}")
        return self.read(name)

    def forget_old(self, name: str) -> None:
        """Delete all versions before the current one, of a table that only its writer reads."""
        current = self.current(name)
        for number, (label, _) in self._folders(name).items():
            if current is not None and number < current:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/{label}")
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def commit_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Commit tables that do not depend on each other, their jobs side by side.

        A small table's last tasks then do not leave the cluster idle.
        """
        with ThreadPoolExecutor(max_workers=4) as pool:
            running = {name: pool.submit(self.commit, name, df) for name, df in tables.items()}
            return {name: job.result() for name, job in running.items()}

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows to a log table, which is never rewritten."""
        rows.write.mode("append").parquet(f"{self.root}/{name}/log")

    def read_log(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}/log"
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return schemas.empty(self.spark, name)
        return self.spark.read.schema(schemas.TABLES[name]).parquet(path)

    def apply_schema(self, skip: tuple[str, ...] = ()) -> list[str]:
        """Create every missing registered table; safe to repeat."""
        missing = [name for name in schemas.TABLES if name not in skip and not self.exists(name)]
        self.commit_all({name: schemas.empty(self.spark, name) for name in missing})
        return missing


def overwrite_touched(spark: SparkSession, path: str, merged: DataFrame, *partition: str) -> None:
    """Replace only the partitions that ``merged`` has rows for.

    Spark stages the new files and moves whole partitions at commit, so the
    untouched part of a table is neither read nor written.  Rebalancing gives a
    partition one file of good size, and splits a large one over several tasks.
    """
    (merged.hint("rebalance", *partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition).parquet(path))


def month_partition(date_col: str) -> Column:
    """Partition value of a date column; rows without a date share one of their own."""
    return F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit("none"))
