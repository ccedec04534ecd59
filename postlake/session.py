"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


# Posting payloads and sequential keys pack ten to twenty times: what a task sorts is so many
# times what it reads.  With Spark's 128 and 64 MB a task would sort gigabytes and spill them.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes(text: str) -> int | None:
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower())
    return int(found[1]) * _UNITS[found[2]] if found else None


def small_tasks(spark: SparkSession) -> None:
    """Bound what one task reads, so that its memory does not grow with the tables.

    More data gives more tasks, not larger ones.  A session that asks for less keeps its setting.
    """
    for name, most in TASK_BYTES.items():
        now = _bytes(spark.conf.get(name))
        if now is not None and now > most:
            spark.conf.set(name, str(most))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, the session has this setting; after that the one from before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# HotSpot never compiles a method of more than 8,000 bytes of bytecode; Spark's own limit is 65,535.
COMPILED_METHOD = ("spark.sql.codegen.hugeMethodLimit", 8000)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, a stage whose generated method would only ever be interpreted runs operator by operator.

    For projections that write out many shapes of record in one expression.
    """
    name, most = COMPILED_METHOD
    with setting(spark, name, str(min(int(spark.conf.get(name)), most))):
        yield


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def passing_shuffles(spark: SparkSession):
    """Inside, what a query shuffled is deleted when it is done, not when the driver happens to collect its garbage."""
    return setting(spark, CLEANUP, "true")


CODEC = "spark.sql.parquet.compression.codec"


@contextmanager
def little_disk(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffles pass with their query, and tables are packed with Zstandard.

    A session that asks for another codec than Spark's default keeps it.
    """
    codec = spark.conf.get(CODEC)
    with passing_shuffles(spark), setting(spark, CODEC, "zstd" if codec == "snappy" else codec):
        yield


def build_session(app: str = "postlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Broadcast joins are left to Catalyst and AQE, which choose them from measured
    sizes under ``spark.sql.autoBroadcastJoinThreshold`` and fall back to a
    shuffled join, with skew splitting, above it.  Only ``tag_by_join`` hints one,
    from the size that it measured.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local master, where every
    task sees it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder; nothing is ever reused."""
    return f"{scratch_root(spark)}/postlake/{name}-{uuid.uuid4().hex[:12]}"


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan that has fewer splits than the session has cores one per core.

    For heavy per-row work over a few small files.  A table of many files already
    has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


_TRACKED = threading.local()  # a stream's batch runs beside a refresh; neither may delete the other's tables


def _trackers() -> list[list[str]]:
    return _TRACKED.__dict__.setdefault("lists", [])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation.  The
    shuffle files of the write are dropped when it is done.
    """
    path = scratch_path(df.sparkSession, name)
    for paths in _trackers():
        paths.append(path)
    with passing_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The scratch tables that this thread writes inside the block, for ``forget`` when what came of them is stored."""
    paths: list[str] = []
    _trackers().append(paths)
    try:
        yield paths
    finally:
        _trackers()[:] = [p for p in _trackers() if p is not paths]


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread writes inside the block are deleted when it ends, also by an error."""
    with tracked() as paths:
        try:
            yield
        finally:
            forget(spark, paths)
