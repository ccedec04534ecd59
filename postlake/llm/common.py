"""Small helpers the operators share: tables, scratch tables, Arrow mapping, global ranks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from postlake.session import forget, stored, tracked  # noqa: F401  (the operators take them from here)


PATHS = 64 << 20  # characters of file paths that are broadcast; beyond, Spark chooses the join
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_table(df: DataFrame, name: str = "docs") -> DataFrame:
    """``df`` itself if it is a plain scan of Parquet files, else its rows written and read back."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().strip().splitlines()
    plain = (all(line.lstrip(" +-:").startswith(("Project", "Relation")) for line in plan)
             and "Relation" in plan[-1] and plan[-1].rstrip().endswith("parquet"))
    return df if plain else stored(df, name)


def numbered(df: DataFrame, row: str = "_row", name: str = "docs") -> DataFrame:
    """``df`` with a unique number of each row: of its file, in order of paths, and of the row in it.

    Unlike a number by place in the scan it does not depend on how files are cut into splits,
    so every scan gives the same, also after executors are lost or join.
    """
    df = as_table(df, name)
    files = sorted({r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()})  # one a file
    path, file, index = (fresh(df, c) for c in ("_path", "_file", "_index"))
    places = df.sparkSession.createDataFrame([(name, i) for i, name in enumerate(files)], f"`{path}` string, `{file}` long")
    places = F.broadcast(places) if sum(map(len, files)) <= PATHS else places  # one row a file
    return (df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(index))
            .join(places, path)
            .withColumn(row, F.shiftleft(file, 40) + F.col(index)).drop(path, file, index))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shipped(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per context; Spark serves the file to executors.

    Arrow batches are kept to some thousand texts, which bounds a worker's memory.
    """
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_postlake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "postlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._postlake_shipped = True


def map_batches(df: DataFrame, work: Callable[..., dict[str, list]], schema: T.StructType) -> DataFrame:
    """Apply ``work(*columns) -> {name: values}`` to each Arrow batch of ``df``.

    The columns arrive as Arrow arrays in the order of ``df``; memory is bounded by
    one batch.
    """
    arrow = to_arrow_schema(schema)
    shipped(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(*batch.columns)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                     for f in arrow for v in [made[f.name]]], schema=arrow)

    return df.mapInArrow(run, schema)


def ranked(df: DataFrame, key: Column, order: list[str], name: str = "rank", salt: Column | None = None) -> DataFrame:
    """``df`` with a gapless 0-based ``rank`` inside each ``key``, without a task per key.

    Rows of a key are dealt to salts; a row's rank is its place in its salt after the
    sizes of the salts before it.  The order inside a key is therefore by salt, then
    ``order``: any fixed order, not a sorted one.  Keys must be few or short (the table
    of sizes has one row per key and salt).
    """
    salts = 4 * shuffle_width(df.sparkSession)
    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int") if salt is None else salt
    keyed = df.withColumn("_key", key).withColumn("_salt", salt)
    sizes = keyed.groupBy("_key", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_key", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key", "_salt").orderBy(*order)
    placed = keyed.withColumn("_place", F.row_number().over(inside) - 1)
    return (placed.join(offsets, ["_key", "_salt"])
            .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
            .drop("_key", "_salt", "_place", "_before"))


def text_strings(column: pa.Array) -> list[str]:
    """Texts as Python strings; null is empty."""
    return [t if t is not None else "" for t in column.to_pylist()]
