"""Tracker export: the rows as text under fixed headings, written as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake import vocabulary as V


def tracker_rows(tracker: DataFrame) -> DataFrame:
    """The export's nine text columns, under their field names."""
    def text(name, missing=""):
        return F.coalesce(F.col(name).cast("string"), F.lit(missing))

    seen = F.coalesce(F.date_format("last_seen_at", "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return tracker.select(
        "posting_id", "company_name", "job_title", "location",
        text("date_posted").alias("date_posted"),
        text("closing_date", "Not specified").alias("closing_date"),
        text("date_applied").alias("date_applied"),
        F.when(F.col("is_likely_closed"), "Yes").otherwise("No").alias("is_likely_closed"),
        seen.alias("last_seen_at"),
    )


def with_headings(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(name).alias(label) for name, label in V.EXPORT_COLUMNS])


def write_tracker(tracker: DataFrame, path: str, as_of=None) -> str:
    """Write the export and return where; a taken path gets a time suffix.

    An empty tracker still writes the heading line.
    """
    rows = with_headings(tracker_rows(tracker))
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        path = f"{path}-{as_of:%Y%m%d%H%M%S}"
    if rows.isEmpty():
        # A CSV task without rows writes no heading, so one blank-free line is written as text.
        heading = ",".join(label for _, label in V.EXPORT_COLUMNS)
        spark.createDataFrame([(heading,)], "value string").coalesce(1).write.text(path)
    else:
        rows.write.option("header", True).csv(path)
    return path
