"""Names that mean the same: the closure of a table of aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import stored


def closure(aliases: DataFrame, one: str = "name", other: str = "alias") -> DataFrame:
    """``name, canonical`` of every name in a table of pairs, case folded.

    Aliases hold in both directions and through others; the canonical name is the least that is
    reachable.  Each round takes the least label of a name's neighbours and then the label of
    that label, so the rounds grow with the logarithm of the longest chain.  NULLs and pairs of
    a name with itself say nothing.
    """
    pairs = aliases.select(F.lower(one).alias("a"), F.lower(other).alias("b")).dropna()
    both = stored(pairs.union(pairs.select("b", "a")).filter("a <> b").distinct(), "aliases")
    labels = stored(both.groupBy(F.col("a").alias("name")).agg(F.least(F.col("name"), F.min("b")).alias("canonical")), "labels")
    while True:
        near = (both.join(labels.select(F.col("name").alias("b"), "canonical"), "b")
                .groupBy(F.col("a").alias("name")).agg(F.min("canonical").alias("near")))
        lower = labels.join(near, "name").select("name", F.col("canonical").alias("was"), F.least("canonical", "near").alias("next"))
        jump = labels.select(F.col("name").alias("next"), F.col("canonical").alias("beyond"))
        moved = stored(lower.join(jump, "next").select("name", "was", F.least("next", "beyond").alias("canonical")), "labels")
        labels = moved.select("name", "canonical")
        if moved.filter("canonical <> was").isEmpty():
            return labels


def canonical(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """``df`` with a column of names case folded and replaced by their canonical ones."""
    side = names.select(F.col("name").alias("_name"), F.col("canonical").alias("_canonical"))
    return (df.join(side, F.lower(column) == F.col("_name"), "left")
            .withColumn(column, F.coalesce("_canonical", F.lower(column))).drop("_name", "_canonical"))
