"""Type-2 history: close versions whose tracked values changed, open new ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def company_snapshot(staging: DataFrame) -> DataFrame:
    """One row per company key; case variants of a name are one company."""
    return (
        staging.groupBy(F.md5(F.lower("company_name").cast("binary")).alias("company_id"))
        .agg(F.min("company_name").alias("company_name"),
             F.min("display_name").alias("display_name"))
    )


def changed_keys(current: DataFrame, snapshot: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Current versions with a snapshot row that differs in a tracked value, NULL-aware."""
    c, s = current.alias("c"), snapshot.alias("s")
    return c.join(s, (F.col(f"c.{key}") == F.col(f"s.{key}")) & _differs("c.", "s.", tracked),
                  "left_semi")


def unopened_keys(current: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Snapshot rows whose key has no current version."""
    return snapshot.join(current.select(key), key, "left_anti")


def _differs(left: str, right: str, tracked: list[str]) -> Column:
    return reduce(lambda a, b: a | b,
                  [~F.col(f"{left}{t}").eqNullSafe(F.col(f"{right}{t}")) for t in tracked])


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
               as_of: Column) -> DataFrame:
    """The dimension after one snapshot, in one join.

    Each current version meets its snapshot row once and yields one row (kept or
    closed) or two (closed and reopened); a new key yields one.  History passes
    through untouched and does not take part in the join.
    """
    names = [c for c in dim.columns if c not in ("valid_from", "valid_to", "is_current")]
    history = dim.filter(~F.col("is_current"))
    current = dim.filter("is_current").select(F.col(key), F.struct(*dim.columns).alias("c"))
    incoming = snapshot.select(F.col(key), F.struct(*names).alias("s"))
    joined = current.join(incoming, key, "full_outer")

    has_current, has_incoming = F.col("c").isNotNull(), F.col("s").isNotNull()
    changed = has_current & has_incoming & _differs("c.", "s.", tracked)
    kept = F.struct(
        *[F.col(f"c.{n}").alias(n) for n in names],
        F.col("c.valid_from").alias("valid_from"),
        F.when(changed, as_of).otherwise(F.col("c.valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    opened = F.struct(
        *[F.col(f"s.{n}").alias(n) for n in names],
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    versions = F.array_compact(F.array(
        F.when(has_current, kept),
        F.when(has_incoming & (~has_current | changed), opened),
    ))
    rows = joined.select(F.explode(versions).alias("v")).select("v.*")
    return history.unionByName(rows.select(*dim.columns))
