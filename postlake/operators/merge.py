"""MERGE-shaped operators as pure functions: (target, source) -> next target."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.dedup import keep_first

Rule = Callable[[Column, Column], Column]


# Update rules for a matched row: (target value, source value) -> new value.
def take_source(target: Column, source: Column) -> Column:
    return source


def prefer_source(target: Column, source: Column) -> Column:
    """The source's value unless it is NULL."""
    return F.coalesce(source, target)


def least(target: Column, source: Column) -> Column:
    return F.least(target, source)


def greatest(target: Column, source: Column) -> Column:
    return F.greatest(target, source)


def either(target: Column, source: Column) -> Column:
    return target | source


def _full_join(target: DataFrame, source: DataFrame, keys: list[str],
               nullable: list[str] | None = None) -> DataFrame:
    """Target and source side by side, as ``t_*`` and ``s_*``.

    Keys in ``nullable`` (by default all) also match NULL with NULL.  A key that
    is never NULL is better left out: a plain equality can use a partitioning or
    bucketing by that key, a NULL-safe one cannot.
    """
    nullable = keys if nullable is None else nullable
    t = target.select(F.lit(True).alias("t_"), *[F.col(c).alias(f"t_{c}") for c in target.columns])
    s = source.select(F.lit(True).alias("s_"), *[F.col(c).alias(f"s_{c}") for c in source.columns])
    condition = F.lit(True)
    for i, key in enumerate(keys):
        left, right = F.col(f"t_{key}"), F.col(f"s_{key}")
        match = left.eqNullSafe(right) if key in nullable else left == right
        condition = match if i == 0 else condition & match
    return t.join(s, condition, "full_outer")


def _next_row(columns: list[str], rules: dict[str, Rule]) -> list[Column]:
    """Each column's next value: by its rule when both sides are there, else from the one that is."""
    has_target, has_source = F.col("t_").isNotNull(), F.col("s_").isNotNull()
    row = []
    for name in columns:
        t, s = F.col(f"t_{name}"), F.col(f"s_{name}")
        value = F.when(has_target, t).otherwise(s)
        if name in rules:
            value = F.when(has_target & has_source, rules[name](t, s)).otherwise(value)
        row.append(value.alias(name))
    return row


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 update: dict[str, Rule], order: list[Column] | None = None,
                 nullable: list[str] | None = None) -> DataFrame:
    """Update matched rows by the rules, keep the rest of them, insert unmatched ones.

    Keys match NULL-safely unless left out of ``nullable``.  The source must be unique by key; given ``order``, it
    is first reduced to the first row per key, which also keeps a hot key from
    reaching the join more than once.
    """
    if order is not None:
        source = keep_first(source, keys, order)
    return _full_join(target, source, keys, nullable).select(*_next_row(target.columns, update))


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: target rows are untouched, rows with a new key are added."""
    fresh = source.select(*target.columns).join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def latest_changes(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last change per key."""
    return keep_first(changes, keys, order)


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], order: list[Column],
                  op: str = "op", delete: str = "DELETE",
                  update: dict[str, Rule] | None = None) -> DataFrame:
    """Apply a change log of upserts and deletes; the last write per key wins.

    Keys are ids and never NULL.  ``update`` limits what an upsert changes on an existing row; by default it
    replaces every column.
    """
    last = latest_changes(changes, keys, order)
    rules = update if update is not None else {
        c: take_source for c in target.columns if c not in keys}
    joined = _full_join(target, last, keys, nullable=[])
    removed = F.coalesce(F.col(f"s_{op}") == delete, F.lit(False))
    return joined.filter(~removed).select(*_next_row(target.columns, rules))


def delete_keys(target: DataFrame, keys_to_delete: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(keys_to_delete.select(*keys).distinct(), keys, "left_anti").select(*target.columns)


def keep_referenced(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key still has a parent."""
    return child.join(parent.select(key), key, "left_semi").select(*child.columns)


FACT_RULES: dict[str, Rule] = {
    "role_family": take_source,
    "last_seen_at": take_source,
    "first_seen_at": least,
    "is_incomplete": either,
}
DETAIL_RULES: dict[str, Rule] = {
    **{name: prefer_source for name in (
        "description", "posting_url", "apply_url", "salary_min", "salary_max",
        "currency", "employment_type")},
    **{name: take_source for name in (
        "last_seen_at", "min_years_exp", "max_years_exp", "is_fresher", "experience_level")},
}
