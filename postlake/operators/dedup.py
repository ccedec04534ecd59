"""Removing repeats: re-pulls of one posting, old versions, copies on other boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.session import stored
from postlake.sources.schemas import columns


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first row of each key, or the first ``k``, with their places as ``rank`` if named.

    Written as ``row_number() <= k`` so that Spark trims every map task to so many rows
    per key before the shuffle: a key holding a third of the table sends one row
    per task, not a third of the table.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= k)
    return kept.withColumnRenamed("_rn", rank) if rank else kept.drop("_rn")


def collapse_repulls(df: DataFrame, seen: str = "seen_at") -> DataFrame:
    """One row per distinct content, with the first and last time it was seen."""
    content = [c for c in df.columns if c != seen]
    return df.groupBy(*content).agg(
        F.min(seen).alias("first_seen_at"), F.max(seen).alias("last_seen_at"))


def latest_version(df: DataFrame, key: str = "posting_id") -> DataFrame:
    """Newest content per key; versions seen at the same time are told apart by content."""
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    return keep_first(df, [key], [F.desc("last_seen_at"), F.desc("first_seen_at"), content])


def earliest_survivor(df: DataFrame, key: str = "dedup_key", tie: str = "posting_id") -> DataFrame:
    """The earliest seen row of each blocking key."""
    return keep_first(df, [key], [F.asc("first_seen_at"), F.asc(tie)])


def content_digest(df: DataFrame, seen: str = "seen_at") -> Column:
    """128-bit digest of all columns but the time seen; NULL and empty text differ."""
    content = [F.col(c).cast("string") for c in sorted(df.columns) if c != seen]
    marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in content]
    return F.md5(F.concat(*marked).cast("binary"))


def narrowed(keyed: DataFrame, *others: str) -> DataFrame:
    """Id, digest and blocking key for ``sightings``, both of these in 16 bytes, and other columns.

    The bytes of a digest sort as its hexadecimal text does.
    """
    return keyed.select("posting_id", F.unhex("digest").alias("digest"),
                        F.unhex(F.md5(F.col("dedup_key").cast("binary"))).alias("dedup_key"), *others)


def sightings(keyed: DataFrame, *extra: Column, seen: str = "seen_at") -> DataFrame:
    """One narrow row per posting and content, with the first and last time it was seen."""
    return keyed.groupBy("posting_id", "digest", "dedup_key").agg(
        F.min(seen).alias("first_seen_at"), F.max(seen).alias("last_seen_at"), *extra)


def survivors(seen: DataFrame) -> DataFrame:
    """Of narrow sightings, the newest per posting, then the earliest per blocking key."""
    latest = keep_first(seen, ["posting_id"], [F.desc("last_seen_at"), F.desc("first_seen_at"), F.asc("digest")])
    return earliest_survivor(latest)


def fetch(keyed: DataFrame, chosen: DataFrame, seen: str = "seen_at") -> DataFrame:
    """The wide row of each chosen posting and content, with the times of ``chosen``.

    Map tasks keep one row per posting and content before anything wide is shuffled, and the
    join then uses that shuffle's partitioning: wide rows travel once.
    """
    one = keep_first(keyed, ["posting_id", "digest"], [F.desc(seen)])
    times = chosen.select("posting_id", "digest", "first_seen_at", "last_seen_at")
    return one.join(times, ["posting_id", "digest"])


def keyed_once(normalized: DataFrame) -> DataFrame:
    """The rows with their content digest, written once to the scratch folder.

    Deciding reads the narrow columns and fetching the wide ones; without the file each
    would parse every payload again.
    """
    return stored(normalized.withColumn("digest", content_digest(normalized)), "keyed")


def latest_content(normalized: DataFrame) -> DataFrame:
    """Newest content per posting, as ``latest_version(collapse_repulls(normalized))``, decided on digests."""
    keyed = keyed_once(normalized)
    chosen = keep_first(sightings(keyed), ["posting_id"], [F.desc("last_seen_at"), F.desc("first_seen_at"), F.asc("digest")])
    return fetch(keyed, chosen).drop("digest", "seen_at")


def deduplicate(normalized: DataFrame) -> DataFrame:
    """Normalised rows to staging: re-pulls, then versions, then copies across sources.

    All three are decided on narrow rows of id, content digest, blocking key and times.
    Rows without an id are no postings; ``split_unidentified`` sets them aside first.
    """
    keyed = keyed_once(normalized)
    return fetch(keyed, survivors(sightings(keyed))).select(*columns("staging_postings"))
