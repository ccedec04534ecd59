"""Retention: dropping old raw rows, archiving and purging stale postings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import closing_passed, day, iso_text, moment, unseen_since
from postlake.operators.dedup import keep_first
from postlake.operators.merge import keep_referenced
from postlake.sources.archive import ARCHIVE


def _positive(days: int) -> int:
    if days <= 0:
        raise ValueError(f"retention days must be positive; got {days}")
    return days


def retention_split(raw: DataFrame, as_of, days: int = V.RAW_RETENTION_DAYS,
                    ts: str = "ingested_at", source: str = "source_id",
                    partition: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw rows inside the window, and the number dropped per source.

    ``partition`` names a column with the date of ``ts``.  Both sides are then also
    cut by it, which leaves whole partitions unread.
    """
    old = F.coalesce(F.col(ts) < moment(as_of, _positive(days)), F.lit(False))
    kept, dropped = raw.filter(~old), raw.filter(old)
    if partition:
        kept = kept.filter(F.col(partition) >= day(as_of, days))
        dropped = dropped.filter(F.col(partition) <= day(as_of, days))
    return kept, dropped.groupBy(source).agg(F.count(F.lit(1)).alias("rows_deleted"))


def is_stale(as_of, days: int = V.POSTING_RETENTION_DAYS) -> Column:
    """Past its closing date, or not seen for a number of days.

    This and ``is_live`` are plain comparisons, so both sides of a split are
    filtered in the scan; together they cover every row once.
    """
    return ((F.col("closing_date") < day(as_of))
            | unseen_since(F.col("last_seen_at"), as_of, _positive(days)))


def is_live(as_of, days: int = V.POSTING_RETENTION_DAYS) -> Column:
    closing, seen = F.col("closing_date"), F.col("last_seen_at")
    return ((closing.isNull() | (closing >= day(as_of)))
            & (seen.isNull() | (seen >= moment(as_of, _positive(days)))))


def archive_reason(as_of, closing: Column, legacy: bool = False) -> Column:
    """DATE_PASSED for a closing date in the past; ``legacy`` says so for any closing date."""
    passed = closing.isNotNull() if legacy else closing_passed(closing, as_of)
    return F.when(passed, "DATE_PASSED").otherwise("NO_LONGER_SEEN")


def denormalize(facts: DataFrame, companies: DataFrame, locations: DataFrame,
                details: DataFrame) -> DataFrame:
    """Facts with company, location and detail columns, one export row each."""
    current = companies.filter("is_current").select("company_id", "company_name")
    places = locations.select("location_id", F.col("location_normalized").alias("location"))
    side = details.select("posting_id", "salary_min", "salary_max", "currency",
                          "employment_type", "posting_url", "apply_url", "description")
    return (
        facts.join(current, "company_id", "left").join(places, "location_id", "left")
        .join(side, "posting_id", "left")
        .select("posting_id", "job_title", "role_family", "company_name", "location", "source_id",
                "date_posted", "closing_date", "first_seen_at", "last_seen_at", "is_incomplete",
                "salary_min", "salary_max", "currency", "employment_type", "posting_url",
                "apply_url", "description")
    )


def encode(rows: DataFrame, as_of, legacy_reason: bool = False) -> DataFrame:
    """Export rows as archive rows: ISO text times, reason, and a base64 token.

    The token covers id, family and last-seen time, with ``None`` for a missing part.
    """
    kinds = dict(rows.dtypes)
    plain = {name: iso_text(F.col(name), kind)
             for name, kind in kinds.items() if kind in ("date", "timestamp")}
    def part(column):
        return F.coalesce(column, F.lit("None"))
    token = F.concat_ws("|", part(F.col("posting_id")), part(F.col("role_family")),
                        part(plain["last_seen_at"]))
    names = [field.split(" ")[0] for field in ARCHIVE.split(", ")]
    return rows.select(
        *[plain.get(n, F.col(n)).alias(n) for n in rows.columns],
        iso_text(moment(as_of), "timestamp").alias("archived_at"),
        archive_reason(as_of, F.col("closing_date"), legacy_reason).alias("archive_reason"),
        F.base64(F.encode(token, "UTF-8")).alias("_encoded_token"),
    ).select(*names)


@dataclass(frozen=True)
class Purge:
    """What an archive run leaves behind."""

    facts: DataFrame       # live facts
    archive: DataFrame     # the archive table
    details: DataFrame     # details of live facts
    mentions: DataFrame    # skill mentions of live facts
    encoded: DataFrame     # rows to append to the cold archive
    counts: DataFrame      # encoded_count, purged_count, total_archived_offline


def latest_of(stale: DataFrame, archived: DataFrame) -> DataFrame:
    """Stale and archived rows as one row per posting; a live row wins over an archived one."""
    ranked = (stale.withColumn("_rank", F.lit(0))
              .unionByName(archived.select(*stale.columns).withColumn("_rank", F.lit(1))))
    order = [F.asc("_rank"), F.desc("last_seen_at"), F.desc_nulls_last("date_posted"),
             F.xxhash64(*stale.columns)]
    return keep_first(ranked.filter(F.col("posting_id").isNotNull()), ["posting_id"], order).drop("_rank")


def not_archived(stale: DataFrame, archive: DataFrame) -> DataFrame:
    """Stale rows the archive does not hold in this very sighting, so that a run that died
    after writing the archive can be repeated."""
    held = archive.select(F.col("posting_id").alias("_id"), F.col("date_posted").alias("_date"),
                          F.col("last_seen_at").alias("_seen"))
    same = ((F.col("posting_id") == F.col("_id")) & F.col("date_posted").eqNullSafe(F.col("_date"))
            & F.col("last_seen_at").eqNullSafe(F.col("_seen")))
    return stale.join(held, same, "left_anti")


def archive_split(facts: DataFrame, archive: DataFrame, companies: DataFrame,
                  locations: DataFrame, details: DataFrame, mentions: DataFrame,
                  archived_ids: DataFrame, as_of, days: int = V.POSTING_RETENTION_DAYS,
                  cold_only: bool = False) -> Purge:
    """Move stale facts out of the live tables.

    Stale facts join the archive table (or, with ``cold_only``, the table is left
    empty and only the cold archive keeps them).  Postings already in the cold
    archive are left out before anything is ranked or encoded, which makes a repeated
    run harmless and cheap.
    """
    stale = facts.filter(is_stale(as_of, days))
    live = facts.filter(is_live(as_of, days))
    known = archived_ids.select("posting_id").distinct()
    fresh = latest_of(stale.join(known, "posting_id", "left_anti"), archive.join(known, "posting_id", "left_anti"))
    encoded = encode(denormalize(fresh, companies, locations, details), as_of)
    stamped = stale.select(
        "*", moment(as_of).alias("archived_at"),
        archive_reason(as_of, F.col("closing_date")).alias("archive_reason"))
    kept = archive.limit(0) if cold_only else archive.unionByName(
        not_archived(stamped, archive).select(*archive.columns))
    ids = live.select("posting_id").distinct()
    moved = (stale.select("posting_id").unionByName(archive.select("posting_id"))
             .filter(F.col("posting_id").isNotNull()).distinct())
    counts = (
        moved.withColumn("_moved", F.lit(1))
        .join(known.withColumn("_cold", F.lit(1)), "posting_id", "full_outer")
        .agg(F.count(F.when(F.col("_cold").isNull(), 1)).alias("encoded_count"),
             F.count("_moved").alias("purged_count"),
             F.count(F.lit(1)).alias("total_archived_offline"))
    )
    return Purge(live, kept, keep_referenced(details, ids, "posting_id"),
                 keep_referenced(mentions, ids, "posting_id"), encoded, counts)
