"""Marts: each is a function of the star and an as-of day.

All are lazy.  ``publish`` turns them into temporary views, ``materialize`` writes
them out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.numbers import percent, steady_round
from postlake.functions.text import bucketize, decode
from postlake.functions.time import (date_key, day, likely_closed, moment, quarter_label,
                                     season, year_month)
from postlake.plans.star import Star, current_companies


def live_and_archived(star: Star, *names: str, side: DataFrame | None = None,
                      how: str = "left") -> DataFrame:
    """Live facts and the archive under one set of columns, flagged ``is_archived``.

    A ``side`` keyed by posting joins each leg before the union: legs stored by
    posting meet it without a shuffle, a union of them would not.
    """
    def leg(df: DataFrame, archived: bool) -> DataFrame:
        df = df.select(*names, F.lit(archived).alias("is_archived"))
        return df if side is None else df.join(side, "posting_id", how)

    return leg(star.facts, False).unionByName(leg(star.archive, True))


def _with_company(df: DataFrame, star: Star) -> DataFrame:
    return df.join(current_companies(star.companies).select("company_id", "company_name"),
                   "company_id", "inner")


def _with_location(df: DataFrame, star: Star) -> DataFrame:
    places = star.locations.select("location_id", F.col("location_normalized").alias("location"))
    return df.join(places, "location_id", "left")


def _with_month(df: DataFrame, star: Star) -> DataFrame:
    """Calendar year and month of the posting date; a posting without one keeps NULLs."""
    dates = star.dates.select("date_id", "year", "month")
    return df.withColumn("date_id", date_key(F.col("date_posted"))).join(dates, "date_id", "left")


def application_tracker(star: Star, as_of, closed_after_days: int = V.CLOSED_AFTER_DAYS) -> DataFrame:
    posts = live_and_archived(star, "posting_id", "company_id", "location_id", "job_title",
                              "role_family", "date_posted", "closing_date", "last_seen_at")
    tracked = star.applications.select("posting_id", "date_applied", "status")
    joined = _with_location(_with_company(posts, star), star).join(tracked, "posting_id", "left")
    closed = likely_closed(F.col("closing_date"), F.col("last_seen_at"), as_of,
                           closed_after_days, F.col("is_archived"))
    return joined.select(
        "posting_id", "company_name", "job_title", "location", "date_posted", "closing_date",
        "last_seen_at", closed.alias("is_likely_closed"), "date_applied", "role_family",
        F.coalesce("status", F.lit(V.NOT_APPLIED)).alias("status"))


def skill_demand_trend(star: Star, as_of) -> DataFrame:
    facts = star.facts.select("posting_id", "date_posted")
    joined = star.mentions.join(star.skills, "skill_id", "inner").join(facts, "posting_id", "inner")
    return (_with_month(joined, star).groupBy("year", "month", "skill_name")
            .agg(F.count_distinct("posting_id").alias("postings_mentioning_skill")))


def hiring_velocity(star: Star, as_of) -> DataFrame:
    facts = star.facts.select("posting_id", "company_id", "date_posted")
    return (_with_month(_with_company(facts, star), star).groupBy("year", "month", "company_name")
            .agg(F.count_distinct("posting_id").alias("postings_posted")))


def activity(df: DataFrame, entity: str, item: str, first: str, last: str, as_of,
             closed_after_days: int) -> DataFrame:
    """Distinct items per entity, split by whether they were last seen before the cut.

    Rows are first reduced to one per entity and item, which makes every distinct
    count a plain sum and lets a hot entity combine before the second shuffle.  An
    item with rows on both sides of the cut counts on both.
    """
    old = F.col(last) < moment(as_of, closed_after_days)
    per_item = df.groupBy(entity, item).agg(
        F.max(F.when(old, 1).otherwise(0)).alias("_closed"),
        F.max(F.when(~old, 1).otherwise(0)).alias("_active"),
        F.min(first).alias("_first"), F.max(last).alias("_last"),
    )
    return per_item.groupBy(entity).agg(
        F.count(item).alias("total_postings"),
        F.sum("_closed").alias("likely_closed_postings"),
        F.sum("_active").alias("active_postings"),
        F.min("_first").alias("earliest_first_seen"),
        F.max("_last").alias("latest_last_seen"),
    )


def company_activity(star: Star, as_of,
                     closed_after_days: int = V.ACTIVITY_CLOSED_AFTER_DAYS) -> DataFrame:
    """Activity per company; names join the aggregate, not the facts."""
    facts = star.facts.select("company_id", "posting_id", "first_seen_at", "last_seen_at")
    counts = activity(facts, "company_id", "posting_id", "first_seen_at", "last_seen_at",
                      as_of, closed_after_days)
    return _with_company(counts, star).select(
        "company_id", "company_name", "total_postings", "likely_closed_postings",
        "active_postings", "earliest_first_seen", "latest_last_seen")


def _or_today(as_of):
    return F.coalesce("date_posted", day(as_of))


def role_market(star: Star, as_of) -> DataFrame:
    pay = star.details.select("posting_id", "salary_min", "salary_max")
    posts = live_and_archived(star, "posting_id", "role_family", "date_posted", side=pay)
    return (
        posts.groupBy("role_family", year_month(_or_today(as_of)).alias("year_month"))
        .agg(F.count_distinct("posting_id").alias("total_postings"),
             steady_round(F.avg("salary_min"), 2).alias("avg_salary_min"),
             steady_round(F.avg("salary_max"), 2).alias("avg_salary_max"))
    )


def seasonality(df: DataFrame, keys: list[str], item: str, date_col: str, flag: str,
                count: str, flagged: str) -> DataFrame:
    """Distinct items and flagged rows per keys and month, with calendar labels.

    Grouped by the month alone: every label follows from it, so labels are added
    afterwards, to one row per group.
    """
    months = df.groupBy(*keys, F.trunc(date_col, "month").alias("_m")).agg(
        F.count_distinct(item).alias(count), F.sum(flag).alias(flagged))
    m = F.col("_m")
    return months.select(
        *keys, season(m).alias("season"), quarter_label(m).alias("quarter"),
        F.year(m).alias("posting_year"), F.month(m).alias("month_of_year"),
        F.date_format(m, "MMMM").alias("month_name"), year_month(m).alias("year_month"),
        count, flagged)


def posting_seasonality(star: Star, as_of) -> DataFrame:
    pay = star.details.select("posting_id", "is_fresher", "experience_level")
    live = (star.facts.select("posting_id", "source_id", "role_family", "date_posted")
            .join(pay, "posting_id", "left"))
    fresh = F.coalesce("is_fresher", F.lit(False)) | F.coalesce(
        F.col("experience_level") == "FRESHER", F.lit(False))
    live = live.withColumn("fresh", F.when(fresh, 1).otherwise(0)).drop("is_fresher", "experience_level")
    archived = star.archive.select("posting_id", "source_id", "role_family", "date_posted",
                                   F.lit(0).alias("fresh"))
    dated = live.unionByName(archived).withColumn("date_posted", _or_today(as_of))
    months = seasonality(dated, ["role_family", "source_id"], "posting_id", "date_posted", "fresh",
                         "posting_count", "fresher_postings_count")
    domain = decode(F.col("role_family"), V.ROLE_LABELS, V.ROLE_LABEL_DEFAULT)
    return months.select(
        "role_family", domain.alias("domain_name"), "season", "quarter", "posting_year",
        "month_of_year", "month_name", "year_month", "source_id", "posting_count",
        "fresher_postings_count")


def pay_stats(df: DataFrame, keys: list, item: str, low: str, high: str) -> DataFrame:
    """Distinct items and the spread of a low and a high figure per group."""
    return df.groupBy(*keys).agg(
        F.count_distinct(item).alias("postings_with_salary"),
        steady_round(F.min(low), 2).alias("min_salary_lowest"),
        steady_round(F.avg(low), 2).alias("avg_salary_min"),
        steady_round(F.avg(high), 2).alias("avg_salary_max"),
        steady_round(F.max(high), 2).alias("max_salary_highest"),
    )


def salary_summary(star: Star, as_of) -> DataFrame:
    """Pay per family, location, source and currency over postings that state some pay.

    Rows without pay are dropped before the join, where the filter reaches the scan.
    """
    paid = (star.details.select("posting_id", "salary_min", "salary_max", "currency")
            .filter(F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()))
    posts = live_and_archived(star, "posting_id", "location_id", "source_id", "role_family",
                              side=paid, how="inner")
    joined = _with_location(posts, star)
    return pay_stats(joined, [
        "role_family", F.coalesce("location", F.lit("Unknown")).alias("location"), "source_id",
        F.coalesce("currency", F.lit("Unknown")).alias("currency"),
    ], "posting_id", "salary_min", "salary_max")


def completeness(df: DataFrame, group: str, item: str, owner: str, incomplete: str,
                 measure: str) -> DataFrame:
    """Items, owners and incomplete rows per group; the percentage is rows over distinct items."""
    counts = df.groupBy(group).agg(
        F.count_distinct(item).alias("total_postings"),
        F.count_distinct(owner).alias("distinct_companies"),
        F.sum(F.when(F.col(incomplete), 1).otherwise(0)).alias("incomplete_postings"),
        F.min(measure).alias("earliest_posting_date"),
        F.max(measure).alias("latest_posting_date"),
    )
    share = percent(F.col("incomplete_postings"), F.col("total_postings"))
    return counts.select(
        group, "total_postings", "distinct_companies", "incomplete_postings",
        share.alias("incomplete_percentage"), "earliest_posting_date", "latest_posting_date")


def source_quality(star: Star, as_of) -> DataFrame:
    posts = live_and_archived(star, "posting_id", "company_id", "source_id", "date_posted",
                              "is_incomplete")
    return completeness(posts, "source_id", "posting_id", "company_id", "is_incomplete", "date_posted")


def application_funnel(star: Star, as_of) -> DataFrame:
    return status_share(star.applications, "status", "date_applied", "posting_id").select(
        "status", F.col("month").alias("application_month"),
        F.col("n").alias("applications_count"), F.col("share").alias("percentage_of_month"))


def status_share(df: DataFrame, status: str, date_col: str, key: str) -> DataFrame:
    """Distinct keys per status and month, and their share of the month.

    The window runs over the aggregate: a handful of rows per month.
    """
    counts = df.groupBy(status, year_month(F.col(date_col)).alias("month")).agg(
        F.count_distinct(key).alias("n"))
    total = F.sum("n").over(Window.partitionBy("month"))
    return counts.withColumn("share", percent(F.col("n"), total))


def longevity(df: DataFrame, keys: list[str], posting: str, first: str, last: str) -> DataFrame:
    """Distribution of days between two times over fixed brackets."""
    days = F.datediff(F.col(last).cast("date"), F.col(first).cast("date"))
    bracket = bucketize(F.col("active_days"), V.LONGEVITY_EDGES, V.LONGEVITY_LABELS)
    return (
        df.withColumn("active_days", days)
        .groupBy(*keys, bracket.alias("longevity_bracket"))
        .agg(F.count_distinct(posting).alias("postings_count"),
             steady_round(F.avg("active_days"), 1).alias("avg_active_days"),
             F.max("active_days").alias("max_active_days"))
    )


def posting_longevity(star: Star, as_of) -> DataFrame:
    posts = live_and_archived(star, "posting_id", "company_id", "source_id", "role_family",
                              "first_seen_at", "last_seen_at")
    return longevity(_with_company(posts, star), ["role_family", "source_id"], "posting_id",
                     "first_seen_at", "last_seen_at")


def _job_match(star: Star, as_of) -> DataFrame:
    from postlake.plans.matching import job_match

    return job_match(star, as_of)


MARTS: dict[str, Callable[..., DataFrame]] = {
    "mart_application_funnel": application_funnel,
    "mart_application_tracker": application_tracker,
    "mart_company_activity": company_activity,
    "mart_hiring_velocity": hiring_velocity,
    "mart_job_match": _job_match,
    "mart_posting_longevity": posting_longevity,
    "mart_posting_seasonality": posting_seasonality,
    "mart_role_market": role_market,
    "mart_salary_summary": salary_summary,
    "mart_skill_demand_trend": skill_demand_trend,
    "mart_source_quality": source_quality,
}


def publish(star: Star, as_of) -> list[str]:
    """Replace every mart's temporary view; nothing is computed until one is read."""
    for name in sorted(MARTS):
        MARTS[name](star, as_of).createOrReplaceTempView(name)
    return sorted(MARTS)


def materialize(star: Star, as_of, store, names: tuple[str, ...] = tuple(MARTS)) -> None:
    """Write marts as snapshots for readers that should not recompute them."""
    for name in names:
        store.commit(name, MARTS[name](star, as_of))
