"""The star schema: dimensions and facts out of staging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.experience import with_experience
from postlake.functions.time import moment
from postlake.operators import dims
from postlake.operators.dedup import keep_first
from postlake.operators.merge import DETAIL_RULES, FACT_RULES, Rule, greatest, insert_missing, merge_upsert
from postlake.operators.scd2 import company_snapshot, scd2_apply
from postlake.operators.tagging import skill_mentions
from postlake.sources.schemas import columns, empty, seed_skills
from postlake.sources.snapshots import month_partition, overwrite_touched


@dataclass(frozen=True)
class Star:
    """The gold tables the marts read."""

    facts: DataFrame
    archive: DataFrame
    details: DataFrame
    mentions: DataFrame
    companies: DataFrame
    locations: DataFrame
    skills: DataFrame
    dates: DataFrame
    applications: DataFrame
    hidden: DataFrame
    profiles: DataFrame

    def replace(self, **tables: DataFrame) -> Star:
        return Star(**{**self.__dict__, **tables})


def current_companies(companies: DataFrame) -> DataFrame:
    return companies.filter("is_current")


def insert_companies(companies: DataFrame, staging: DataFrame, as_of) -> DataFrame:
    """New companies only; known ones are not touched."""
    fresh = company_snapshot(staging).select(
        "*", moment(as_of).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))
    return insert_missing(companies, fresh, ["company_id"])


def refresh_companies(companies: DataFrame, staging: DataFrame, as_of) -> DataFrame:
    """Open new companies and version changed ones; covers the insert-only load."""
    return scd2_apply(companies, company_snapshot(staging), "company_id", ["display_name"],
                      moment(as_of))


def staged_facts(staging: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """Fact rows of staging with their dimension keys, unique by posting and date.

    Reduced to one row per key before the dimension joins, so the joins see the
    smaller input.
    """
    unique = keep_first(
        staging,
        ["posting_id", F.coalesce("date_posted", F.lit("1970-01-01").cast("date"))],
        [F.desc("last_seen_at"), F.desc("first_seen_at")])
    keyed = unique.withColumn("company_id", F.md5(F.lower("company_name").cast("binary")))
    known = current_companies(companies).select("company_id", F.lit(True).alias("_known"))
    places = locations.select("location_id", "location_normalized")
    return (
        keyed.join(known, "company_id", "left")
        .withColumn("company_id", F.when(F.col("_known"), F.col("company_id")))
        .join(places, "location_normalized", "left")
        .select(*columns("fact_job_posting"))
    )


def upsert_facts(facts: DataFrame, staged: DataFrame, monotonic: bool = False) -> DataFrame:
    """Fact merge on posting and date, NULL dates included; never deletes.

    ``monotonic`` keeps the later of the two last-seen times, so a replayed old
    batch cannot move it back.
    """
    rules: dict[str, Rule] = dict(FACT_RULES)
    if monotonic:
        rules["last_seen_at"] = greatest
    return merge_upsert(facts, staged, ["posting_id", "date_posted"], rules, nullable=["date_posted"])


def upsert_fact_months(spark, path: str, staged: DataFrame) -> None:
    """Fact merge in place on a table partitioned by posting month.

    The date is part of the key, so a staged row can only meet target rows of its
    own month: other months are neither read nor rewritten.
    """
    staged = staged.withColumn("posted_month", month_partition("date_posted"))
    months = [r[0] for r in staged.select("posted_month").distinct().collect()]  # one per month
    facts = spark.read.parquet(path).filter(F.col("posted_month").isin(months))
    merged = upsert_facts(facts.select(*columns("fact_job_posting")),
                          staged.select(*columns("fact_job_posting")))
    overwrite_touched(spark, path, merged.withColumn("posted_month", month_partition("date_posted")),
                      "posted_month")


def staged_details(staging: DataFrame) -> DataFrame:
    unique = keep_first(staging, ["posting_id"], [F.desc("last_seen_at"), F.desc("first_seen_at")])
    return with_experience(unique).select(*columns("job_posting_detail"))


def upsert_details(details: DataFrame, staged: DataFrame) -> DataFrame:
    """Detail merge on posting: known values survive a NULL, derived ones are replaced."""
    return merge_upsert(details, staged, ["posting_id"], DETAIL_RULES, nullable=[])


def mentions(staging: DataFrame, skills=V.SKILLS) -> DataFrame:
    return skill_mentions(staging, skills)


def first_load(staging: DataFrame, as_of) -> dict[str, DataFrame]:
    """Gold tables from staging alone, by table name; companies and locations come first."""
    spark = staging.sparkSession
    return {
        "dim_company": refresh_companies(empty(spark, "dim_company"), staging, as_of),
        "dim_location": dims.locations(staging),
        "dim_skill": seed_skills(spark),
        "dim_date": dims.calendar(staging, "date_posted", as_of),
        "job_posting_detail": staged_details(staging),
        "fact_posting_skill_mention": mentions(staging),
    }
