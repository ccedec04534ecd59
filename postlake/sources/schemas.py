"""Table schemas and seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import moment

RAW = "payload string, run_id string, ingested_at timestamp"

_POSTING_HEAD = (
    "posting_id string, source_id string, company_name string, display_name string, "
    "location_raw string, location_normalized string, job_title string, role_family string, "
    "date_posted date, closing_date date, description string, posting_url string, "
    "apply_url string, salary_min double, salary_max double, currency string, "
    "employment_type string"
)
_FACT = (
    "posting_id string, company_id string, location_id string, source_id string, "
    "job_title string, role_family string, date_posted date, closing_date date, "
    "first_seen_at timestamp, last_seen_at timestamp, is_incomplete boolean"
)

TABLES = {
    "staging_postings_normalized":
        f"{_POSTING_HEAD}, seen_at timestamp, is_incomplete boolean, dedup_key string",
    "staging_postings":
        f"{_POSTING_HEAD}, first_seen_at timestamp, last_seen_at timestamp, is_incomplete boolean",
    "staging_ranking":
        "posting_id string, digest string, first_seen_at timestamp, last_seen_at timestamp, home date",
    "dim_company":
        "company_id string, company_name string, display_name string, "
        "valid_from timestamp, valid_to timestamp, is_current boolean",
    "dim_location": "location_id string, location_raw string, location_normalized string",
    "dim_skill": "skill_id string, skill_name string",
    "dim_date": "date_id bigint, date date, day_of_week string, month bigint, year bigint",
    "dim_source": "source_id string, source_name string",
    "fact_job_posting": _FACT,
    "fact_job_posting_archive": f"{_FACT}, archived_at timestamp, archive_reason string",
    "job_posting_detail":
        "posting_id string, description string, posting_url string, apply_url string, "
        "salary_min double, salary_max double, currency string, employment_type string, "
        "last_seen_at timestamp, min_years_exp int, max_years_exp int, is_fresher boolean, "
        "experience_level string",
    "fact_posting_skill_mention": "posting_id string, skill_id string",
    "applications":
        "posting_id string, date_applied date, status string, updated_at timestamp",
    "job_notes":
        "note_id string, posting_id string, note string, created_at timestamp, "
        "updated_at timestamp",
    "hidden_jobs": "posting_id string, hidden_at timestamp",
    "user_profile":
        "profile_id string, target_roles string, target_skills string, "
        "preferred_locations string, remote_preference string, min_salary double, "
        "currency string, seniority_level string, updated_at timestamp",
    "app_state": "state_key string, state_value string, updated_at timestamp",
    "pipeline_run_log":
        "run_id string, source string, status string, rows_written bigint, "
        "started_at timestamp, ended_at timestamp",
    "data_quality_log":
        "run_id string, rule_name string, status string, rows_affected bigint, "
        "checked_at timestamp",
}

# Tables whose joins and merges go by posting.
BUCKETED = {
    "fact_job_posting": "posting_id",
    "fact_job_posting_archive": "posting_id",
    "job_posting_detail": "posting_id",
    "fact_posting_skill_mention": "posting_id",
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def columns(name: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in TABLES[name].split(",")]


def seed_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(V.SOURCES.items()), TABLES["dim_source"])


def seed_skills(spark: SparkSession, skills=V.SKILLS) -> DataFrame:
    names = spark.createDataFrame([(s,) for s in skills], "skill_name string")
    return names.select(F.md5(F.lower("skill_name").cast("binary")).alias("skill_id"), "skill_name")


def seed_app_state(spark: SparkSession, as_of) -> DataFrame:
    keys = spark.createDataFrame([("last_viewed_at",)], "state_key string")
    return keys.select(
        "state_key",
        moment(as_of).cast("string").alias("state_value"),
        moment(as_of).alias("updated_at"),
    )
