"""Reference configuration: companies, portal directory, profile.

The YAML files are small and hand-written; they are read on the driver and
become DataFrames.  Everything after that is an ordinary relation.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPANY = (
    "display_name string, greenhouse_board_token string, lever_company_slug string, "
    "ashby_board_slug string, rippling_board_slug string, industry string, "
    "locations array<string>, hiring_pace string, notes string"
)
PORTAL = (
    "map<string, array<struct<company: string, careers_url: string, locations: array<string>, "
    "industry: string, programs: array<string>, hiring_criteria: string, stipend: string, "
    "type: string>>>"
)


def _load_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}


def _from_json_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    texts = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
    return texts.select(F.from_json("j", schema).alias("r")).select("r.*")


def companies(spark: SparkSession, path: str) -> DataFrame:
    return _from_json_rows(spark, _load_yaml(path).get("companies") or [], COMPANY)


def portal_directory(spark: SparkSession, path: str) -> DataFrame:
    """One row holding the whole directory as a map of category to entries."""
    text = json.dumps(_load_yaml(path).get("enterprise_categories") or {}, default=str)
    return spark.createDataFrame([(text,)], "j string").select(
        F.from_json("j", PORTAL).alias("directory"))


def flatten_directory(df: DataFrame, directory: str = "directory", category: str = "category",
                      nested: str | None = None, nested_out: str | None = None) -> DataFrame:
    """A map of category to entry list, flattened to one row per entry.

    With ``nested``, entries also fan out over that array; an entry without one
    keeps a single row.
    """
    others = [c for c in df.columns if c != directory]
    lists = df.select(*others, F.explode(directory).alias(category, "_entries"))
    entries = (lists.select(*others, category, F.explode("_entries").alias("_e"))
               .select(*others, category, "_e.*"))
    if nested is None:
        return entries
    keep = [c for c in entries.columns if c != nested]
    return entries.select(*keep, F.explode_outer(nested).alias(nested_out or nested))


def profile(spark: SparkSession, path: str, as_of) -> DataFrame:
    """The single profile row of a YAML file, as a change set for the profile table."""
    from postlake.operators.profiles import profile_row

    stored = _load_yaml(path).get("profile") or {}
    return profile_row(spark, as_of, **stored)
