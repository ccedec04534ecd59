"""User profiles: JSON-text lists, defaults, typed view."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import moment
from postlake.sources.schemas import TABLES

LISTS = ("target_roles", "target_skills", "preferred_locations")


def profile_row(spark: SparkSession, as_of, **values) -> DataFrame:
    """One stored profile row; list values are kept as JSON text."""
    defaults = {"profile_id": "default", "target_roles": [], "target_skills": [],
                "preferred_locations": [], "remote_preference": "ANY", "min_salary": 0.0,
                "currency": "INR", "seniority_level": "ENTRY"}
    row = {**defaults, **values}
    row = {k: json.dumps(v) if k in LISTS else v for k, v in row.items()}
    row["min_salary"] = float(row["min_salary"])
    schema = TABLES["user_profile"].rsplit(",", 1)[0]
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    frame = spark.createDataFrame([tuple(row[n] for n in names)], schema)
    return frame.withColumn("updated_at", moment(as_of))


def parse(profiles: DataFrame, fallback: dict = V.PROFILE_FALLBACK) -> DataFrame:
    """Stored profiles with list columns as arrays and missing fields filled in."""
    def strings(values):
        return F.array(*[F.lit(v) for v in values])

    lists = {
        name: F.coalesce(F.from_json(name, "array<string>"), strings(fallback[name]))
        for name in LISTS
    }
    scalars = {
        name: F.coalesce(F.col(name), F.lit(fallback[name]))
        for name in ("remote_preference", "min_salary", "seniority_level")
    }
    return profiles.withColumns({**lists, **scalars})


def current_profile(profiles: DataFrame, profile_id: str = "default") -> DataFrame:
    """The newest row of one profile, or the default profile when none is stored."""
    spark = profiles.sparkSession
    names = [n for n in V.PROFILE_DEFAULT]
    stored = parse(profiles.filter(F.col("profile_id") == profile_id)).withColumn("_at", F.col("updated_at"))
    default = spark.createDataFrame(
        [tuple(V.PROFILE_DEFAULT.values())],
        "profile_id string, target_roles array<string>, target_skills array<string>, "
        "preferred_locations array<string>, remote_preference string, min_salary double, "
        "currency string, seniority_level string",
    ).withColumn("_at", F.lit(None).cast("timestamp"))
    both = stored.select(*names, "_at").unionByName(default)
    return both.orderBy(F.desc_nulls_last("_at")).limit(1).drop("_at")
