"""Raw payload rows of five shapes to one posting shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import text
from postlake.operators.dedup import content_digest
from postlake.sources.landing import is_json
from postlake.sources.schemas import columns
from postlake.sources.specs import SPECS, SourceSpec, first_value, value_at

MISSING = "Unknown"


def _location(spec: SourceSpec, record: Column, remote_fallback: bool) -> Column:
    found = first_value(record, spec.location)
    if not spec.location_parts:
        return found
    joined = F.concat_ws(", ", *[value_at(record, p) for p in spec.location_parts])
    if remote_fallback:
        # Joined text is never NULL, so the remote flag only counts once blank text is dropped.
        joined = F.nullif(joined, F.lit(""))
    remote = F.when(first_value(record, spec.remote_flag) == "true", "Remote").otherwise("Unspecified")
    return F.coalesce(found, joined, remote)


def _description(spec: SourceSpec, record: Column) -> Column:
    whole = first_value(record, spec.description)
    if not spec.description_members:
        return whole
    # An object read into a string leaf arrives as its JSON text.
    members = [F.get_json_object(whole, f"$.{name}") for name in spec.description_members]
    return F.coalesce(*members, whole)


def extract(raw: DataFrame, spec: SourceSpec, remote_fallback: bool = False,
            payload: str = "payload", seen: str = "ingested_at", keep: tuple[str, ...] = ()) -> DataFrame:
    """One source's payload rows as raw posting fields, before any cleaning; columns in ``keep`` go along."""
    parsed = raw.select(F.from_json(payload, spec.schema()).alias("r"), F.col(seen).alias("seen_at"), *keep)
    r = F.col("r")
    company = [F.trim(value_at(r, p)) for p in spec.company]
    missing = (first_value(r, spec.title).isNull()
               | first_value(r, spec.company).isNull()
               | first_value(r, spec.location_required or spec.location).isNull()
               | spec.to_day(first_value(r, spec.posted)).isNull())
    return parsed.select(
        F.concat(F.lit(spec.source_id + "-"), first_value(r, spec.key)).alias("posting_id"),
        F.lit(spec.source_id).alias("source_id"),
        F.coalesce(*company, F.lit(MISSING)).alias("company_name"),
        _location(spec, r, remote_fallback).alias("location_raw"),
        spec.to_day(first_value(r, spec.posted)).alias("date_posted"),
        spec.to_day(first_value(r, spec.closing)).alias("closing_date"),
        F.coalesce(F.trim(first_value(r, spec.title)), F.lit(MISSING)).alias("job_title"),
        _description(spec, r).alias("description"),
        first_value(r, spec.posting_url).alias("posting_url"),
        first_value(r, spec.apply_url).alias("apply_url"),
        first_value(r, spec.salary_min).try_cast("double").alias("salary_min"),
        first_value(r, spec.salary_max).try_cast("double").alias("salary_max"),
        first_value(r, spec.currency).alias("currency"),
        first_value(r, spec.employment_type).alias("employment_type"),
        "seen_at",
        missing.alias("is_incomplete"),
        *keep,
    )


def clean(extracted: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Location, role family, plain description and blocking key of extracted rows."""
    shaped = (
        extracted
        .withColumn("display_name", F.col("company_name"))
        .withColumn("location_normalized", text.normalize_location(F.col("location_raw")))
        .withColumn("role_family", text.classify(F.col("job_title")))
        .withColumn("description", text.strip_markup(F.col("description")))
        .withColumn("dedup_key", text.block_key(
            F.col("company_name"), F.col("job_title"), F.col("location_normalized")))
    )
    return shaped.select(*columns("staging_postings_normalized"), *keep)


def normalize(raw: DataFrame, source_col: str = "source_id", specs=SPECS,
              remote_fallback: bool = False) -> DataFrame:
    """All sources in one relation.

    Each branch filters on the source column.  Landed data is partitioned by it,
    so every branch opens only its own directories and the union reads each row
    once.
    """
    branches = [
        extract(raw.filter(F.col(source_col) == name), spec, remote_fallback)
        for name, spec in specs.items()
    ]
    return clean(reduce(DataFrame.unionByName, branches))


# Why a landed row is no posting.
REFUSALS = ("PARSE_ERROR", "MISSING_ID", "UNKNOWN_SOURCE")


def judged(raw: DataFrame, keep: tuple[str, ...] = (), source_col: str = "source_id",
           payload: str = "payload", specs=SPECS) -> DataFrame:
    """Every landed row once: normalised with its content digest, or refused with a ``reason``.

    A refused row keeps its payload and source; of a posting the payload is left out.
    """
    carried = (payload, *keep)
    branches = [clean(extract(raw.filter(F.col(source_col) == name), spec, keep=carried), carried) for name, spec in specs.items()]
    known = reduce(DataFrame.unionByName, branches)
    reason = (F.when(~is_json(F.col(payload)), "PARSE_ERROR").when(F.col("posting_id").isNull(), "MISSING_ID"))
    digest = content_digest(known.drop(*carried))
    known = known.withColumn("digest", digest).withColumn("reason", reason)
    strange = raw.filter(~F.coalesce(F.col(source_col).isin(*specs), F.lit(False))).select(
        F.col(source_col).alias("source_id"), F.col("ingested_at").alias("seen_at"), *carried).withColumn("reason", F.lit("UNKNOWN_SOURCE"))
    return (known.unionByName(strange, allowMissingColumns=True)
            .withColumn(payload, F.when(F.col("reason").isNotNull(), F.col(payload))))


def split_unidentified(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings with an id, and those without one, which no later key can tell apart."""
    known = F.col("posting_id").isNotNull()
    return normalized.filter(known), normalized.filter(~known)
