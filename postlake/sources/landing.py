"""Landing raw records: unwrap, assemble, enrich, isolate bad rows, stamp, append."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import moment
from postlake.session import compiled_methods, passing_shuffles

# Where each source keeps its records in a response body; None is a bare list.
ENVELOPES = {
    "adzuna": "results",
    "greenhouse": "jobs",
    "ashby": "jobs",
    "rippling": "items",
    "lever": None,
}
# The configuration column that names a source's board.
BOARD_COLUMNS = {
    "greenhouse": "greenhouse_board_token",
    "lever": "lever_company_slug",
    "rippling": "rippling_board_slug",
    "ashby": "ashby_board_slug",
}


@dataclass(frozen=True)
class Split:
    """Rows that passed a check, and the rest with a ``reason``."""

    good: DataFrame
    quarantine: DataFrame


def _split(df: DataFrame, bad: Column, reason: str) -> Split:
    flag = F.coalesce(bad, F.lit(True))
    return Split(df.filter(~flag), df.filter(flag).withColumn("reason", F.lit(reason)))


def split_unknown_sources(df: DataFrame, source_col: str = "source_id",
                          allowed=tuple(V.SOURCES)) -> Split:
    return _split(df, ~F.col(source_col).isin(*allowed), "UNKNOWN_SOURCE")


def split_unsupported_countries(df: DataFrame, country_col: str = "country",
                                allowed=V.COUNTRIES) -> Split:
    return _split(df, ~F.col(country_col).isin(*allowed), "UNSUPPORTED_COUNTRY")


def is_json(text: Column) -> Column:
    """True when the whole text is one JSON value.

    Read as the only element of an array: a path lookup, and Spark's own parsers,
    accept a record that is cut off after the member asked for or goes on after
    its end.
    """
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.coalesce(F.size(F.from_json(wrapped, "array<string>")) == 1, F.lit(False))


def split_malformed(df: DataFrame, payload: str = "payload") -> Split:
    return _split(df, ~is_json(F.col(payload)), "PARSE_ERROR")


def unwrap(bodies: DataFrame, body: str = "body", member: str | None = None,
           out: str = "payload") -> DataFrame:
    """Response bodies to one row per record.

    A body whose envelope has another type gives no rows rather than an error;
    ``split_bodies`` sets it aside first.
    """
    listing = F.col(body) if member is None else F.get_json_object(body, f"$.{member}")
    records = F.from_json(listing, "array<string>")
    others = [c for c in bodies.columns if c != body]
    return bodies.select(*others, F.explode(records).alias(out))


def split_bodies(bodies: DataFrame, body: str = "body", member: str | None = None) -> Split:
    """Bodies that hold a list of records, and the cut off or misshapen ones."""
    listing = F.col(body) if member is None else F.get_json_object(body, f"$.{member}")
    lists = F.coalesce(F.ltrim(listing).startswith("["), F.lit(False))
    return _split(bodies, ~(is_json(F.col(body)) & lists), "PARSE_ERROR")


def assemble_details(listed: DataFrame, details: DataFrame, keys: list[str],
                     record: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Details of listed ids, and the listed ids whose detail is missing.

    Entries without an id and details that are not objects are dropped.
    """
    known = listed.filter(F.col(keys[-1]).isNotNull())
    objects = details.filter(F.ltrim(F.col(record)).startswith("{") & is_json(F.col(record)))
    found = known.join(objects, keys, "inner")
    missing = known.join(objects.select(*keys), keys, "left_anti")
    return found, missing


def enrich(df: DataFrame, lookup: DataFrame, key: str, columns: dict[str, str],
           fallback: dict[str, Column] | None = None) -> DataFrame:
    """Add lookup columns by key; names without a match take their fallback.

    The join is left to AQE: a lookup small enough at run time is broadcast.
    """
    side = lookup.select(key, *[F.col(c).alias(f"_l_{name}") for name, c in columns.items()])
    joined = df.join(side, key, "left")
    fallback = fallback or {}
    added = {
        name: F.coalesce(F.col(f"_l_{name}"), *([fallback[name]] if name in fallback else []))
        for name in columns
    }
    return joined.withColumns(added).drop(*[f"_l_{name}" for name in columns])


def enrich_companies(raw: DataFrame, companies: DataFrame, source: str) -> DataFrame:
    """Company attributes by board token, merged over the payload's own members.

    Lever falls back to the payload's company before ``Unknown``.
    """
    board = BOARD_COLUMNS[source]
    lookup = companies.filter(F.col(board).isNotNull()).withColumnRenamed(board, "board_token")
    own = [F.get_json_object("payload", "$.company")] if source == "lever" else []
    enriched = enrich(
        raw, lookup, "board_token",
        {"company_display_name": "display_name", "company_industry": "industry",
         "company_locations": "locations", "hiring_pace": "hiring_pace"},
        {"company_display_name": F.coalesce(*own, F.lit("Unknown"))},
    )
    return enriched.withColumn("payload", overlay_members(
        F.col("payload"),
        F.to_json(F.struct("company_display_name", "company_industry",
                           "company_locations", "hiring_pace"))))


def overlay_members(payload: Column, extra: Column) -> Column:
    """JSON object text with the members of another object put over its own.

    Both are read as maps of raw member text, so untouched members keep their
    value; strings are the only members that need quoting again.  A payload that
    can't be read so, cut off or with a repeated member, stays as it is.
    """
    merged = F.map_zip_with(
        _members(payload), _members(extra), lambda _, own, new: F.coalesce(new, own))

    def member(entry: Column) -> Column:
        name = F.to_json(F.array(entry["key"]))  # a quoted name in brackets
        return F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":"), entry["value"])

    text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(merged), member), ","), F.lit("}"))
    return F.coalesce(text, payload)


def _members(payload: Column) -> Column:
    """Map of member name to the member's JSON text."""
    parsed = F.try_parse_json(payload)
    variants = F.try_variant_get(parsed, "$", "map<string,variant>")
    return F.transform_values(variants, lambda _, v: F.to_json(v))


def stamp(records: DataFrame, run_id: str, as_of, source: str | None = None,
          record: str | None = None) -> DataFrame:
    """Raw rows: the record as JSON text, the run, and the landing time to the second."""
    payload = F.col(record) if record else F.to_json(F.struct("*"))
    out = records.select(
        *([] if source else ["source_id"]),
        payload.alias("payload"),
        F.lit(run_id).alias("run_id"),
        F.date_trunc("second", moment(as_of)).alias("ingested_at"),
    )
    return out.withColumn("source_id", F.lit(source)) if source else out


def append_raw(raw: DataFrame, path: str, partition_by=("source_id", "ingest_date")) -> int:
    """Append landed rows, partitioned by source and day, and return how many.

    Rows are first brought together by partition, so that a folder gets files of good size and
    not one from every task; Spark splits a large folder over several tasks.  The count is
    observed while writing; no second pass.
    """
    seen = Observation()
    counted = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    if "ingest_date" in partition_by:
        counted = counted.withColumn("ingest_date", F.to_date("ingested_at"))
    with compiled_methods(raw.sparkSession), passing_shuffles(raw.sparkSession):
        counted.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    return int(seen.get["rows"])


def land(source: str, records: DataFrame, run_id: str, as_of, path: str) -> int:
    """Land one source's records; an unknown source is refused before anything is written."""
    if source not in V.SOURCES:
        raise ValueError(f"unsupported source {source!r}; allowed: {sorted(V.SOURCES)}")
    return append_raw(stamp(records, run_id, as_of, source), path)


def content_hashes(raw: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """Keys and content digest of landed rows: the narrow table change capture keeps."""
    return raw.select(*keys, F.md5(F.col(payload).cast("binary")).alias("content_hash"))


def changed_only(batch: DataFrame, hashes: DataFrame, keys: list[str],
                 payload: str = "payload") -> DataFrame:
    """Records of a batch whose content was not landed before under the same key."""
    hashed = batch.withColumn("content_hash", F.md5(F.col(payload).cast("binary")))
    return hashed.join(hashes, [*keys, "content_hash"], "left_anti").select(*batch.columns)
