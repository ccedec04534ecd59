"""Read side: key figures, browsing, feeds, comparisons, catalogs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_figures(facts: DataFrame, applications: DataFrame, companies: DataFrame,
                skills: DataFrame) -> DataFrame:
    """One row per figure; each is one aggregate that never leaves the executors."""
    def figure(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")

    rows = F.count(F.lit(1))
    return (
        figure("live_postings", facts, rows)
        .unionByName(figure("tracked_postings", applications, rows))
        .unionByName(figure("current_companies", companies.filter("is_current"),
                            F.count_distinct("company_name")))
        .unionByName(figure("cataloged_skills", skills, rows))
    )


def top_totals(df: DataFrame, key: str, measure: str, k: int, out: str) -> DataFrame:
    """The k largest totals of a measure, ties by key."""
    return (df.groupBy(key).agg(F.sum(measure).cast("bigint").alias(out))
            .orderBy(F.desc(out), F.asc(key)).limit(k))


def top_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


# The sort orders of the browse view, each completed by the posting id.
SORTS = {
    "date_posted": [F.desc_nulls_last, "date_posted"],
    "match_score": [F.desc_nulls_last, "match_score"],
    "salary": [F.desc_nulls_last, "salary_max"],
    "company": [F.asc_nulls_last, "company_name"],
    "last_seen": [F.desc_nulls_last, "last_seen_at"],
}


@dataclass(frozen=True)
class BrowseFilter:
    """Conditions of a browse; an empty one does not filter."""

    keyword: str | None = None
    families: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    companies: tuple[str, ...] = ()
    location: str | None = None
    posted_from: date | None = None
    posted_to: date | None = None
    salary_from: float | None = None
    salary_to: float | None = None
    skills: tuple[str, ...] = ()
    likely_closed: bool | None = None
    archived: bool | None = None
    min_score: float | None = None
    extra: tuple[Column, ...] = field(default_factory=tuple)

    def conditions(self) -> list[Column]:
        found = list(self.extra)
        if self.keyword:
            word = self.keyword.lower()
            text = F.concat_ws(" ", "job_title", "description")
            found.append(F.lower(text).contains(word))
        for name, values in (("role_family", self.families), ("source_id", self.sources),
                             ("company_name", self.companies)):
            if values:
                found.append(F.col(name).isin(*values))
        if self.location:
            found.append(F.lower("location").contains(self.location.lower()))
        if self.posted_from:
            found.append(F.col("date_posted") >= F.lit(self.posted_from))
        if self.posted_to:
            found.append(F.col("date_posted") <= F.lit(self.posted_to))
        if self.salary_from is not None:
            found.append(F.coalesce("salary_max", "salary_min") >= self.salary_from)
        if self.salary_to is not None:
            found.append(F.coalesce("salary_min", "salary_max") <= self.salary_to)
        if self.likely_closed is not None:
            found.append(F.col("is_likely_closed") == self.likely_closed)
        if self.archived is not None:
            found.append(F.col("is_archived") == self.archived)
        if self.min_score is not None:
            found.append(F.col("match_score") >= self.min_score)
        return found


def browse(postings: DataFrame, where: BrowseFilter, mentions: DataFrame | None = None,
           skills: DataFrame | None = None) -> DataFrame:
    """Postings that meet all conditions; with skills, those mentioning any of them."""
    for condition in where.conditions():
        postings = postings.filter(condition)
    if where.skills:
        wanted = skills.filter(F.lower("skill_name").isin(*[s.lower() for s in where.skills]))
        hits = mentions.join(wanted, "skill_id", "left_semi").select("posting_id")
        postings = postings.join(hits, "posting_id", "left_semi")
    return postings


def page(matching: DataFrame, sort: str, number: int, size: int) -> DataFrame:
    """One page in a total order, each row carrying the number of matches.

    Sort and limit plan as a top-k per task; no window over the whole table.  The
    total is a scalar subquery.
    """
    direction, column = SORTS[sort]
    total = matching.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = matching.orderBy(direction(column), F.asc("posting_id")).offset((number - 1) * size).limit(size)
    return rows.withColumn("total_matches", total)


def after(matching: DataFrame, sort: str, size: int, last: tuple | None = None) -> DataFrame:
    """The page after a row, in the order of ``page``; the first page without one.

    ``last`` is the sort value (may be None) and the posting id of the last row seen.  The seek is
    a filter, so a deep page costs what the first does: a top-k of what is left.
    """
    direction, column = SORTS[sort]
    if last is not None:
        value, key = last
        at, beyond = F.col(column), F.col("posting_id") > key
        if value is None:  # NULLs are at the end of every order
            matching = matching.filter(at.isNull() & beyond)
        else:
            further = at > F.lit(value) if direction is F.asc_nulls_last else at < F.lit(value)
            matching = matching.filter(further | at.isNull() | ((at == F.lit(value)) & beyond))
    return matching.orderBy(direction(column), F.asc("posting_id")).limit(size)


def new_matches(matches: DataFrame, app_state: DataFrame, threshold: float) -> DataFrame:
    """Good matches first seen after the last visit; everything counts before a first visit."""
    seen = app_state.filter(F.col("state_key") == "last_viewed_at").agg(
        F.max(F.col("state_value").try_cast("timestamp")).alias("at"))
    last = seen.select("at").scalar()
    fresh = F.coalesce(F.col("first_seen_at") > last, F.lit(True))
    return matches.filter(F.col("match_score") >= threshold).filter(fresh)


def compare(postings: DataFrame, attributes: list[str], values: list[str],
            name: str = "posting_id") -> DataFrame:
    """Two or three postings side by side: a row per attribute, a column per posting."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value"))
        for a in attributes]))
    long = (postings.filter(F.col(name).isin(*values))
            .select(F.col(name).alias("_name"), pairs.alias("p"))
            .select("_name", "p.attribute", "p.value"))
    return long.groupBy("attribute").pivot("_name", values).agg(F.first("value"))


def source_distribution(facts: DataFrame) -> DataFrame:
    return (facts.groupBy("source_id").agg(F.count(F.lit(1)).alias("postings"))
            .orderBy(F.desc("postings"), F.asc("source_id")))


def skill_ranking(mentions: DataFrame, skills: DataFrame) -> DataFrame:
    return (mentions.join(skills, "skill_id", "inner").groupBy("skill_name")
            .agg(F.count_distinct("posting_id").alias("postings"))
            .orderBy(F.desc("postings"), F.asc("skill_name")))


def newest(tracker: DataFrame) -> DataFrame:
    return tracker.orderBy(F.desc_nulls_last("date_posted"), F.asc("company_name"),
                           F.asc("job_title"), F.asc("posting_id"))


def skill_catalog(skills: DataFrame) -> DataFrame:
    return skills.select("skill_name").filter(F.col("skill_name") != "").orderBy("skill_name")


def company_catalog(companies: DataFrame) -> DataFrame:
    return (companies.filter("is_current").select("company_name").distinct()
            .filter(F.col("company_name") != "").orderBy("company_name"))
