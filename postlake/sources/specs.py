"""How each source's JSON payload maps to the common posting shape.

A spec lists, for every output field, the JSON paths to try in order.  The read
schema is derived from the paths: every leaf is a string, so one ``from_json``
per row reads all fields and a surprising type costs one field, not the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.time import epoch_millis_day, iso_day

Paths = tuple[str, ...]


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    key: Paths
    company: Paths
    location: Paths
    posted: Paths
    title: Paths
    description: Paths
    posting_url: Paths
    apply_url: Paths
    closing: Paths = ()
    salary_min: Paths = ()
    salary_max: Paths = ()
    currency: Paths = ()
    employment_type: Paths = ()
    # Paths whose values are joined with a comma when no location path has one.
    location_parts: Paths = ()
    # Says "true" for a posting without a place of work.
    remote_flag: Paths = ()
    # Of an object-valued description, the members to try before its whole text.
    description_members: Paths = ()
    # Paths that must have a value for a complete location; by default ``location``.
    location_required: Paths = ()
    dates_are_millis: bool = False

    def paths(self) -> list[str]:
        groups = (self.key, self.company, self.location, self.posted, self.title,
                  self.description, self.posting_url, self.apply_url, self.closing,
                  self.salary_min, self.salary_max, self.currency, self.employment_type,
                  self.location_parts, self.remote_flag)
        return sorted({path for group in groups for path in group})

    def schema(self) -> T.StructType:
        tree: dict = {}
        for path in self.paths():
            node = tree
            *parents, leaf = path.split(".")
            for name in parents:
                node = node.setdefault(name, {})
            node[leaf] = None
        return _struct(tree)

    def to_day(self, text: Column) -> Column:
        return epoch_millis_day(text) if self.dates_are_millis else iso_day(text)


def _struct(tree: dict) -> T.StructType:
    fields = []
    for name, below in tree.items():
        if name.endswith("[0]"):
            fields.append(T.StructField(name[:-3], T.ArrayType(T.StringType())))
        else:
            fields.append(T.StructField(name, T.StringType() if below is None else _struct(below)))
    return T.StructType(fields)


def value_at(record: Column, path: str) -> Column:
    """The value of a dotted path in a parsed record; ``name[0]`` is the first element."""
    node = record
    for name in path.split("."):
        node = F.get(node[name[:-3]], F.lit(0)) if name.endswith("[0]") else node[name]
    return node


def first_value(record: Column, paths: Paths) -> Column:
    if not paths:
        return F.lit(None).cast("string")
    return F.coalesce(*[value_at(record, p) for p in paths])


# The field paths of each source's public job-board payload.
SPECS = {
    spec.source_id: spec
    for spec in (
        SourceSpec(
            "adzuna",
            key=("id",),
            company=("company.display_name",),
            location=("location.display_name",),
            posted=("created",),
            title=("title",),
            description=("description",),
            posting_url=("redirect_url",),
            apply_url=("redirect_url",),
            salary_min=("salary_min",),
            salary_max=("salary_max",),
            currency=("salary_currency", "currency"),
            employment_type=("contract_type", "contract_time"),
        ),
        SourceSpec(
            "greenhouse",
            key=("id",),
            company=("company_display_name", "company_name"),
            location=("location.name",),
            posted=("first_published",),
            closing=("application_deadline",),
            title=("title",),
            description=("content",),
            posting_url=("absolute_url",),
            apply_url=("absolute_url",),
        ),
        SourceSpec(
            "lever",
            key=("id",),
            company=("company_display_name", "company"),
            location=("categories.location",),
            posted=("createdAt",),
            closing=("closedAt",),
            dates_are_millis=True,
            title=("text",),
            description=("descriptionPlain",),
            posting_url=("hostedUrl",),
            apply_url=("applyUrl",),
            salary_min=("salaryRange.min",),
            salary_max=("salaryRange.max",),
            currency=("salaryRange.currency",),
            employment_type=("categories.commitment",),
        ),
        SourceSpec(
            "rippling",
            key=("uuid", "id"),
            company=("company_display_name", "companyName"),
            location=("workLocations[0]", "location"),
            posted=("createdOn", "publishedAt", "createdAt"),
            title=("name",),
            description=("description",),
            description_members=("role", "company"),
            posting_url=("url",),
            apply_url=("url",),
            salary_min=("payRangeDetails.minSalary",),
            salary_max=("payRangeDetails.maxSalary",),
            currency=("payRangeDetails.currency",),
            employment_type=("employmentType",),
        ),
        SourceSpec(
            "ashby",
            key=("id",),
            company=("company_display_name",),
            location=("location",),
            location_parts=("address.postalAddress.addressLocality",
                            "address.postalAddress.addressCountry"),
            location_required=("location", "address.postalAddress.addressLocality"),
            remote_flag=("isRemote",),
            posted=("publishedAt",),
            title=("title",),
            description=("descriptionPlain", "descriptionHtml"),
            posting_url=("jobUrl",),
            apply_url=("applyUrl", "jobUrl"),
            employment_type=("employmentType",),
        ),
    )
}
