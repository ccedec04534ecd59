"""The given tables read as postings, and the star built from them.

``posts`` gives every order the shape of a job posting that was pulled twice, with
some postings repeated on a second board.  From there the ordinary operators take
over: payloads are landed, normalised, deduplicated and loaded.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import moment
from postlake.operators.dedup import deduplicate
from postlake.operators.lifecycle import archive_reason, is_live, is_stale
from postlake.operators.normalize import normalize, split_unidentified
from postlake.operators.profiles import profile_row
from postlake.plans import star as S
from postlake.session import scratch_path, small_tasks, spread
from postlake.sources.landing import append_raw
from postlake.sources.snapshots import Snapshots

AS_OF = date(2001, 8, 2)
STALE_DAYS = 365
SOURCE_NAMES = tuple(V.SOURCES)

TITLES = (
    "Senior Data Engineer", "BI Developer", "Machine Learning Engineer", "Product Analyst",
    "Backend Software Engineer", "Office Manager", "Data Analyst Intern", "Principal Architect",
    "Sr. Platform Engineer", "ETL Pipeline Developer", "Data Scientist",
)
YEARS = (
    "3 - 5+ years experience", "at least 9 years of professional experience",
    "Freshers welcome, 0-1 years", "2 to 4 yrs", "minimum 1 year of experience", "great team",
)
STACKS = ("SQL, Python and dbt", "Power BI / R / A/B Testing", "CI/CD, Docker, Kubernetes", "no stack")
ROLE_OF_SEGMENT = {"BUILDING": "DE", "MACHINERY": "SWE", "HOUSEHOLD": "DA",
                   "FURNITURE": "BI", "AUTOMOBILE": "DS"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    key = F.col("o_orderkey")
    joined = (
        orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
        .join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            key.alias("id"),
            F.when(key % 53 != 0, F.col("c_name")).alias("company"),
            F.when(key % 41 == 0, F.lit(None))
            .when(key % 37 == 0, F.concat(F.lit("  "), "n_name", F.lit("   Remote ")))
            .otherwise(F.col("n_name")).alias("loc"),
            _pick(TITLES, key % 11).alias("title"),
            F.to_date("o_orderdate").alias("seen_base"),
            F.when(key % 3 != 0, F.col("o_totalprice")).alias("salary_min"),
            F.concat(F.lit("<p>"), _pick(YEARS, key % 6), F.lit("</p>  <b>"),
                     _pick(STACKS, key % 4), F.lit("</b>")).alias("descr"),
        )
    )
    boards = F.when(F.col("id") % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    pulls = (joined.select("*", F.explode(boards).alias("shift"))
             .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("pull")))
    src = ((F.col("id") + F.col("shift")) % 5).cast("int")
    return pulls.select(
        "id", src.alias("src"), "pull", _pick(SOURCE_NAMES, src).alias("source_id"),
        "company", "loc",
        F.concat("title", F.when((F.col("pull") == 1) & (F.col("id") % 29 == 0), " II")
                 .otherwise("")).alias("title"),
        F.when(F.col("id") % 31 != 0, F.col("seen_base")).alias("created"),
        F.when(src.isin(1, 2) & (F.col("id") % 7 == 0), F.date_add("seen_base", 30)).alias("closing"),
        "salary_min",
        F.when(F.col("id") % 2 == 0, F.col("salary_min") + 500.0).alias("salary_max"),
        "descr", "seen_base",
        F.date_add("seen_base", (F.col("id") % 20 + F.col("pull") * (1 + F.col("id") % 40)).cast("int"))
        .cast("timestamp").alias("seen_at"),
    )


def _millis(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * 86_400_000 + 30_600_000


def _payload(source: str) -> Column:
    """One posting in the source's own JSON shape."""
    even = F.col("id") % 2 == 0
    text_id = F.col("id").cast("string")
    url = F.concat(F.lit(f"https://{source}.example/"), text_id)
    stamp = F.concat(F.col("created").cast("string"), F.lit("T08:30:00Z"))
    deadline = F.concat(F.col("closing").cast("string"), F.lit("T23:59:00Z"))
    padded = F.concat(F.lit(" "), "company", F.lit(" "))
    currency = F.when(even, "EUR").otherwise("USD")
    shapes = {
        "adzuna": {
            "id": text_id, "title": F.col("title"), "description": F.col("descr"),
            "company": F.struct(F.col("company").alias("display_name")),
            "location": F.struct(F.col("loc").alias("display_name")),
            "created": stamp, "redirect_url": url,
            "salary_min": F.col("salary_min"), "salary_max": F.col("salary_max"),
            "salary_currency": F.when(even, currency), "currency": F.when(~even, currency),
            "contract_type": F.when(even, "permanent"), "contract_time": F.when(~even, "full_time"),
        },
        "greenhouse": {
            "id": F.col("id"), "title": F.col("title"), "content": F.col("descr"),
            "company_display_name": F.when(even, padded),
            "company_name": F.when(~even, F.col("company")),
            "location": F.struct(F.col("loc").alias("name")),
            "first_published": stamp, "application_deadline": deadline, "absolute_url": url,
        },
        "lever": {
            "id": text_id, "text": F.col("title"), "descriptionPlain": F.col("descr"),
            "company": F.col("company"),
            "categories": F.struct(F.col("loc").alias("location"), F.lit("Full-time").alias("commitment")),
            "createdAt": _millis(F.col("created")), "closedAt": _millis(F.col("closing")),
            "hostedUrl": url, "applyUrl": F.concat(url, F.lit("/apply")),
            "salaryRange": F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max"),
                                    currency.alias("currency")),
        },
        "rippling": {
            "uuid": F.when(even, text_id), "id": F.when(~even, text_id), "name": F.col("title"),
            "companyName": F.col("company"),
            "workLocations": F.when(even, F.array("loc")), "location": F.when(~even, F.col("loc")),
            "createdOn": F.when(F.col("id") % 3 == 0, stamp),
            "publishedAt": F.when(F.col("id") % 3 == 1, stamp),
            "createdAt": F.when(F.col("id") % 3 == 2, stamp),
            "url": url, "employmentType": F.lit("SALARIED_FT"),
            "payRangeDetails": F.struct(F.col("salary_min").alias("minSalary"),
                                        F.col("salary_max").alias("maxSalary"),
                                        currency.alias("currency")),
        },
        "ashby": {
            "id": text_id, "title": F.col("title"),
            "descriptionPlain": F.when(even, F.col("descr")), "descriptionHtml": F.when(~even, F.col("descr")),
            "company_display_name": F.col("company"),
            "location": F.when(F.col("id") % 4 != 0, F.col("loc")),
            "address": F.when(F.col("id") % 4 == 0, F.struct(F.struct(
                F.col("loc").alias("addressLocality"),
                F.lit("XX").alias("addressCountry")).alias("postalAddress"))),
            "publishedAt": stamp, "jobUrl": url,
            "applyUrl": F.when(even, F.concat(url, F.lit("/apply"))),
            "employmentType": F.when(F.col("id") % 4 != 0, "FullTime"),
        },
    }
    members = [column.alias(name) for name, column in shapes[source].items()]
    if source != "rippling":
        return F.to_json(F.struct(*members))
    # The description is an object for some postings and plain text for others.
    role = F.struct(F.col("descr").alias("role"), F.lit(None).cast("string").alias("company"))
    company = F.struct(F.lit(None).cast("string").alias("role"), F.col("descr").alias("company"))
    return (F.when(even, F.to_json(F.struct(*members, role.alias("description"))))
            .when(F.col("id") % 3 == 0, F.to_json(F.struct(*members, company.alias("description"))))
            .otherwise(F.to_json(F.struct(*members, F.col("descr").alias("description")))))


def raw_posts(adapted: DataFrame, *keep: str) -> DataFrame:
    """Landing rows of the adapted postings; columns in ``keep`` go along."""
    payload = F.lit(None).cast("string")
    for name in SOURCE_NAMES:
        payload = F.when(F.col("source_id") == name, _payload(name)).otherwise(payload)
    return adapted.select(payload.alias("payload"), F.concat(F.lit("pull-"), "pull").alias("run_id"),
                          F.col("seen_at").alias("ingested_at"), "source_id", *keep)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    key = F.col("o_orderkey")
    return orders.filter(key % 10 < 3).select(
        F.concat_ws("-", _pick(SOURCE_NAMES, key % 5), key.cast("string")).alias("posting_id"),
        F.date_add(F.to_date("o_orderdate"), 3).alias("date_applied"),
        _pick(V.APPLICATION_STATUSES, F.floor(key / 10) % 5).alias("status"),
        moment(AS_OF).alias("updated_at"))


def hidden_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders", "o_orderkey").filter(key % 97 == 0).select(
        F.concat_ws("-", _pick(SOURCE_NAMES, key % 5), key.cast("string")).alias("posting_id"),
        moment(AS_OF).alias("hidden_at"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a stored profile."""
    key = F.col("c_custkey")
    role = F.lit(None).cast("string")
    for segment, family in ROLE_OF_SEGMENT.items():
        role = F.when(F.col("c_mktsegment") == segment, family).otherwise(role)
    return table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal").select(
        F.concat(F.lit("p-"), key.cast("string")).alias("profile_id"),
        F.to_json(F.array(role)).alias("target_roles"),
        F.when(key % 4 != 0, F.to_json(F.array(F.lit("SQL"), F.lit("Python")))).alias("target_skills"),
        F.lit('["Remote"]').alias("preferred_locations"),
        F.when(key % 2 == 0, "ANY").otherwise("REMOTE_ONLY").alias("remote_preference"),
        F.when(key % 5 != 0, F.abs("c_acctbal") * 10).alias("min_salary"),
        F.lit("EUR").alias("currency"),
        _pick(("ENTRY", "MID", "SENIOR"), key % 3).alias("seniority_level"),
        moment(AS_OF).alias("updated_at"))


_BUILT: dict[tuple[str, str], "Bound"] = {}


class Bound:
    """Bronze, silver and gold tables built once per session from a data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "lake")
        self.store = Snapshots(spark, f"{self.root}/tables")
        self._star: S.Star | None = None
        self._staging: DataFrame | None = None
        self._raw: DataFrame | None = None

    def raw(self) -> DataFrame:
        if self._raw is None:
            append_raw(raw_posts(posts(self.spark, self.sf_dir)), f"{self.root}/raw", ("source_id",))
            self._raw = self.spark.read.parquet(f"{self.root}/raw")
        return self._raw

    def normalized(self) -> DataFrame:
        return split_unidentified(normalize(self.raw()))[0]

    def staging(self) -> DataFrame:
        if self._staging is None:
            self._staging = self.store.commit("staging_postings", deduplicate(self.normalized()))
        return self._staging

    def star(self) -> S.Star:
        if self._star is None:
            staging = self.staging()
            gold = self.store.commit_all(S.first_load(staging, AS_OF))
            facts = self.store.commit("fact_job_posting", S.staged_facts(
                staging, gold["dim_company"], gold["dim_location"]))
            archive = facts.filter(is_stale(AS_OF, STALE_DAYS)).select(
                "*", moment(AS_OF).alias("archived_at"),
                archive_reason(AS_OF, F.col("closing_date")).alias("archive_reason"))
            self._star = S.Star(
                facts=facts.filter(is_live(AS_OF, STALE_DAYS)), archive=archive,
                details=gold["job_posting_detail"], mentions=gold["fact_posting_skill_mention"],
                companies=gold["dim_company"], locations=gold["dim_location"],
                skills=gold["dim_skill"], dates=gold["dim_date"],
                applications=applications(self.spark, self.sf_dir),
                hidden=hidden_jobs(self.spark, self.sf_dir),
                profiles=profile_row(
                    self.spark, AS_OF, target_roles=["DE", "DA", "BI"],
                    target_skills=["SQL", "Python", "Docker"], preferred_locations=["Remote"]))
        return self._star


def bound(spark: SparkSession, sf_dir: str) -> Bound:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    small_tasks(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = Bound(spark, sf_dir)
    return _BUILT[key]
