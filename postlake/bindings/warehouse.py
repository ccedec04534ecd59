"""Queries over merges, history, marts and their twins on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.bindings import oracles as O
from postlake.bindings.registry import ORACLES, query, seconds
from postlake.bindings.tables import AS_OF, bound, profiles, table
from postlake.functions.time import moment
from postlake.operators import merge, scd2
from postlake.operators.profiles import parse, profile_row
from postlake.plans import marts, matching
from postlake.plans import star as S
from postlake.session import scratch_path, spread
from postlake.sources.schemas import columns
from postlake.sources.snapshots import Snapshots, month_partition


# --- merges -------------------------------------------------------------------
@query("insert_only_merge", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name || ' (new)' FROM customer WHERE c_custkey % 2 <> 0""")
def insert_only_merge(spark, sf_dir):
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    incoming = customers.withColumn("c_name", F.concat("c_name", F.lit(" (new)")))
    return merge.insert_missing(customers.filter("c_custkey % 2 = 0"), incoming, ["c_custkey"])


def _fact_sides(spark, sf_dir):
    """Orders as an existing fact table and as staged rows, two versions each."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderstatus", "o_orderpriority")
    common = {
        "posting_id": F.concat(F.lit("o-"), key.cast("string")),
        "location_id": F.lit(None).cast("string"),
        "source_id": F.col("o_orderpriority"),
        "job_title": F.col("o_orderstatus"),
        "date_posted": F.when(key % 13 != 0, day),
        "closing_date": F.lit(None).cast("date"),
    }
    target = orders.filter(key % 3 != 0).withColumns({
        **common, "company_id": F.concat(F.lit("c-"), F.col("o_custkey").cast("string")),
        "role_family": F.lit("OLD"), "first_seen_at": day.cast("timestamp"),
        "last_seen_at": day.cast("timestamp"), "is_incomplete": key % 7 == 0,
    }).select(*columns("fact_job_posting"))
    staged = orders.filter(key % 2 == 0).withColumn("v", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        **common, "company_id": F.lit("new"),
        "role_family": F.concat("o_orderstatus", F.col("v").cast("string")),
        "first_seen_at": F.date_add(day, (key % 3 - 1 + F.col("v")).cast("int")).cast("timestamp"),
        "last_seen_at": F.date_add(day, F.col("v")).cast("timestamp"),
        "is_incomplete": key % 5 == 0,
    }).select(*columns("fact_job_posting"))
    unique = merge.keep_first(staged, ["posting_id", "date_posted"],
                              [F.desc("last_seen_at"), F.desc("first_seen_at")])
    return target, unique


_FACT_SQL = """
WITH t AS (
  SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS posting_id, 'c-' || CAST(o_custkey AS VARCHAR) AS company_id,
    'OLD' AS role_family, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_posted,
    CAST(o_orderdate AS DATE) AS first_seen, CAST(o_orderdate AS DATE) AS last_seen,
    o_orderkey % 7 = 0 AS is_incomplete FROM orders WHERE o_orderkey % 3 <> 0
), s AS (
  SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS posting_id, 'new' AS company_id,
    o_orderstatus || '1' AS role_family,
    CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_posted,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS first_seen,
    CAST(o_orderdate AS DATE) + 1 AS last_seen,
    o_orderkey % 5 = 0 AS is_incomplete FROM orders WHERE o_orderkey % 2 = 0
)
SELECT coalesce(t.posting_id, s.posting_id) AS posting_id, coalesce(t.company_id, s.company_id) AS company_id,
  coalesce(s.role_family, t.role_family) AS role_family, coalesce(t.date_posted, s.date_posted) AS date_posted,
  CAST(CASE WHEN t.posting_id IS NULL THEN s.first_seen WHEN s.posting_id IS NULL THEN t.first_seen
    ELSE least(t.first_seen, s.first_seen) END AS DATE) AS first_seen,
  CAST(coalesce(s.last_seen, t.last_seen) AS DATE) AS last_seen,
  CASE WHEN t.posting_id IS NULL THEN s.is_incomplete WHEN s.posting_id IS NULL THEN t.is_incomplete
    ELSE t.is_incomplete OR s.is_incomplete END AS is_incomplete
FROM t FULL JOIN s ON t.posting_id = s.posting_id"""


def _fact_view(df):
    return df.select("posting_id", "company_id", "role_family", "date_posted",
                     F.to_date("first_seen_at").alias("first_seen"),
                     F.to_date("last_seen_at").alias("last_seen"), "is_incomplete")


@query("fact_upsert", _FACT_SQL)
def fact_upsert(spark, sf_dir):
    return _fact_view(S.upsert_facts(*_fact_sides(spark, sf_dir)))


@query("fact_upsert_by_month", _FACT_SQL)
def fact_upsert_by_month(spark, sf_dir):
    """The same merge in place on a table partitioned by month, touching only staged months."""
    target, staged = _fact_sides(spark, sf_dir)
    path = scratch_path(spark, "facts")
    (target.withColumn("posted_month", month_partition("date_posted"))
     .hint("rebalance", "posted_month").write.partitionBy("posted_month").parquet(path))
    S.upsert_fact_months(spark, path, staged)
    return _fact_view(spark.read.parquet(path))


@query("detail_upsert", """
WITH t AS (SELECT p_partkey, p_name AS description, CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS salary_min,
    CAST(NULL AS DOUBLE) AS salary_max, p_brand AS currency, 'OLD' AS experience_level
  FROM part WHERE p_partkey % 3 <> 0),
s AS (SELECT l_partkey AS p_partkey, CASE WHEN l_partkey % 2 = 0 THEN 'from items' END AS description,
    CASE WHEN l_partkey % 5 <> 0 THEN min(l_extendedprice) END AS salary_min, max(l_extendedprice) AS salary_max,
    CASE WHEN count(*) > 25 THEN 'many' END AS currency, max(l_returnflag) AS experience_level
  FROM lineitem GROUP BY l_partkey)
SELECT coalesce(t.p_partkey, s.p_partkey) AS part, coalesce(s.description, t.description) AS description,
  coalesce(s.salary_min, t.salary_min) AS salary_min, coalesce(s.salary_max, t.salary_max) AS salary_max,
  coalesce(s.currency, t.currency) AS currency,
  CASE WHEN s.p_partkey IS NULL THEN t.experience_level ELSE s.experience_level END AS experience_level
FROM t FULL JOIN s ON t.p_partkey = s.p_partkey""")
def detail_upsert(spark, sf_dir):
    """Part details refreshed from line items: known values survive a NULL."""
    names = ["part", "description", "salary_min", "salary_max", "currency", "experience_level"]
    key = F.col("l_partkey")
    target = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(
        F.col("p_partkey").alias("part"), F.col("p_name").alias("description"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")).alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"), F.col("p_brand").alias("currency"),
        F.lit("OLD").alias("experience_level"))
    source = table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_returnflag").groupBy(key).agg(
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("salary_max"),
        F.count(F.lit(1)).alias("n"), F.max("l_returnflag").alias("experience_level"),
    ).select(
        key.alias("part"), F.when(key % 2 == 0, "from items").alias("description"),
        F.when(key % 5 != 0, F.col("low")).alias("salary_min"), "salary_max",
        F.when(F.col("n") > 25, "many").alias("currency"), "experience_level")
    rules = {n: merge.DETAIL_RULES[n] for n in names[1:]}
    return merge.merge_upsert(target, source, ["part"], rules, nullable=[])


# --- history ------------------------------------------------------------------
OLD_TIME, NEW_TIME = date(1995, 1, 1), date(2001, 8, 2)


def _dimension(spark, sf_dir):
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey")
    row = customers.filter(key % 4 != 0).select(
        key.cast("string").alias("company_id"), F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("display_name"), moment(OLD_TIME).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"), key.alias("k"))
    past = row.filter(F.col("k") % 8 == 1).withColumns({
        "display_name": F.lit("PAST"), "valid_from": moment(date(1990, 1, 1)),
        "valid_to": moment(OLD_TIME), "is_current": F.lit(False)})
    dim = row.unionByName(past).drop("k")
    name = (F.when(key % 15 == 0, F.lit(None)).when(key % 10 == 0, F.lit("CHANGED"))
            .otherwise(F.col("c_mktsegment")))
    snapshot = customers.filter(key % 9 != 0).select(
        key.cast("string").alias("company_id"), F.col("c_name").alias("company_name"),
        name.alias("display_name"))
    return dim, snapshot


_DIM_SQL = """
WITH dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS company_name, c_mktsegment AS display_name,
    '1995-01-01 00:00:00' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current
  FROM customer WHERE c_custkey % 4 <> 0
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, 'PAST', '1990-01-01 00:00:00', '1995-01-01 00:00:00', false
  FROM customer WHERE c_custkey % 8 = 1
), snap AS (
  SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS company_name,
    CASE WHEN c_custkey % 15 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS display_name
  FROM customer WHERE c_custkey % 9 <> 0
), cur AS (SELECT * FROM dim WHERE is_current),
changed AS (
  SELECT c.company_id FROM cur c JOIN snap s USING (company_id)
  WHERE s.display_name IS DISTINCT FROM c.display_name
)"""


@query("scd2_close_open", _DIM_SQL + """
SELECT company_id, company_name, display_name, valid_from,
  CASE WHEN is_current AND company_id IN (SELECT company_id FROM changed) THEN '2001-08-02 00:00:00'
    ELSE valid_to END AS valid_to,
  is_current AND company_id NOT IN (SELECT company_id FROM changed) AS is_current
FROM dim
UNION ALL
SELECT company_id, company_name, display_name, '2001-08-02 00:00:00', NULL, true FROM snap
WHERE company_id IN (SELECT company_id FROM changed) OR company_id NOT IN (SELECT company_id FROM cur)""")
def scd2_close_open(spark, sf_dir):
    dim, snapshot = _dimension(spark, sf_dir)
    out = scd2.scd2_apply(dim, snapshot, "company_id", ["display_name"], moment(NEW_TIME))
    return out.select("company_id", "company_name", "display_name", seconds("valid_from"),
                      seconds("valid_to"), "is_current")


@query("scd2_changed_unopened", _DIM_SQL + """
SELECT 'close' AS action, company_id FROM changed
UNION ALL SELECT 'open', company_id FROM snap WHERE company_id NOT IN (SELECT company_id FROM cur)""")
def scd2_changed_unopened(spark, sf_dir):
    """The two halves on their own: versions to close, keys without a current version."""
    dim, snapshot = _dimension(spark, sf_dir)
    current = dim.filter("is_current")
    return (scd2.changed_keys(current, snapshot, "company_id", ["display_name"])
            .select(F.lit("close").alias("action"), "company_id")
            .unionByName(scd2.unopened_keys(current, snapshot, "company_id")
                         .select(F.lit("open").alias("action"), "company_id")))


# --- star tables --------------------------------------------------------------
_FACT_COLUMNS = [c for c in columns("fact_job_posting") if not c.endswith("_at")]


@query("star_facts", O.select(O.FACTS, f"""
SELECT {", ".join(_FACT_COLUMNS)}, {O.stamp("first_seen_at")} AS first_seen_at,
  {O.stamp("last_seen_at")} AS last_seen_at FROM facts"""))
def star_facts(spark, sf_dir):
    gold = bound(spark, sf_dir)
    staged = S.staged_facts(gold.staging(), gold.star().companies, gold.star().locations)
    return staged.select(*_FACT_COLUMNS, seconds("first_seen_at"), seconds("last_seen_at"))


_DETAIL_COLUMNS = [c for c in columns("job_posting_detail") if not c.endswith("_at")]


@query("star_details", O.select(O.DETAILS, f"""
SELECT {", ".join(_DETAIL_COLUMNS)}, {O.stamp("last_seen_at")} AS last_seen_at FROM details"""))
def star_details(spark, sf_dir):
    return S.staged_details(bound(spark, sf_dir).staging()).select(*_DETAIL_COLUMNS, seconds("last_seen_at"))


# --- marts --------------------------------------------------------------------
def _mart(name, times=()):
    def run(spark, sf_dir):
        df = marts.MARTS[name](bound(spark, sf_dir).star(), AS_OF)
        return df.select(*[seconds(c) if c in times else F.col(c) for c in df.columns])
    return run


def _times(*names):
    return ", ".join(f"{O.stamp(n)} AS {n}" for n in names)


query("mart_application_tracker", O.select(O.STAR, f"""
SELECT * EXCLUDE (last_seen_at), {_times("last_seen_at")} FROM tracker"""))(
    _mart("mart_application_tracker", ("last_seen_at",)))

query("mart_skill_demand_trend", O.select(O.STAR, "SELECT * FROM trend"))(_mart("mart_skill_demand_trend"))

query("mart_hiring_velocity", O.select(O.STAR, "SELECT * FROM velocity"))(_mart("mart_hiring_velocity"))

query("mart_company_activity", O.select(O.STAR, f"""
SELECT * EXCLUDE (earliest_first_seen, latest_last_seen), {_times("earliest_first_seen", "latest_last_seen")}
FROM activity"""))(_mart("mart_company_activity", ("earliest_first_seen", "latest_last_seen")))

_ROLE_MARKET = O.select(O.DETAILS, f"""
SELECT role_family, strftime(coalesce(date_posted, {O.DAY}), '%Y-%m') AS year_month,
  count(DISTINCT posting_id) AS total_postings,
  {O.rounded("avg(salary_min)", 2)} AS avg_salary_min, {O.rounded("avg(salary_max)", 2)} AS avg_salary_max
FROM both_ LEFT JOIN (SELECT posting_id, salary_min, salary_max FROM details) d USING (posting_id)
GROUP BY 1, 2""")
query("mart_role_market", _ROLE_MARKET)(_mart("mart_role_market"))


@query("mart_materialized", _ROLE_MARKET)
def mart_materialized(spark, sf_dir):
    """A mart written as a snapshot and read back."""
    store = Snapshots(spark, scratch_path(spark, "marts"))
    marts.materialize(bound(spark, sf_dir).star(), AS_OF, store, ("mart_role_market",))
    return store.read("mart_role_market")


query("mart_posting_seasonality", O.select(O.DETAILS, f"""
, p AS (
  SELECT f.posting_id, f.source_id, f.role_family, coalesce(f.date_posted, {O.DAY}) AS d,
    (NOT f.is_archived) AND (coalesce(x.is_fresher, false) OR coalesce(x.experience_level = 'FRESHER', false)) AS fresh
  FROM both_ f LEFT JOIN (SELECT posting_id, is_fresher, experience_level FROM details) x USING (posting_id)
)
SELECT role_family, {O.named("role_family", V.ROLE_LABELS, V.ROLE_LABEL_DEFAULT)} AS domain_name,
  {O.named("month(d)", V.SEASONS, V.SEASON_DEFAULT)} AS season,
  'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS INTEGER) AS posting_year,
  CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
  source_id, count(DISTINCT posting_id) AS posting_count,
  CAST(sum(CASE WHEN fresh THEN 1 ELSE 0 END) AS BIGINT) AS fresher_postings_count
FROM p GROUP BY ALL"""))(_mart("mart_posting_seasonality"))

query("mart_salary_summary", O.select(O.DETAILS, f"""
SELECT f.role_family, coalesce(l.location_normalized, 'Unknown') AS location, f.source_id,
  coalesce(d.currency, 'Unknown') AS currency, count(DISTINCT f.posting_id) AS postings_with_salary,
  {O.rounded("min(d.salary_min)", 2)} AS min_salary_lowest, {O.rounded("avg(d.salary_min)", 2)} AS avg_salary_min,
  {O.rounded("avg(d.salary_max)", 2)} AS avg_salary_max, {O.rounded("max(d.salary_max)", 2)} AS max_salary_highest
FROM both_ f JOIN details d ON d.posting_id = f.posting_id AND (d.salary_min IS NOT NULL OR d.salary_max IS NOT NULL)
LEFT JOIN locations l USING (location_id) GROUP BY 1, 2, 3, 4"""))(_mart("mart_salary_summary"))

query("mart_source_quality", O.select(O.FACTS, f"""
SELECT source_id, count(DISTINCT posting_id) AS total_postings, count(DISTINCT company_id) AS distinct_companies,
  CAST(sum(CASE WHEN is_incomplete THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_postings,
  {O.rounded("CAST(sum(CASE WHEN is_incomplete THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(DISTINCT posting_id)", 2)}
    AS incomplete_percentage,
  min(date_posted) AS earliest_posting_date, max(date_posted) AS latest_posting_date
FROM both_ GROUP BY 1"""))(_mart("mart_source_quality"))

query("mart_application_funnel", O.select(O.STAR, f"""
, c AS (SELECT status, strftime(date_applied, '%Y-%m') AS application_month,
    count(DISTINCT posting_id) AS applications_count FROM applications GROUP BY 1, 2)
SELECT *, {O.rounded("CAST(applications_count AS DOUBLE) * 100.0 / CAST(sum(applications_count) OVER (PARTITION BY application_month) AS DOUBLE)", 2)}
  AS percentage_of_month FROM c"""))(_mart("mart_application_funnel"))

query("mart_posting_longevity", O.select(O.FACTS, f"""
, d AS (SELECT f.*, CAST(date_diff('day', CAST(first_seen_at AS DATE), CAST(last_seen_at AS DATE)) AS INTEGER)
    AS active_days FROM both_ f JOIN companies c USING (company_id))
SELECT role_family, source_id, {O.bracket("active_days", V.LONGEVITY_EDGES, V.LONGEVITY_LABELS)} AS longevity_bracket, count(DISTINCT posting_id) AS postings_count,
  {O.rounded("avg(active_days)", 1)} AS avg_active_days, max(active_days) AS max_active_days
FROM d GROUP BY 1, 2, 3"""))(_mart("mart_posting_longevity"))

_MATCH_SELECT = f"""
SELECT * EXCLUDE (first_seen_at, last_seen_at), {_times("first_seen_at", "last_seen_at")} FROM matches"""
query("mart_job_match", O.select(O.DEFAULT_MATCH, _MATCH_SELECT))(
    _mart("mart_job_match", ("first_seen_at", "last_seen_at")))


@query("mart_publish", " UNION ALL ".join(
    f"SELECT '{name}' AS view_name, count(*) AS n FROM ({ORACLES[name]})" for name in sorted(marts.MARTS)))
def mart_publish(spark, sf_dir):
    """Every mart published as a view, and its rows counted through the view."""
    rows = None
    for name in marts.publish(bound(spark, sf_dir).star(), AS_OF):
        counted = spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("view_name"), "n")
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


def _match_for(spark, sf_dir, skills_only=False, **profile):
    star = bound(spark, sf_dir).star()
    star = star.replace(profiles=profile_row(spark, AS_OF, **profile))
    df = matching.job_match(star, AS_OF, profile_skills_only=skills_only)
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen_at", "last_seen_at")})


@query("job_match_senior", O.select(O.match_chain(("SWE", "OTHER"), "REMOTE_ONLY", 100000.0, "SENIOR"), _MATCH_SELECT))
def job_match_senior(spark, sf_dir):
    return _match_for(spark, sf_dir, target_roles=["SWE", "OTHER"], remote_preference="REMOTE_ONLY",
                      min_salary=100000.0, seniority_level="SENIOR")


@query("job_match_profile_skills", O.select(
    O.match_chain(("DE",), "ANY", 0.0, "MID", "CAST(coalesce(wanted_hits, 0) AS DOUBLE) / CAST(3 AS DOUBLE)"),
    _MATCH_SELECT))
def job_match_profile_skills(spark, sf_dir):
    """Skill factor as the share of the profile's own skills."""
    return _match_for(spark, sf_dir, skills_only=True, target_roles=["DE"],
                      target_skills=["SQL", "python", "Docker"], seniority_level="MID")


def _any_of(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"CASE WHEN list_has_any(string_split(matched_skills, ', '), [{listed}]) THEN 1 ELSE 0 END"


@query("job_match_aliases", O.select(
    O.match_chain(("DE",), "ANY", 0.0, "MID", f"CAST({_any_of('SQL', 'dbt', 'Power BI')} + {_any_of('Python')} + {_any_of('Docker', 'Kubernetes')} AS DOUBLE) / CAST(3 AS DOUBLE)"),
    _MATCH_SELECT))
def job_match_aliases(spark, sf_dir):
    """Skill factor by equivalent names: aliases hold both ways and through others."""
    pairs = [("dbt", "sql"), ("Power BI", "DBT"), ("docker", "Kubernetes"), ("SQL", "sql"), (None, "Python")]
    star = bound(spark, sf_dir).star().replace(profiles=profile_row(
        spark, AS_OF, target_roles=["DE"], target_skills=["SQL", "python", "Docker"], seniority_level="MID"))
    df = matching.job_match(star, AS_OF, aliases=spark.createDataFrame(pairs, "name string, alias string"))
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen_at", "last_seen_at")})


_ROLE_CASE = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'DE' WHEN 'MACHINERY' THEN 'SWE' "
              "WHEN 'HOUSEHOLD' THEN 'DA' WHEN 'FURNITURE' THEN 'BI' WHEN 'AUTOMOBILE' THEN 'DS' END")


@query("match_many_profiles", O.select(O.STAR, f"""
, people AS (
  SELECT 'p-' || CAST(c_custkey AS VARCHAR) AS profile_id, [{_ROLE_CASE}] AS roles,
    CASE WHEN c_custkey % 2 = 0 THEN 'ANY' ELSE 'REMOTE_ONLY' END AS remote,
    CASE WHEN c_custkey % 5 <> 0 THEN abs(c_acctbal) * 10 ELSE CAST(0 AS DOUBLE) END AS wanted,
    CASE c_custkey % 3 WHEN 0 THEN 'ENTRY' WHEN 1 THEN 'MID' ELSE 'SENIOR' END AS level FROM customer
),
scored AS (
  SELECT profile_id, posting_id, greatest(salary_min, salary_max) AS best,
    {O.factors("roles", "remote", "wanted", "level")} FROM inputs CROSS JOIN people
),
ranked AS (
  SELECT profile_id, posting_id, {O.SCORE} AS match_score, best FROM scored
)
SELECT profile_id, posting_id, match_score, match_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY profile_id
    ORDER BY match_score DESC, best DESC NULLS LAST, posting_id) AS INTEGER) AS match_rank FROM ranked)
WHERE match_rank <= 5"""))
def match_many_profiles(spark, sf_dir):
    """The five best postings of every profile."""
    return matching.match_profiles(bound(spark, sf_dir).star(), parse(profiles(spark, sf_dir)), AS_OF, 5)


# --- mart operators on other tables -------------------------------------------
@query("status_share_by_month", f"""
WITH c AS (SELECT o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS month,
  count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1, 2)
SELECT *, {O.rounded("CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER (PARTITION BY month) AS DOUBLE)", 2)} AS share FROM c""")
def status_share_by_month(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    return marts.status_share(orders, "o_orderstatus", "o_orderdate", "o_orderkey").withColumnRenamed(
        "o_orderstatus", "status")


@query("activity_by_entity", """
SELECT user_id, count(DISTINCT event_id) AS total_postings,
  count(DISTINCT CASE WHEN ts < TIMESTAMP '2024-01-27' THEN event_id END) AS likely_closed_postings,
  count(DISTINCT CASE WHEN ts >= TIMESTAMP '2024-01-27' THEN event_id END) AS active_postings,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS earliest_first_seen,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_last_seen
FROM events GROUP BY 1""")
def activity_by_entity(spark, sf_dir):
    events = table(spark, sf_dir, "events", "user_id", "event_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    return marts.activity(events, "user_id", "event_id", "ts", "ts", date(2024, 1, 30), 3).select(
        "user_id", "total_postings", "likely_closed_postings", "active_postings",
        seconds("earliest_first_seen"), seconds("latest_last_seen"))


@query("longevity_orders", f"""
WITH d AS (SELECT o_orderkey, o_orderpriority,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(last_ship AS DATE)) AS INTEGER) AS active_days
  FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) s
    ON l_orderkey = o_orderkey)
SELECT o_orderpriority, {O.bracket("active_days", V.LONGEVITY_EDGES, V.LONGEVITY_LABELS)} AS longevity_bracket, count(DISTINCT o_orderkey) AS postings_count,
  {O.rounded("avg(active_days)", 1)} AS avg_active_days, max(active_days) AS max_active_days
FROM d GROUP BY 1, 2""")
def longevity_orders(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate").groupBy(
        F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    return marts.longevity(orders.join(shipped, "o_orderkey"), ["o_orderpriority"], "o_orderkey",
                           "o_orderdate", "last_ship")


@query("price_summary", f"""
SELECT p_type, n_name, l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS postings_with_salary,
  {O.rounded("min(l_extendedprice)", 2)} AS min_salary_lowest, {O.rounded("avg(l_extendedprice)", 2)} AS avg_salary_min,
  {O.rounded("avg(p_retailprice)", 2)} AS avg_salary_max, {O.rounded("max(p_retailprice)", 2)} AS max_salary_highest
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3, 4""")
def price_summary(spark, sf_dir):
    items = spread(table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                         "l_extendedprice", "l_returnflag", "l_linestatus"))
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type", "p_retailprice")
    nations = (table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
               .join(table(spark, sf_dir, "nation", "n_nationkey", "n_name"),
                     F.col("n_nationkey") == F.col("s_nationkey")))
    joined = (items.join(parts, F.col("p_partkey") == F.col("l_partkey"))
              .join(nations, F.col("s_suppkey") == F.col("l_suppkey")))
    return marts.pay_stats(joined, ["p_type", "n_name", "l_returnflag", "l_linestatus"], "l_orderkey",
                           "l_extendedprice", "p_retailprice")


@query("quality_by_source", f"""
SELECT source, count(DISTINCT d.doc_id) AS total_postings, count(DISTINCT lang) AS distinct_companies,
  CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_postings,
  {O.rounded("CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(DISTINCT d.doc_id)", 2)}
    AS incomplete_percentage,
  min(n_chars) AS earliest_posting_date, max(n_chars) AS latest_posting_date
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""")
def quality_by_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    joined = docs.join(labels, "doc_id", "left").withColumn("unlabelled", F.col("quality").isNull())
    return marts.completeness(joined, "source", "doc_id", "lang", "unlabelled", "n_chars")


@query("seasonality_orders", """
SELECT o_orderpriority, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer'
    ELSE 'Fall / Autumn' END AS season, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
  CAST(year(o_orderdate) AS INTEGER) AS posting_year, CAST(month(o_orderdate) AS INTEGER) AS month_of_year,
  monthname(o_orderdate) AS month_name, strftime(o_orderdate, '%Y-%m') AS year_month,
  count(DISTINCT o_custkey) AS customers, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS large
FROM orders GROUP BY ALL""")
def seasonality_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    flagged = orders.withColumn("is_large", F.when(F.col("o_totalprice") > 200000, 1).otherwise(0))
    return marts.seasonality(flagged, ["o_orderpriority"], "o_custkey", "o_orderdate", "is_large",
                             "customers", "large")

