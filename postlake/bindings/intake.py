"""Queries over sources, landing, normalising, text and deduplication."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.bindings import oracles as O
from postlake.bindings.registry import query, seconds
from postlake.bindings.tables import AS_OF, bound, posts, raw_posts, table
from postlake.functions import text
from postlake.functions.experience import with_experience
from postlake.operators import dedup, dims, quality, tagging
from postlake.operators.normalize import normalize
from postlake.plans import star as S
from postlake.session import scratch_path, spread
from postlake.sources import landing
from postlake.sources.config import flatten_directory
from postlake.sources.schemas import seed_skills

EVENT = "event_id bigint, user_id bigint, event_type string, value double, day string"


def event_records(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.to_date("ts").cast("string").alias("day"), F.col("event_type").alias("source_id"))


def read_events(raw):
    return raw.select(F.from_json("payload", EVENT).alias("r")).select("r.*")


EVENTS_SQL = ("SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day "
              "FROM events")


@query("land_roundtrip", EVENTS_SQL)
def land_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landed")
    landing.append_raw(landing.stamp(event_records(spark, sf_dir), "run-1", AS_OF), path)
    return read_events(spark.read.parquet(path))


@query("envelope_unwrap", "SELECT user_id, event_id, event_type FROM events")
def envelope_unwrap(spark, sf_dir):
    """Response bodies of up to a hundred records each, as a paged source returns them."""
    page = F.floor(F.col("event_id") / 100).alias("page")
    bodies = (
        table(spark, sf_dir, "events", "user_id", "event_id", "event_type")
        .groupBy("user_id", page)
        .agg(F.collect_list(F.struct("event_id", "event_type")).alias("results"))
        .select("user_id", F.to_json(F.struct("results")).alias("body")))
    records = landing.unwrap(bodies, "body", "results")
    return records.select(
        "user_id", F.from_json("payload", "event_id bigint, event_type string").alias("r")
    ).select("user_id", "r.*")


@query("list_detail_join", """
WITH details AS (SELECT * FROM lineitem WHERE l_returnflag <> 'A')
SELECT 'found' AS kind, o_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_extendedprice AS price
FROM orders JOIN details ON l_orderkey = o_orderkey
UNION ALL
SELECT 'missing', o_orderkey, NULL, NULL FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM details)""")
def list_detail_join(spark, sf_dir):
    """Orders list ids; line items are their details, those flagged A not being objects."""
    listed = table(spark, sf_dir, "orders", "o_orderkey")
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("price"))
    details = spread(table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
                           "l_returnflag")).select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_returnflag") == "A", F.to_json(F.array(item)))
        .otherwise(F.to_json(item)).alias("payload"))
    found, missing = landing.assemble_details(listed, details, ["o_orderkey"])
    rows = found.select(F.lit("found").alias("kind"), "o_orderkey",
                        F.from_json("payload", "line bigint, price double").alias("r")
                        ).select("kind", "o_orderkey", "r.*")
    gaps = missing.select(F.lit("missing").alias("kind"), "o_orderkey",
                          F.lit(None).cast("bigint").alias("line"),
                          F.lit(None).cast("double").alias("price"))
    return rows.unionByName(gaps)


@query("enrich_by_key", """
SELECT c_custkey, coalesce(n_name, 'Unknown') AS company_display_name, n_regionkey AS region
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON n_nationkey = c_nationkey""")
def enrich_by_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    known = (table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
             .withColumnRenamed("n_nationkey", "c_nationkey"))
    return landing.enrich(
        customers, known, "c_nationkey",
        {"company_display_name": "n_name", "region": "n_regionkey"},
        {"company_display_name": F.lit("Unknown")},
    ).select("c_custkey", "company_display_name", "region")


@query("enrich_payload", """
SELECT c_custkey, c_name AS company, coalesce(n_name, 'Unknown') AS company_display_name,
  CASE WHEN n_name IS NOT NULL THEN 'r' || CAST(n_regionkey AS VARCHAR) END AS company_industry,
  CASE WHEN n_name IS NOT NULL THEN n_name || ' City' END AS first_location
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON n_nationkey = c_nationkey""")
def enrich_payload(spark, sf_dir):
    """Company attributes merged over the members of each payload, by board token."""
    companies = table(spark, sf_dir, "nation").filter("n_regionkey <> 0").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("greenhouse_board_token"),
        F.col("n_name").alias("display_name"),
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("industry"),
        F.array(F.concat("n_name", F.lit(" City"))).alias("locations"),
        F.lit(None).cast("string").alias("hiring_pace"))
    own = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("company"),
                   F.lit("payload value").alias("company_display_name"))
    raw = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey").select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("board_token"),
        F.to_json(own).alias("payload"))
    schema = ("id bigint, company string, company_display_name string, company_industry string, "
              "company_locations array<string>")
    out = landing.enrich_companies(raw, companies, "greenhouse")
    return out.select(F.from_json("payload", schema).alias("r")).select(
        F.col("r.id").alias("c_custkey"), "r.company", "r.company_display_name", "r.company_industry",
        F.get("r.company_locations", F.lit(0)).alias("first_location"))


@query("landing_balance", """
WITH e AS (SELECT user_id, event_id, event_id // 100 AS page, event_id % 10 AS kind FROM events),
p AS (SELECT user_id, page, (user_id + page) % 7 = 3 AS cut, count(*) AS n FROM e GROUP BY 1, 2)
SELECT 'body PARSE_ERROR' AS what, count(*) AS n FROM p WHERE cut
UNION ALL SELECT CASE kind WHEN 0 THEN 'record PARSE_ERROR' WHEN 1 THEN 'kept as it came' ELSE 'enriched' END, count(*)
FROM e JOIN p USING (user_id, page) WHERE NOT cut GROUP BY 1""")
def landing_balance(spark, sf_dir):
    """Nothing vanishes: bodies in = cut off + whole, records in = malformed + enriched + kept as they came.

    Some bodies are cut off; in the others, each tenth record is cut off and each tenth
    repeats a member, which enrichment leaves alone.
    """
    page = F.floor(F.col("event_id") / 100).alias("page")
    kind, name = F.col("event_id") % 10, F.concat(F.lit('{"id":'), F.col("event_id").cast("string"))
    record = F.when(kind == 0, F.concat(name, F.lit(',"a":'))).when(
        kind == 1, F.concat(name, F.lit(',"a":1,"a":2}'))).otherwise(F.concat(name, F.lit(',"a":1}')))
    bodies = (table(spark, sf_dir, "events", "user_id", "event_id").groupBy("user_id", page)
              .agg(F.to_json(F.struct(F.collect_list(record).alias("results"))).alias("whole")))
    cut = (F.col("user_id") + F.col("page")) % 7 == 3
    bodies = bodies.withColumn("body", F.when(cut, F.expr("left(whole, length(whole) - 3)")).otherwise(F.col("whole")))
    split = landing.split_bodies(bodies.select("user_id", "page", "body"), "body", "results")
    records = landing.split_malformed(landing.unwrap(split.good, "body", "results"))
    payload = landing.overlay_members(F.col("payload"), F.lit('{"extra":"x"}'))
    what = F.when(F.get_json_object("payload", "$.extra") == "x", "enriched").when(
        F.col("payload").isNotNull(), "kept as it came")
    told = [split.quarantine.select(F.concat(F.lit("body "), F.col("reason")).alias("what")),
            records.quarantine.select(F.concat(F.lit("record "), F.col("reason")).alias("what")),
            records.good.withColumn("payload", payload).select(what.alias("what"))]
    return told[0].unionByName(told[1]).unionByName(told[2]).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


@query("quarantine_split", """
WITH tried AS (
  SELECT event_type, event_id % 50 = 7 AS cut,
    ['de', 'fr', 'xx', 'us', 'zz'][CAST(user_id % 5 AS INTEGER) + 1] AS country FROM events)
SELECT CASE WHEN cut THEN 'PARSE_ERROR' WHEN country IN ('xx', 'zz') THEN 'UNSUPPORTED_COUNTRY'
  WHEN event_type = 'error' THEN 'UNKNOWN_SOURCE' ELSE 'good' END AS reason,
  event_type, count(*) AS n FROM tried GROUP BY 1, 2""")
def quarantine_split(spark, sf_dir):
    """Events with some payloads cut short, some unsupported countries, one unknown source."""
    country = F.get(F.array(*map(F.lit, ("de", "fr", "xx", "us", "zz"))), (F.col("user_id") % 5).cast("int"))
    cut = F.col("props").substr(F.lit(1), F.length("props") - 1)
    tried = spread(table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props")).select(
        "event_type", country.alias("country"),
        F.when(F.col("event_id") % 50 == 7, cut).otherwise(F.col("props")).alias("payload"))
    parsed = landing.split_malformed(tried)
    placed = landing.split_unsupported_countries(parsed.good)
    known = landing.split_unknown_sources(placed.good, "event_type",
                                          ("signup", "click", "view", "purchase"))
    rows = known.good.withColumn("reason", F.lit("good"))
    for quarantined in (parsed.quarantine, placed.quarantine, known.quarantine):
        rows = rows.unionByName(quarantined)
    return rows.groupBy("reason", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("directory_flatten", """
SELECT p_partkey, p_brand AS category, p_name AS company, unnest(string_split(p_name, ' ')) AS program
FROM part""")
def directory_flatten(spark, sf_dir):
    """Each part as a one-category directory whose entry lists the words of its name."""
    entry = F.struct(F.col("p_name").alias("company"), F.split("p_name", " ").alias("programs"))
    nested = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name").select(
        "p_partkey", F.create_map("p_brand", F.array(entry)).alias("directory"))
    return flatten_directory(nested, nested="programs", nested_out="program")


@query("change_capture", O.select(O.NORM, """
SELECT posting_id, job_title FROM norm WHERE job_title LIKE '% II'"""))
def change_capture(spark, sf_dir):
    """Of the second pull, the postings whose payload the first pull did not have."""
    raw = bound(spark, sf_dir).raw()
    first, second = raw.filter("run_id = 'pull-0'"), raw.filter("run_id = 'pull-1'")
    changed = landing.changed_only(second, landing.content_hashes(first, ["source_id"]), ["source_id"])
    return normalize(changed).select("posting_id", "job_title")


NORMALIZED = [c for c in O.CONTENT.split(", ")]


@query("normalize_union", O.select(O.NORM, f"""
SELECT {O.CONTENT}, {O.stamp("seen_at")} AS seen_at FROM norm"""))
def normalize_union(spark, sf_dir):
    return bound(spark, sf_dir).normalized().select(*NORMALIZED, seconds("seen_at"))


@query("role_classifier", O.select(O.POSTS, f"""
SELECT id, src, pull, title, {O.role_family("title")} AS role_family FROM posts"""))
def role_classifier(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "id", "src", "pull", "title", text.classify(F.col("title")).alias("role_family"))


@query("html_strip", r"""
WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t
  FROM pages)
SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5 FROM t""")
def html_strip(spark, sf_dir):
    plain = text.strip_markup(F.col("html"))
    return (spread(table(spark, sf_dir, "pages", "page_id", "html")).withColumn("t", plain)
            .select("page_id", F.length("t").alias("n_chars"),
                    F.md5(F.col("t").cast("binary")).alias("text_md5")))


@query("experience_extract", O.select(
    O.POSTS + "," + O.experience("posts", "title", "descr"), """
SELECT id, src, pull, min_years_exp, max_years_exp, is_fresher, experience_level FROM experienced"""))
def experience_extract(spark, sf_dir):
    return with_experience(posts(spark, sf_dir), "title", "descr").select(
        "id", "src", "pull", "min_years_exp", "max_years_exp", "is_fresher", "experience_level")


_VERSION = "posting_id, job_title, dedup_key, strftime(first_seen_at, '%Y-%m-%d %H:%M:%S') AS " \
           "first_seen_at, strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') AS last_seen_at"


def _versions(df):
    return df.select("posting_id", "job_title", "dedup_key", seconds("first_seen_at"), seconds("last_seen_at"))


@query("dedup_repull", O.select(O.GROUPED, f"SELECT {_VERSION} FROM grouped"))
def dedup_repull(spark, sf_dir):
    return _versions(dedup.collapse_repulls(bound(spark, sf_dir).normalized()))


@query("dedup_latest", O.select(O.LATEST, f"SELECT {_VERSION} FROM latest"))
def dedup_latest(spark, sf_dir):
    return _versions(dedup.latest_content(bound(spark, sf_dir).normalized()))


_STAGED = [c for c in NORMALIZED if c != "dedup_key"]


@query("dedup_cross", O.select(O.STAGING, f"""
SELECT {", ".join(_STAGED)}, {O.stamp("first_seen_at")} AS first_seen_at,
  {O.stamp("last_seen_at")} AS last_seen_at FROM staging"""))
def dedup_cross(spark, sf_dir):
    return dedup.deduplicate(bound(spark, sf_dir).normalized()).select(
        *_STAGED, seconds("first_seen_at"), seconds("last_seen_at"))


@query("dedup_documents", """
SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY md5(lower(text)) ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")
def dedup_documents(spark, sf_dir):
    """First of each group of documents equal but for case; only a digest is shuffled."""
    digest = F.md5(F.lower("text").cast("binary")).alias("digest")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", digest)
    return dedup.keep_first(docs, ["digest"], [F.asc("doc_id")]).drop("digest")


@query("dq_report", """
WITH o AS (SELECT count(*) AS n, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) > DATE '1999-06-30') AS later,
    count(*) FILTER (WHERE o_orderkey IS NULL OR o_orderstatus IS NULL) AS nulls FROM orders),
od AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)),
d AS (SELECT count(*) AS n, count(*) FILTER (WHERE lang IS NULL OR source IS NULL) AS nulls FROM documents),
dd AS (SELECT count(*) AS n FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)),
r AS (
  SELECT 'orders' AS table_name, 'duplicate_posting_ids' AS rule_name, od.n AS rows_affected FROM od
  UNION ALL SELECT 'orders', 'null_required_fields', nulls FROM o
  UNION ALL SELECT 'orders', 'future_date_posted', later FROM o
  UNION ALL SELECT 'orders', 'zero_postings', n FROM o
  UNION ALL SELECT 'documents', 'duplicate_posting_ids', dd.n FROM dd
  UNION ALL SELECT 'documents', 'null_required_fields', nulls FROM d
  UNION ALL SELECT 'documents', 'future_date_posted', 0 FROM d
  UNION ALL SELECT 'documents', 'zero_postings', n FROM d)
SELECT table_name, rule_name, CASE WHEN rule_name = 'zero_postings'
    THEN CASE WHEN rows_affected = 0 THEN 'WARN' ELSE 'PASS' END
    ELSE CASE WHEN rows_affected = 0 THEN 'PASS' ELSE 'FAIL' END END AS status,
  CAST(rows_affected AS BIGINT) AS rows_affected FROM r""")
def dq_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source").withColumn(
        "day", F.lit(None).cast("date"))
    cut = date(1999, 6, 30)
    return (
        quality.report(orders, "o_custkey", ("o_orderkey", "o_orderstatus"), "day", as_of=cut)
        .withColumn("table_name", F.lit("orders"))
        .unionByName(quality.report(docs, "doc_id", ("lang", "source"), "day", as_of=cut)
                     .withColumn("table_name", F.lit("documents"))))


@query("dim_calendar", """
WITH e AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM e)
SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_id, date, dayname(date) AS day_of_week,
  CAST(month(date) AS BIGINT) AS month, CAST(year(date) AS BIGINT) AS year FROM d""")
def dim_calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("day"))
    return dims.calendar(orders, "day", AS_OF)


@query("dim_location", O.select(O.FACTS, "SELECT * FROM locations"))
def dim_location(spark, sf_dir):
    return dims.locations(bound(spark, sf_dir).staging())


@query("dim_company", O.select(O.FACTS, """
SELECT company_id, company_name, company_name AS display_name, '2001-08-02 00:00:00' AS valid_from,
  true AS is_current FROM companies"""))
def dim_company(spark, sf_dir):
    empty = bound(spark, sf_dir).star().companies.limit(0)
    return S.insert_companies(empty, bound(spark, sf_dir).staging(), AS_OF).select(
        "company_id", "company_name", "display_name", seconds("valid_from"), "is_current")


@query("dim_skill", O.select(O.STAGING + O.MENTIONS_ONLY, """
SELECT s.skill_id, s.skill_name, count(m.posting_id) AS postings
FROM skills s LEFT JOIN mentions m USING (skill_id) GROUP BY 1, 2"""))
def dim_skill(spark, sf_dir):
    """The skill dimension with the number of postings that mention each member."""
    counts = S.mentions(bound(spark, sf_dir).staging()).groupBy("skill_id").agg(
        F.count("posting_id").alias("postings"))
    return seed_skills(spark).join(counts, "skill_id", "left").select(
        "skill_id", "skill_name", F.coalesce("postings", F.lit(0).cast("bigint")).alias("postings"))


_MENTIONS_SQL = O.select(O.STAGING + O.MENTIONS_ONLY, "SELECT posting_id, skill_id FROM mentions")


@query("skill_mentions", _MENTIONS_SQL)
def skill_mentions(spark, sf_dir):
    return tagging.skill_mentions(bound(spark, sf_dir).staging(), V.SKILLS)


@query("skill_mentions_join", _MENTIONS_SQL)
def skill_mentions_join(spark, sf_dir):
    """The same pairs by joining text spans to the dictionary as a table."""
    whole = F.concat("job_title", F.lit(" "), F.coalesce("description", F.lit("")))
    pairs = tagging.tag_by_join(bound(spark, sf_dir).staging(), "posting_id", whole,
                                seed_skills(spark), "skill_name")
    return pairs.select("posting_id", F.md5(F.col("term").cast("binary")).alias("skill_id"))


@query("raw_land", O.select(O.POSTS, "SELECT source_id, count(*) AS n FROM posts GROUP BY 1"))
def raw_land(spark, sf_dir):
    """Postings landed in their own JSON shapes, and counted in the folder of each source."""
    path = scratch_path(spark, "raw_land")
    landing.append_raw(landing.split_malformed(raw_posts(posts(spark, sf_dir))).good, path, ("source_id",))
    return spark.read.parquet(path).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
