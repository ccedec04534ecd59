"""Queries over tracking, logs, retention, the archive, export, browsing and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlake.bindings import oracles as O
from postlake.bindings.intake import EVENT, EVENTS_SQL, event_records, read_events
from postlake.bindings.registry import query, seconds
from postlake.bindings.tables import AS_OF, STALE_DAYS, bound, profiles, table
from postlake.functions.time import moment
from postlake.operators import browse, lifecycle, merge, runlog, tracking, vectors
from postlake.operators.dedup import keep_first
from postlake.operators.profiles import parse
from postlake.plans import marts
from postlake.session import scratch_path, stored
from postlake.sources import archive, landing
from postlake.sources.export import tracker_rows
from postlake.sources.snapshots import Snapshots
from postlake.streaming import late, streams


# --- user state ---------------------------------------------------------------
@query("apply_changes", """
WITH last_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1)
SELECT coalesce(c.c_custkey, l.user_id) AS user_id,
  CASE WHEN l.user_id IS NULL THEN c.c_mktsegment ELSE upper(l.event_type) END AS status,
  CASE WHEN l.user_id IS NULL THEN c.c_acctbal ELSE l.value END AS value
FROM customer c FULL JOIN last_ l ON l.user_id = c.c_custkey
WHERE l.event_type IS NULL OR l.event_type <> 'error'""")
def apply_changes(spark, sf_dir):
    """Customers changed by the event log: an error deletes, anything else overwrites."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("status"),
        F.col("c_acctbal").alias("value"))
    changes = table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value").select(
        "user_id", F.upper("event_type").alias("status"), "value", "event_id",
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("op"))
    return merge.apply_changes(target, changes, ["user_id"], [F.desc("event_id")])


@query("delete_keys", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def delete_keys(spark, sf_dir):
    gone = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").filter("o_orderstatus = 'P'")
    return merge.delete_keys(table(spark, sf_dir, "customer", "c_custkey", "c_name"),
                             gone.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


_STATUS_CASE = ("CASE event_type WHEN 'signup' THEN 'SAVED' WHEN 'click' THEN 'APPLIED' WHEN 'view' THEN 'INTERVIEW' "
                "WHEN 'purchase' THEN 'OFFER' ELSE 'LOST' END")
_APPLIED = f"""
applied AS (
  SELECT event_id, 'p-' || CAST(user_id AS VARCHAR) AS posting_id, CAST(ts AS DATE) AS date_applied,
    {_STATUS_CASE} AS status FROM events
),
checked AS (
  SELECT *, CASE WHEN date_applied > DATE '2024-01-20' THEN 'FUTURE_DATE' WHEN status = 'LOST' THEN 'INVALID_STATUS'
    WHEN posting_id NOT IN (SELECT 'p-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey <> 3)
    THEN 'POSTING_NOT_FOUND' END AS reject_reason FROM applied
)"""


def _validated(spark, sf_dir):
    status = F.lit("LOST")
    for event, name in (("signup", "SAVED"), ("click", "APPLIED"), ("view", "INTERVIEW"), ("purchase", "OFFER")):
        status = F.when(F.col("event_type") == event, name).otherwise(status)
    changes = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").select(
        "event_id", F.concat(F.lit("p-"), F.col("user_id").cast("string")).alias("posting_id"),
        F.to_date("ts").alias("date_applied"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("updated_at"), F.lit("UPSERT").alias("op"))
    postings = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").filter("c_nationkey <> 3").select(
        F.concat(F.lit("p-"), F.col("c_custkey").cast("string")).alias("posting_id"))
    return tracking.validate_applications(changes, postings, date(2024, 1, 20))


@query("applications_validate", O.select(_APPLIED, """
SELECT event_id, posting_id, status, reject_reason FROM checked"""))
def applications_validate(spark, sf_dir):
    return _validated(spark, sf_dir).select("event_id", "posting_id", "status", "reject_reason")


@query("applications_apply", O.select(_APPLIED, """
SELECT posting_id, date_applied, status FROM (
  SELECT *, row_number() OVER (PARTITION BY posting_id ORDER BY event_id DESC) AS rn
  FROM checked WHERE reject_reason IS NULL) WHERE rn = 1"""))
def applications_apply(spark, sf_dir):
    """Valid changes applied to an empty applications table."""
    valid, _ = tracking.split_valid(_validated(spark, sf_dir))
    none = valid.select("posting_id", "date_applied", "status", "updated_at").limit(0)
    return tracking.apply_applications(none, valid).select("posting_id", "date_applied", "status")


@query("notes_apply", """
WITH notes AS (SELECT conv_id, text FROM conversations WHERE turn = 0),
last_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations WHERE turn > 0) WHERE rn = 1)
SELECT CAST(n.conv_id AS VARCHAR) AS note_id, trim(coalesce(l.text, n.text)) AS note
FROM notes n LEFT JOIN last_ l ON l.conv_id = n.conv_id
WHERE l.turn IS NULL OR l.turn % 3 <> 2""")
def notes_apply(spark, sf_dir):
    """First turns are notes; later turns edit them, every third one deletes."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.col("conv_id").cast("string").alias("note_id"), F.col("conv_id").cast("string").alias("posting_id"),
        F.col("text").alias("note"), "turn",
        F.timestamp_seconds(F.col("turn")).alias("created_at"), F.timestamp_seconds(F.col("turn")).alias("updated_at"))
    notes = turns.filter("turn = 0").drop("turn").withColumn("note", F.trim("note"))
    changes = turns.filter("turn > 0").withColumn(
        "op", F.when(F.col("turn") % 3 == 2, "DELETE").otherwise("UPDATE")).drop("turn")
    valid, _ = tracking.note_changes(changes)
    return tracking.apply_notes(notes, valid).select("note_id", "note")


@query("notes_lifecycle", """
WITH valid AS (SELECT conv_id, turn, trim(text) AS note FROM conversations WHERE turn % 3 = 2 OR trim(text) <> ''),
last_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM valid) WHERE rn = 1)
SELECT 'stored' AS kind, CAST(conv_id AS VARCHAR) AS note_id, 'p-' || CAST(conv_id AS VARCHAR) AS posting_id, note
FROM last_ WHERE turn % 3 <> 2 AND conv_id IN (SELECT conv_id FROM valid WHERE turn = 0)
UNION ALL
SELECT 'blank', CAST(conv_id AS VARCHAR), NULL, NULL FROM conversations WHERE turn % 3 <> 2 AND coalesce(trim(text), '') = ''""")
def notes_lifecycle(spark, sf_dir):
    """First turns add notes, later ones edit or delete them in the same batch; blank texts are refused."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    at = F.timestamp_seconds(F.col("turn"))
    changes = turns.select(
        F.col("conv_id").cast("string").alias("note_id"),
        F.when(F.col("turn") == 0, F.concat(F.lit("p-"), F.col("conv_id").cast("string"))).alias("posting_id"),
        F.col("text").alias("note"), at.alias("created_at"), at.alias("updated_at"),
        F.when(F.col("turn") == 0, "INSERT").when(F.col("turn") % 3 == 2, "DELETE").otherwise("UPDATE").alias("op"))
    valid, blank = tracking.note_changes(changes)
    stored = tracking.apply_notes(changes.limit(0).drop("op"), valid)
    missing = F.lit(None).cast("string")
    return stored.select(F.lit("stored").alias("kind"), "note_id", "posting_id", "note").unionByName(
        blank.select(F.lit("blank").alias("kind"), "note_id", missing.alias("posting_id"), missing.alias("note")))


@query("notes_by_posting", """
SELECT CAST(conv_id AS VARCHAR) AS note_id, text AS note FROM conversations WHERE turn = 1""")
def notes_by_posting(spark, sf_dir):
    """The notes of one posting, newest first; a turn's number stands for the posting."""
    notes = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.col("conv_id").cast("string").alias("note_id"), F.col("turn").cast("string").alias("posting_id"),
        F.col("text").alias("note"), F.timestamp_seconds(F.col("conv_id")).alias("created_at"))
    return tracking.notes_for(notes, "1").select("note_id", "note")


@query("hide_jobs", """
SELECT CAST(user_id AS VARCHAR) AS posting_id,
  strftime(min(CASE WHEN event_type = 'view' THEN ts ELSE TIMESTAMP '1999-01-01' END), '%Y-%m-%d %H:%M:%S') AS hidden_at
FROM events WHERE event_type IN ('view', 'error') GROUP BY 1""")
def hide_jobs(spark, sf_dir):
    """Users with an error are hidden already and keep their time; views hide the others."""
    events = table(spark, sf_dir, "events", "user_id", "event_type", "ts").withColumn(
        "posting_id", F.col("user_id").cast("string"))
    hidden = events.filter("event_type = 'error'").select("posting_id").distinct().withColumn(
        "hidden_at", moment(date(1999, 1, 1)))
    changes = events.filter("event_type = 'view'").select("posting_id", F.col("ts").cast("timestamp").alias("hidden_at"))
    return tracking.hide(hidden, changes).select("posting_id", seconds("hidden_at"))


@query("profile_parse", """
SELECT 'p-' || CAST(c_custkey AS VARCHAR) AS profile_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'DE' WHEN 'MACHINERY' THEN 'SWE' WHEN 'HOUSEHOLD' THEN 'DA'
    WHEN 'FURNITURE' THEN 'BI' WHEN 'AUTOMOBILE' THEN 'DS' END AS roles, 'SQL,Python' AS skills,
  CASE WHEN c_custkey % 5 <> 0 THEN abs(c_acctbal) * 10 ELSE CAST(0 AS DOUBLE) END AS min_salary
FROM customer""")
def profile_parse(spark, sf_dir):
    return parse(profiles(spark, sf_dir)).select(
        "profile_id", F.array_join("target_roles", ",").alias("roles"),
        F.array_join("target_skills", ",").alias("skills"), "min_salary")


# --- runs ---------------------------------------------------------------------
@query("run_status", """
WITH a AS (SELECT CASE WHEN event_type = 'error' AND user_id % 5 = 0 THEN 'broken'
    ELSE 's' || CAST(user_id % 5 AS VARCHAR) END AS source, event_type <> 'error' AS ok,
  CAST(floor(value) AS BIGINT) AS rows_, ts FROM events),
o AS (SELECT source, CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CAST(coalesce(sum(rows_) FILTER (WHERE ok), 0) AS BIGINT) AS rows_written, min(ts) AS a, max(ts) AS b FROM a GROUP BY 1)
SELECT source, status, rows_written, strftime(a, '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(b, '%Y-%m-%d %H:%M:%S') AS ended_at FROM o
UNION ALL
SELECT 'OVERALL', CASE WHEN count(*) FILTER (WHERE status = 'SUCCESS') = 0 THEN 'FAILED'
  WHEN count(*) FILTER (WHERE status <> 'SUCCESS') > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END,
  CAST(sum(rows_written) AS BIGINT), strftime(min(a), '%Y-%m-%d %H:%M:%S'), strftime(max(b), '%Y-%m-%d %H:%M:%S') FROM o""")
def run_status(spark, sf_dir):
    """Events as attempts on five sources' boards, errors being failures."""
    source = F.when((F.col("event_type") == "error") & (F.col("user_id") % 5 == 0), "broken").otherwise(
        F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")))
    attempts = table(spark, sf_dir, "events").select(
        source.alias("source"), (F.col("event_type") != "error").alias("ok"),
        F.floor("value").alias("rows"), F.col("ts").cast("timestamp").alias("ts"))
    outcomes = runlog.source_outcomes(attempts, "source", F.col("ok"), F.col("rows"), "ts", "ts")
    return runlog.run_log(outcomes, "run-1").select(
        "source", "status", "rows_written", seconds("started_at"), seconds("ended_at"))


_LOG = """
log AS (SELECT event_type AS source, ts FROM events
  WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' AND user_id % 3 <> 0),
marks AS (SELECT t.source, coalesce(max(l.ts), TIMESTAMP '2023-12-31') AS mark
  FROM (SELECT DISTINCT event_type AS source FROM events) t LEFT JOIN log l ON l.source = t.source GROUP BY 1)"""


def _marks(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    failed = (F.col("event_type") == "error") | (F.col("user_id") % 3 == 0)
    log = events.filter(F.col("ts") < moment(date(2024, 1, 15))).select(
        F.col("event_type").alias("source"), F.col("ts").alias("ended_at"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"))
    sources = events.select(F.col("event_type").alias("source"))
    return events, runlog.high_watermark(log, sources, date(2024, 1, 30))


@query("high_watermark", O.select(_LOG, "SELECT source, strftime(mark, '%Y-%m-%d %H:%M:%S') AS watermark FROM marks"))
def high_watermark(spark, sf_dir):
    return _marks(spark, sf_dir)[1].select("source", seconds("watermark"))


@query("watermark_batch", O.select(_LOG, """
SELECT event_id, event_type FROM events JOIN marks ON source = event_type WHERE ts > mark"""))
def watermark_batch(spark, sf_dir):
    """Events newer than the last successful run of their source."""
    events, marks = _marks(spark, sf_dir)
    return runlog.since_watermark(events, marks, "event_type", "ts").select("event_id", "event_type")


# --- retention and archive ----------------------------------------------------
@query("retention_split", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'deleted' ELSE 'kept' END AS fate, event_type AS source, count(*) AS n
FROM events GROUP BY 1, 2""")
def retention_split(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_type", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    kept, dropped = lifecycle.retention_split(events, date(2024, 1, 30), 10, "ts", "event_type")
    left = kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return (dropped.select(F.lit("deleted").alias("fate"), F.col("event_type").alias("source"),
                           F.col("rows_deleted").alias("n"))
            .unionByName(left.select(F.lit("kept").alias("fate"), F.col("event_type").alias("source"), "n")))


_ISO = "%Y-%m-%dT%H:%M:%S+00:00"
_ENCODED = O.STAR + f""",
encoded AS (
  SELECT f.posting_id, f.job_title, f.role_family, c.company_name, l.location_normalized AS location, f.source_id,
    CAST(f.date_posted AS VARCHAR) AS date_posted, CAST(f.closing_date AS VARCHAR) AS closing_date,
    strftime(f.first_seen_at, '{_ISO}') AS first_seen_at, strftime(f.last_seen_at, '{_ISO}') AS last_seen_at,
    f.is_incomplete, d.salary_min, d.salary_max, d.currency, d.employment_type, d.posting_url, d.apply_url,
    d.description, '2001-08-02T00:00:00+00:00' AS archived_at,
    CASE WHEN f.closing_date < {O.DAY} THEN 'DATE_PASSED' ELSE 'NO_LONGER_SEEN' END AS archive_reason,
    to_base64(encode(f.posting_id || '|' || f.role_family || '|' || strftime(f.last_seen_at, '{_ISO}')))
      AS _encoded_token
  FROM arch f JOIN companies c USING (company_id) LEFT JOIN locations l USING (location_id)
  LEFT JOIN details d ON d.posting_id = f.posting_id
)"""


def _encoded(spark, sf_dir):
    star = bound(spark, sf_dir).star()
    stale = star.archive.drop("archived_at", "archive_reason")
    return lifecycle.encode(
        lifecycle.denormalize(stale, star.companies, star.locations, star.details), AS_OF)


@query("archive_encode", O.select(_ENCODED, "SELECT * FROM encoded"))
def archive_encode(spark, sf_dir):
    return _encoded(spark, sf_dir)


@query("archive_scan", O.select(_ENCODED, """
SELECT posting_id, last_seen_at, _encoded_token, (SELECT count(*) FROM encoded) AS archived_ids
FROM encoded ORDER BY posting_id LIMIT 100"""))
def archive_scan(spark, sf_dir):
    """Encoded rows written as gzip JSON lines; the first hundred read back, with the id count."""
    path = scratch_path(spark, "archive")
    archive.append_archive(_encoded(spark, sf_dir), path)
    total = archive.archived_ids(spark, path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return archive.first_archived(spark, path, 100).select(
        "posting_id", "last_seen_at", "_encoded_token").withColumn("archived_ids", total)


@query("archive_purge", O.select(O.STAR, f"""
, cold AS (SELECT posting_id FROM applications),
m AS (SELECT posting_id FROM arch)
SELECT 'facts' AS metric, count(*) AS value FROM live
UNION ALL SELECT 'archive', count(*) FROM m
UNION ALL SELECT 'details', count(*) FROM details WHERE posting_id IN (SELECT posting_id FROM live)
UNION ALL SELECT 'mentions', count(*) FROM mentions WHERE posting_id IN (SELECT posting_id FROM live)
UNION ALL SELECT 'encoded', count(*) FROM m WHERE posting_id NOT IN (SELECT posting_id FROM cold)
UNION ALL SELECT 'encoded_count', count(*) FROM m WHERE posting_id NOT IN (SELECT posting_id FROM cold)
UNION ALL SELECT 'purged_count', count(*) FROM m
UNION ALL SELECT 'total_archived_offline', (SELECT count(*) FROM cold)
  + (SELECT count(*) FROM m WHERE posting_id NOT IN (SELECT posting_id FROM cold))"""))
def archive_purge(spark, sf_dir):
    """Sizes of all tables after a purge, with the applied-for postings already in the cold archive."""
    star = bound(spark, sf_dir).star()
    archived = star.archive.limit(0)
    facts = star.facts.unionByName(star.archive.drop("archived_at", "archive_reason"))
    purge = lifecycle.archive_split(facts, archived, star.companies, star.locations, star.details,
                                    star.mentions, star.applications, AS_OF, STALE_DAYS)
    sizes = {"facts": purge.facts, "archive": purge.archive, "details": purge.details,
             "mentions": purge.mentions, "encoded": purge.encoded}
    rows = None
    for name, df in sizes.items():
        row = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
        rows = row if rows is None else rows.unionByName(row)
    counters = purge.counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in purge.counts.columns
    ])).alias("r")).select("r.*")
    return rows.unionByName(counters)


# --- reading ------------------------------------------------------------------
def _tracker(spark, sf_dir):
    return marts.application_tracker(bound(spark, sf_dir).star(), AS_OF)


def _matches(spark, sf_dir):
    return marts.MARTS["mart_job_match"](bound(spark, sf_dir).star(), AS_OF)


@query("tracker_export", O.select(O.STAR, f"""
SELECT posting_id, company_name, job_title, location, coalesce(CAST(date_posted AS VARCHAR), '') AS date_posted,
  coalesce(CAST(closing_date AS VARCHAR), 'Not specified') AS closing_date,
  coalesce(CAST(date_applied AS VARCHAR), '') AS date_applied,
  CASE WHEN is_likely_closed THEN 'Yes' ELSE 'No' END AS is_likely_closed,
  {O.stamp("last_seen_at")} AS last_seen_at FROM tracker"""))
def tracker_export(spark, sf_dir):
    return tracker_rows(_tracker(spark, sf_dir))


@query("kpis", O.select(O.STAR, """
SELECT 'live_postings' AS metric, count(*) AS value FROM live
UNION ALL SELECT 'tracked_postings', count(*) FROM applications
UNION ALL SELECT 'current_companies', count(DISTINCT company_name) FROM companies
UNION ALL SELECT 'cataloged_skills', count(*) FROM skills"""))
def kpis(spark, sf_dir):
    star = bound(spark, sf_dir).star()
    return browse.key_figures(star.facts, star.applications, star.companies, star.skills)


@query("topk_skills", O.select(O.STAR, """
SELECT skill_name, CAST(sum(postings_mentioning_skill) AS BIGINT) AS total FROM trend GROUP BY 1
ORDER BY total DESC, skill_name LIMIT 10"""))
def topk_skills(spark, sf_dir):
    trend = marts.skill_demand_trend(bound(spark, sf_dir).star(), AS_OF)
    return browse.top_totals(trend, "skill_name", "postings_mentioning_skill", 10, "total")


@query("topk_companies", O.select(O.STAR, """
SELECT company_name, CAST(sum(postings_posted) AS BIGINT) AS total FROM velocity GROUP BY 1
ORDER BY total DESC, company_name LIMIT 12"""))
def topk_companies(spark, sf_dir):
    velocity = marts.hiring_velocity(bound(spark, sf_dir).star(), AS_OF)
    return browse.top_totals(velocity, "company_name", "postings_posted", 12, "total")


@query("topk_activity", O.select(O.STAR, """
SELECT company_name, active_postings, likely_closed_postings, total_postings FROM activity
ORDER BY total_postings DESC, company_name LIMIT 12"""))
def topk_activity(spark, sf_dir):
    busy = marts.company_activity(bound(spark, sf_dir).star(), AS_OF).select(
        "company_name", "active_postings", "likely_closed_postings", "total_postings")
    return browse.top_rows(busy, [F.desc("total_postings"), F.asc("company_name")], 12)


@query("latest_rows", O.select(O.STAR, """
SELECT posting_id, company_name, job_title, location, date_posted, closing_date, date_applied, is_likely_closed
FROM tracker ORDER BY date_posted DESC NULLS LAST, posting_id LIMIT 16"""))
def latest_rows(spark, sf_dir):
    rows = _tracker(spark, sf_dir).select("posting_id", "company_name", "job_title", "location", "date_posted",
                                          "closing_date", "date_applied", "is_likely_closed")
    return browse.top_rows(rows, [F.desc_nulls_last("date_posted"), F.asc("posting_id")], 16)


@query("newest_postings", O.select(O.STAR, """
SELECT posting_id, company_name, job_title, location, date_posted, is_likely_closed FROM tracker"""))
def newest_postings(spark, sf_dir):
    return browse.newest(_tracker(spark, sf_dir)).select(
        "posting_id", "company_name", "job_title", "location", "date_posted", "is_likely_closed")


@query("browse_page", O.select(O.DEFAULT_MATCH, """
, hits AS (
  SELECT m.posting_id, m.match_score FROM matches m JOIN details d ON d.posting_id = m.posting_id
  WHERE (lower(m.job_title) LIKE '%experience%' OR lower(d.description) LIKE '%experience%')
    AND m.role_family IN ('DE', 'SWE', 'DA', 'DS') AND m.match_score >= 50
    AND coalesce(m.salary_max, m.salary_min) >= 20000
    AND m.posting_id IN (SELECT posting_id FROM mentions JOIN skills USING (skill_id)
      WHERE skill_name IN ('SQL', 'Docker')))
SELECT posting_id, match_score, (SELECT count(*) FROM hits) AS total_matches FROM hits
ORDER BY match_score DESC, posting_id LIMIT 20 OFFSET 20"""))
def browse_page(spark, sf_dir):
    star = bound(spark, sf_dir).star()
    where = browse.BrowseFilter(keyword="experience", families=("DE", "SWE", "DA", "DS"), min_score=50.0,
                                salary_from=20000.0, skills=("SQL", "docker"))
    rows = _matches(spark, sf_dir).join(star.details.select("posting_id", "description"), "posting_id")
    matching = browse.browse(rows, where, star.mentions, star.skills).select("posting_id", "match_score")
    return browse.page(matching, "match_score", 2, 20)


def _keyset_sql() -> str:
    orders = {"date_posted": "date_posted DESC", "match_score": "match_score DESC", "salary": "salary_max DESC",
              "company": "company_name ASC", "last_seen": "last_seen_at DESC"}
    return " UNION ALL ".join(f"""SELECT '{sort}' AS sort, CAST((r - 1) // 20 + 1 AS INTEGER) AS page, posting_id FROM (
      SELECT posting_id, row_number() OVER (ORDER BY {order} NULLS LAST, posting_id) AS r FROM matches) WHERE r <= 20 OR r BETWEEN 41 AND 60"""
                              for sort, order in orders.items())


@query("browse_after", O.select(O.DEFAULT_MATCH, _keyset_sql()))
def browse_after(spark, sf_dir):
    """The first and the third page of every order, each found from the last row of the page before."""
    rows = stored(_matches(spark, sf_dir).select("posting_id", *{c for _, c in browse.SORTS.values()}), "matches")
    out = None
    for sort, (_, column) in browse.SORTS.items():
        last = None
        for number in (1, 2, 3):
            found = browse.after(rows, sort, 20, last)
            if number != 2:
                part = found.select(F.lit(sort).alias("sort"), F.lit(number).alias("page"), "posting_id")
                out = part if out is None else out.unionByName(part)
            seen = found.select(column, "posting_id").collect()  # one page
            last = (seen[-1][0], seen[-1][1]) if seen else last
    return out


@query("new_matches", O.select(O.DEFAULT_MATCH, """
SELECT posting_id, match_score FROM matches WHERE match_score >= 60 AND first_seen_at > TIMESTAMP '2001-03-01'"""))
def new_matches(spark, sf_dir):
    state = spark.createDataFrame([("last_viewed_at", "2001-03-01 00:00:00")],
                                  "state_key string, state_value string")
    return browse.new_matches(_matches(spark, sf_dir), state, 60.0).select("posting_id", "match_score")


@query("compare_postings", O.select(O.DEFAULT_MATCH, """
, top_ AS (SELECT *, row_number() OVER (ORDER BY match_score DESC, posting_id) AS r FROM matches
  ORDER BY match_score DESC, posting_id LIMIT 3),
long_ AS (
  SELECT r, 'posting_id' AS attribute, posting_id AS value FROM top_
  UNION ALL SELECT r, 'company_name', company_name FROM top_ UNION ALL SELECT r, 'job_title', job_title FROM top_
  UNION ALL SELECT r, 'location', location FROM top_ UNION ALL SELECT r, 'match_score', CAST(match_score AS VARCHAR) FROM top_)
SELECT attribute, max(value) FILTER (WHERE r = 1) AS first, max(value) FILTER (WHERE r = 2) AS second,
  max(value) FILTER (WHERE r = 3) AS third FROM long_ GROUP BY 1"""))
def compare_postings(spark, sf_dir):
    """The three best matches side by side."""
    best = browse.top_rows(_matches(spark, sf_dir), [F.desc("match_score"), F.asc("posting_id")], 3)
    names = ["first", "second", "third"]
    rank = F.row_number().over(Window.orderBy(F.desc("match_score"), F.asc("posting_id")))  # of three rows
    named = best.withColumn("slot", F.get(F.array(*map(F.lit, names)), rank - 1))
    return browse.compare(named, ["posting_id", "company_name", "job_title", "location", "match_score"],
                          names, "slot")


@query("catalogs", O.select(O.STAR, """
SELECT 'skill' AS kind, skill_name AS name FROM skills
UNION ALL SELECT DISTINCT 'company', company_name FROM companies"""))
def catalogs(spark, sf_dir):
    star = bound(spark, sf_dir).star()
    return (browse.skill_catalog(star.skills).select(F.lit("skill").alias("kind"), F.col("skill_name").alias("name"))
            .unionByName(browse.company_catalog(star.companies).select(
                F.lit("company").alias("kind"), F.col("company_name").alias("name"))))


@query("source_distribution", O.select(O.FACTS, "SELECT source_id, count(*) AS postings FROM live GROUP BY 1"))
def source_distribution(spark, sf_dir):
    return browse.source_distribution(bound(spark, sf_dir).star().facts)


@query("skill_ranking", O.select(O.STAR, """
SELECT skill_name, count(DISTINCT posting_id) AS postings FROM mentions JOIN skills USING (skill_id) GROUP BY 1"""))
def skill_ranking(spark, sf_dir):
    star = bound(spark, sf_dir).star()
    return browse.skill_ranking(star.mentions, star.skills)


@query("match_by_vector", """
WITH q AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
scored AS (SELECT CAST(q.label AS VARCHAR) AS query, e.vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.v) AS score FROM embeddings e, q)
SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, round(score, 6) AS score
FROM scored QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) <= 20""")
def match_by_vector(spark, sf_dir):
    """The twenty vectors nearest to the first of each label, all vectors compared."""
    rows = table(spark, sf_dir, "embeddings")
    firsts = keep_first(rows, ["label"], [F.asc("vec_id")]).select("label", "embedding").collect()  # one a label
    found = vectors.match_by_vector(rows, {str(r["label"]): r["embedding"] for r in firsts}, 20)
    return found.withColumn("score", F.round("score", 6))


def _late_batches(spark, sf_dir):
    """Three deliveries of events: most, then repeats with some new ones, then what was held back."""
    path = scratch_path(spark, "deliveries")
    events = table(spark, sf_dir, "events", "event_id", "event_type", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    for i, part in enumerate(("event_id % 7 <> 0", "event_id % 3 = 0", "event_id % 7 = 0")):
        events.filter(part).coalesce(1).write.parquet(f"{path}/part={i}")
    return path, events.schema


@query("stream_late", """
WITH e AS (SELECT event_id, event_type, ts FROM events),
marks AS (SELECT max(ts) FILTER (event_id % 7 <> 0) - INTERVAL 10 DAY AS b, max(ts) FILTER (event_id % 7 <> 0 OR event_id % 3 = 0) - INTERVAL 10 DAY AS c FROM e),
fates AS (
  SELECT event_type, CASE WHEN event_id % 7 <> 0 THEN 'first'
    WHEN ts >= CASE WHEN event_id % 3 = 0 THEN b ELSE c END THEN 'first' ELSE 'late' END AS fate FROM e, marks
  UNION ALL SELECT event_type, 'repeat' FROM e WHERE event_id % 7 <> 0 AND event_id % 3 = 0
  UNION ALL SELECT event_type, 'repeat' FROM e WHERE event_id % 21 = 0)
SELECT fate, event_type, count(*) AS n FROM fates GROUP BY 1, 2""")
def stream_late(spark, sf_dir):
    """Every arrival of a stream as first, repeat or late first; none goes uncounted."""
    path, schema = _late_batches(spark, sf_dir)
    out, mark = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    records = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
               .parquet(path))  # oldest file first
    _run(late.arrivals(records, ["event_id"], "ts", out, mark, 10))
    return late.read_arrivals(spark, out).groupBy("fate", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_daily_late", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_daily_late(spark, sf_dir):
    """Counts per day and type that take late rows in, delivery by delivery."""
    path, schema = _late_batches(spark, sf_dir)
    out = scratch_path(spark, "daily")
    for i, mark in ((0, scratch_path(spark, "checkpoint")), (2, scratch_path(spark, "checkpoint"))):  # what part 1 repeats is left out
        records = spark.readStream.schema(schema).parquet(f"{path}/part={i}")
        _run(late.daily_partials(records, "ts", ["event_type"], out, mark))
    return late.daily_totals(spark, out, ["event_type"]).select("day", "event_type", "n")


# --- streams ------------------------------------------------------------------
def _event_stream(spark, sf_dir):
    """The events file as a stream; more files of the same name pattern would follow it."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(stream):
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()


@query("stream_land", EVENTS_SQL)
def stream_land(spark, sf_dir):
    records = _event_stream(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").cast("string").alias("day"),
        F.col("event_type").alias("source_id"))
    path = scratch_path(spark, "stream-landed")
    _run(streams.land_stream(landing.stamp(records, "run-1", AS_OF), path, scratch_path(spark, "checkpoint")))
    return read_events(spark.read.parquet(path))


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice; the second arrival is dropped."""
    twice = _event_stream(spark, sf_dir).withColumn("pull", F.explode(F.array(F.lit(0), F.lit(1))))
    once = streams.drop_repeats(twice, ["event_id"], "ts")
    path = scratch_path(spark, "stream-dedup")
    _run(streams.sink_append(once.select("event_id", "user_id", "event_type"), path,
                             scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path)


@query("stream_upsert", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, count(*) AS n FROM events
GROUP BY 1""")
def stream_upsert(spark, sf_dir):
    """Newest event and event count per user, merged micro-batch by micro-batch.

    The landed files are taken two at a time and in no order of time, so the
    newest event is a maximum, not the last to arrive.
    """
    landed = scratch_path(spark, "landed")
    landing.append_raw(landing.stamp(event_records(spark, sf_dir), "run-1", AS_OF), landed, ("source_id",))
    files = (spark.readStream.schema("payload string, run_id string, ingested_at timestamp, source_id string")
             .option("maxFilesPerTrigger", 2).parquet(landed))
    store = Snapshots(spark, scratch_path(spark, "stream-upsert"))

    def per_user(batch):
        r = batch.select(F.from_json("payload", EVENT).alias("r")).select("r.*")
        return r.groupBy("user_id").agg(
            F.max(F.struct("event_id", "event_type")).alias("newest"), F.count(F.lit(1)).alias("n"))

    store.commit("users", per_user(spark.read.parquet(landed).limit(0)))
    rules = {"newest": merge.greatest, "n": lambda t, s: t + s}
    _run(streams.upsert_stream(files, store, "users", ["user_id"], rules,
                               scratch_path(spark, "checkpoint"), prepare=per_user))
    return store.read("users").select("user_id", "newest.event_id", "newest.event_type", "n")


@query("stream_upsert_existing", """
SELECT user_id, max(event_id) AS event_id, count(*) AS n FROM events GROUP BY 1""")
def stream_upsert_existing(spark, sf_dir):
    """A table with earlier commits takes a stream, then another one with a fresh checkpoint.

    A third of the events is loaded in one batch, after an empty commit; each stream brings a third.
    """
    store = Snapshots(spark, scratch_path(spark, "stream-existing"))
    rules = {"event_id": merge.greatest, "n": lambda t, s: t + s}

    def per_user(batch):
        return batch.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("n"))

    def third(k):
        return F.col("event_id") % 3 == k

    events = table(spark, sf_dir, "events", "event_id", "user_id")
    store.commit("users", per_user(events.limit(0)))
    store.commit("users", merge.merge_upsert(store.read("users"), per_user(events.filter(third(0))), ["user_id"], rules))
    for k in (1, 2):
        _run(streams.upsert_stream(_event_stream(spark, sf_dir).filter(third(k)), store, "users", ["user_id"], rules,
                                   scratch_path(spark, "checkpoint"), prepare=per_user))
    return store.read("users")


@query("stream_daily", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_daily(spark, sf_dir):
    """Running counts per day and type; each update replaces the day's earlier count."""
    counts = streams.daily_counts(_event_stream(spark, sf_dir), "ts", ["event_type"], "40 days")
    store = Snapshots(spark, scratch_path(spark, "stream-daily"))
    store.commit("daily", spark.createDataFrame([], "day date, event_type string, n bigint"))
    _run(streams.upsert_stream(counts, store, "daily", ["day", "event_type"], {"n": merge.take_source},
                               scratch_path(spark, "checkpoint"), mode="update"))
    return store.read("daily")
