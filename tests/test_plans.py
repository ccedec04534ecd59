import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from postlake import vocabulary as V
from postlake.bindings.registry import ORACLES, QUERIES
from postlake.bindings.tables import AS_OF, bound, profiles
from postlake.operators import browse
from postlake.operators.profiles import parse, profile_row
from postlake.plans import marts, matching
from postlake.plans.refresh import Lake
from postlake.session import scratch_path, spread
from postlake.sources import landing, schemas

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def gold(spark):
    return bound(spark, SF).star()


# --- plans ---------------------------------------------------------------------
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
            "MapInPandas", "FlatMapGroupsInPandas", "SinglePartition, REPARTITION")
STREAMS = [n for n in QUERIES if n.startswith("stream_")]


def test_no_query_uses_a_cross_join_or_python_rows(spark):
    for name, run in QUERIES.items():
        if name in STREAMS:
            continue
        plan = run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not [u for u in UNWANTED if u in plan], name
        assert "hint" not in plan.lower(), name


def test_every_query_has_sql(spark):
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["posting_id", "company_name"] and df.count() > 0


def test_scan_of_a_mart_reads_only_what_it_needs(spark, gold):
    plan = marts.role_market(gold, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "description" not in plan and "job_title" not in plan


def test_bucketed_tables_meet_without_a_shuffle(spark, gold):
    """With broadcasting off, as for large tables, fact and detail join bucket by bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.facts.join(gold.details, "posting_id", "left").join(
            matching.posting_skills(gold.mentions, gold.skills.limit(0)).select("posting_id", "skill_points"),
            "posting_id", "left")
        plan = gold.facts.join(gold.details, "posting_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == gold.facts.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_spread_leaves_a_well_split_scan_alone(spark):
    many = spark.range(100).repartition(16)
    assert spread(many) is many
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() >= 4


# --- marts on hand-made rows ----------------------------------------------------
def test_a_posting_with_two_dates_counts_once(spark, gold, rows):
    facts = spark.createDataFrame(
        [("p", "c", "l", "s", "t", "DE", d, None, datetime(2001, 7, 1), seen, True)
         for d, seen in ((date(2001, 7, 1), datetime(2001, 7, 1)), (None, datetime(2001, 8, 2)))],
        schemas.TABLES["fact_job_posting"])
    star = gold.replace(
        facts=facts, archive=gold.archive.limit(0),
        companies=spark.createDataFrame([("c", "C", "C", None, None, True), ("c", "Old", "C", None, None, False)],
                                        schemas.TABLES["dim_company"]))
    activity = marts.company_activity(star, AS_OF).first()
    assert (activity.company_name, activity.total_postings) == ("C", 1)
    assert (activity.likely_closed_postings, activity.active_postings) == (1, 1)
    quality = marts.source_quality(star, AS_OF).first()
    assert (quality.total_postings, quality.incomplete_postings, quality.incomplete_percentage) == (1, 2, 200.0)
    assert rows(marts.role_market(star, AS_OF), "year_month") == [("2001-07",), ("2001-08",)]   # no date: today
    assert rows(marts.hiring_velocity(star, AS_OF), "year", "postings_posted") == [(2001, 1), (None, 1)]
    tracker = marts.application_tracker(star, AS_OF)
    assert rows(tracker, "status", "is_likely_closed") == [("NOT_APPLIED", False), ("NOT_APPLIED", True)]


def test_publish_makes_every_view(spark, gold):
    assert len(marts.publish(gold, AS_OF)) == 11
    assert spark.table("mart_source_quality").count() == 5


# --- matching -------------------------------------------------------------------
@pytest.mark.parametrize("k", [1, 3])
def test_many_profiles_equal_one_profile_at_a_time(spark, gold, k):
    """Brute force: every posting scored for every profile, including ties and odd salaries."""
    people = [
        dict(profile_id=f"q{i}", target_roles=roles, remote_preference=remote, min_salary=pay, seniority_level=level)
        for i, (roles, remote, pay, level) in enumerate([
            (["DE"], "ANY", 0.0, "ENTRY"), (["DE", "SWE"], "REMOTE_ONLY", 250000.0, "SENIOR"), ([], "ANY", 1e9, "MID"),
            (["OTHER"], "HYBRID", 41558.38, "LEAD"), (["BI", "DA", "DS"], "ONSITE", 326740.83, "ENTRY"),
            (["SWE", "DE"], "REMOTE_ONLY", 400000.0, "SENIOR")])]
    stored = None
    for person in people:
        row = profile_row(spark, AS_OF, **person)
        stored = row if stored is None else stored.unionByName(row)
    got = {(r.profile_id, r.match_rank): (r.posting_id, r.match_score)
           for r in matching.match_profiles(gold, parse(stored), AS_OF, k).collect()}
    for person in people:
        one = gold.replace(profiles=stored)
        all_rows = matching.job_match(one, AS_OF, person["profile_id"]).select(
            "posting_id", "match_score", F.greatest("salary_min", "salary_max").alias("best")).collect()
        ranked = sorted(all_rows, key=lambda r: (-r.match_score, -(r.best if r.best is not None else -1), r.posting_id))
        for rank, row in enumerate(ranked[:k], 1):
            assert got[(person["profile_id"], rank)] == (row.posting_id, row.match_score), person


def test_no_profile_stored_still_scores(gold):
    assert matching.job_match(gold.replace(profiles=gold.profiles.limit(0)), AS_OF).count() > 0


def test_many_profiles_shrinks_both_sides_before_they_meet(spark, gold):
    people = parse(profiles(spark, SF))
    tops = matching.segment_tops(gold, AS_OF, 5)
    assert tops.count() < matching.match_inputs(gold, AS_OF).count() + 1
    assert matching.match_profiles(gold, people, AS_OF, 5).count() == people.count() * 5


# --- browsing -------------------------------------------------------------------
def test_pages_cover_everything_once(spark, gold):
    rows = matching.job_match(gold, AS_OF)
    where = browse.BrowseFilter(families=("DE", "SWE"), likely_closed=True)
    hits = browse.browse(rows, where)
    n = hits.count()
    seen = []
    for number in range(1, n // 10 + 2):
        page = browse.page(hits, "company", number, 10).collect()
        assert all(r.total_matches == n for r in page)
        seen += [r.posting_id for r in page]
    assert len(seen) == n == len(set(seen))


@pytest.mark.parametrize("sort", browse.SORTS)
def test_every_sort_plans_as_top_k(gold, sort):
    page = browse.page(matching.job_match(gold, AS_OF), sort, 1, 5)
    assert "TakeOrderedAndProject" in plan_of(page) and page.count() == 5


def test_browse_conditions(gold):
    from datetime import date as d
    rows = matching.job_match(gold, AS_OF).withColumn("is_archived", F.lit(False)).withColumn(
        "source_id", F.split("posting_id", "-")[0]).withColumn("description", F.lit("Great Team"))
    where = browse.BrowseFilter(keyword="great team", sources=("lever", "adzuna"), location="nation", posted_from=d(2000, 1, 1),
                                posted_to=d(2001, 12, 31), salary_from=1.0, salary_to=1e9, archived=False, min_score=10.0)
    found = browse.browse(rows, where, gold.mentions, gold.skills).collect()
    assert found and all(r.posting_id.split("-")[0] in ("lever", "adzuna") for r in found)
    assert browse.browse(rows, browse.BrowseFilter(keyword="absent")).count() == 0


def test_new_matches_before_a_first_visit(spark, gold):
    rows = matching.job_match(gold, AS_OF)
    none = schemas.empty(spark, "app_state")
    assert browse.new_matches(rows, none, 0.0).count() == rows.count()


# --- a whole lake ---------------------------------------------------------------
def postings(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "payload string")


def job(number, **extra):
    return {"id": number, "company_name": f"C{number}", "title": "Data Engineer", "location": {"name": "Pune"},
            "first_published": "2024-01-02", "content": "SQL and Python", "absolute_url": "u", **extra}


def attempts(spark, **sources):
    rows = [(s, ok, 1, datetime(2024, 1, 10), datetime(2024, 1, 10, 1)) for s, ok in sources.items()]
    return spark.createDataFrame(rows, "source string, ok boolean, rows int, started_at timestamp, ended_at timestamp")


def land(spark, lake, source, at, *items):
    landing.append_raw(landing.stamp(postings(spark, *items), "r", at, source, "payload"), lake.raw_path)


def table_rows(lake, *names):
    return {n: sorted((tuple(r) for r in lake.store.read(n).collect()), key=repr) for n in names}


def test_a_refresh_twice_gives_the_same_tables_then_archives(spark):
    lake = Lake(spark, scratch_path(spark, "whole"))
    start = datetime(2024, 1, 10)
    lake.setup(start)
    lake.setup(start)
    assert lake.store.read("app_state").count() == 1 and lake.store.read("dim_source").count() == 5
    land(spark, lake, "greenhouse", start, job(1), job(2), {"title": "no id"})
    land(spark, lake, "adzuna", start, {"id": 1, "title": "Data Engineer", "company": {"display_name": "C1"},
                                        "location": {"display_name": "pune"}, "created": "2024-01-01"})
    lake.set_profiles(profile_row(spark, start, target_roles=["DE"]))
    names = ("staging_postings", "dim_company", "dim_location", "dim_date", "fact_job_posting",
             "job_posting_detail", "fact_posting_skill_mention")
    assert lake.refresh("run-1", attempts(spark, greenhouse=True, adzuna=True), start) == "SUCCESS"
    first = table_rows(lake, *names)
    # The same posting on two boards is one fact; the earliest seen, then the smaller id, survives.
    assert [r[0] for r in first["fact_job_posting"]] == ["adzuna-1", "greenhouse-2"]
    assert lake.refresh("run-2", attempts(spark, greenhouse=True, lever=False), start) == "PARTIAL"
    assert table_rows(lake, *names) == first
    assert spark.table("mart_job_match").count() == 2
    assert {(r.run_id, r.source): r.status for r in lake.store.read_log("pipeline_run_log").collect()}[("run-2", "lever")] == "FAILED"
    assert lake.store.read_log("data_quality_log").filter("status = 'FAIL'").count() == 0

    # Two weeks on, one posting is seen again; the other goes to the archive, exactly once.
    later = datetime(2024, 1, 24)
    land(spark, lake, "greenhouse", later, job(2, title="Senior Data Engineer"))
    for run in ("run-3", "run-4"):
        assert lake.refresh(run, attempts(spark, greenhouse=True), later) == "SUCCESS"
        facts = table_rows(lake, "fact_job_posting")["fact_job_posting"]
        assert [(r[0], r[4]) for r in facts] == [("greenhouse-2", "Data Engineer")]   # a matched title stays
    from postlake.sources import archive
    cold = archive.read_archive(spark, lake.archive_path).collect()
    assert [r.posting_id for r in cold] == ["adzuna-1"] and cold[0].description == ""
    assert spark.table("mart_application_tracker").filter("is_likely_closed").count() >= 1


def test_all_sources_failing_skips_the_rest_but_is_logged(spark):
    lake = Lake(spark, scratch_path(spark, "failed"))
    at = datetime(2024, 1, 10)
    assert lake.refresh("run-1", attempts(spark, lever=False), at) == "FAILED"
    assert not lake.store.exists("marts") and lake.store.read("staging_postings").count() == 0
    assert lake.store.read_log("pipeline_run_log").count() == 2


def test_a_broken_stage_is_logged_as_failed(spark):
    lake = Lake(spark, scratch_path(spark, "broken"))       # nothing landed: staging cannot read the raw path
    at = datetime(2024, 1, 10)
    with pytest.raises(Exception):
        lake.refresh("run-1", attempts(spark, lever=True), at)
    log = {r.source: r.status for r in lake.store.read_log("pipeline_run_log").collect()}
    assert log["OVERALL"] == "FAILED"


def test_vocabulary_is_whole():
    assert len(V.SKILLS) == 52 and len(set(V.SKILLS)) == 52 and len(V.COUNTRIES) == 20
    assert abs(sum(V.MATCH_WEIGHTS.values()) - 1.0) < 1e-9


def test_queries_bound_what_a_task_reads_but_keep_smaller_settings(spark):
    from postlake.session import TASK_BYTES, small_tasks

    files, shuffled = TASK_BYTES
    try:
        spark.conf.set(files, "128MB")
        spark.conf.set(shuffled, "8m")
        small_tasks(spark)
        assert spark.conf.get(files) == str(32 << 20) and spark.conf.get(shuffled) == "8m"
        spark.conf.unset(files), spark.conf.unset(shuffled)
        bound(spark, SF)
        assert spark.conf.get(files) == str(32 << 20) and spark.conf.get(shuffled) == str(16 << 20)
    finally:
        spark.conf.unset(files), spark.conf.unset(shuffled)
