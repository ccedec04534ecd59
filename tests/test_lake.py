"""Refreshes that move only what changed: files, plans, refused rows, retention."""

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from postlake.bindings import lakes
from postlake.operators import dedup, lifecycle
from postlake.plans import refresh
from postlake.plans.refresh import Lake
from postlake.session import compiled_methods, passing, scratch_path, stored, tracked
from postlake.sources import archive, landing, schemas

START = datetime(2024, 1, 10)


def job(number, **extra):
    return {"id": number, "company_name": f"C{number}", "title": f"Data Engineer {number}", "location": {"name": "Pune"},
            "first_published": f"2024-01-{number % 9 + 1:02d}" if number % 2 else f"2023-11-{number % 9 + 1:02d}",
            "content": "SQL and Python", "absolute_url": "u", **extra}


def land(spark, lake, source, at, *payloads):
    rows = spark.createDataFrame([(p if p is None or isinstance(p, str) else json.dumps(p),) for p in payloads], "payload string")
    landing.append_raw(landing.stamp(rows, "r", at, source, "payload"), lake.raw_path)


def attempts(spark, at, **sources):
    return spark.createDataFrame([(s, ok, 1, at, at) for s, ok in sources.items()], "source string, ok boolean, rows int, started_at timestamp, ended_at timestamp")


def files(path):
    return {os.path.relpath(os.path.join(folder, name), path) for folder, _, names in os.walk(path) for name in names if name.startswith("part-")}


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(spark, scratch_path(spark, "touched"), buckets=16)
    lake.setup(START)
    land(spark, lake, "greenhouse", START, *[job(i) for i in range(40)])
    assert lake.refresh("run-1", attempts(spark, START, greenhouse=True), START) == "SUCCESS"
    return lake


def test_untouched_partitions_keep_their_files(spark, lake):
    names = ("staging_postings", "job_posting_detail", "fact_posting_skill_mention", "fact_job_posting")
    before = {n: files(lake.large.path(n)) for n in names}
    parsed = files(lake.normalized_path)
    later = datetime(2024, 1, 12)
    land(spark, lake, "greenhouse", later, job(3, content="SQL, Docker"))
    assert lake.marks() == {"greenhouse": date(2024, 1, 10)}
    assert lake.refresh("run-2", attempts(spark, later, greenhouse=True), later) == "SUCCESS"
    for name in names:
        after = files(lake.large.path(name))
        kept = {os.path.dirname(f) for f in before[name] & after}
        assert before[name] - after and len({os.path.dirname(f) for f in before[name] - after}) == 1, name  # one bucket, one month
        assert kept and {os.path.dirname(f) for f in after - before[name]} == {os.path.dirname(f) for f in before[name] - after}, name
    detail = lake.store.read("job_posting_detail").filter("posting_id = 'greenhouse-3'").first()
    assert detail.description == "SQL, Docker" and lake.store.read("job_posting_detail").count() == 40
    assert lake.store.read("fact_job_posting").count() == 40
    skills = {r.skill_id for r in lake.store.read("fact_posting_skill_mention").filter("posting_id = 'greenhouse-3'").collect()}
    assert len(skills) == 2
    # a run without news rewrites none of them, and parses again only the days from the mark on
    before = {n: files(lake.large.path(n)) for n in names}
    assert lake.refresh("run-3", attempts(spark, later, greenhouse=True), later) == "SUCCESS"
    assert {n: files(lake.large.path(n)) for n in names} == before
    assert {f for f in files(lake.normalized_path) if "2024-01-10" in f} <= parsed | {f for f in files(lake.normalized_path) if "2024-01-10" in f}


def test_raw_days_before_the_mark_are_not_opened(lake):
    plan = lake.raw_since({"greenhouse": date(2024, 1, 12)}, START, 30)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "ingest_date" in filters and "greenhouse" in filters and "DataFilters: []" in plan
    read = lake.raw_since({"greenhouse": date(2024, 1, 12)}, START, 30).select(F.input_file_name().alias("f")).distinct().collect()
    assert all("2024-01-12" in r.f for r in read)


def test_a_purged_posting_does_not_come_back(spark):
    lake = Lake(spark, scratch_path(spark, "purged"), buckets=4)
    lake.setup(START)
    land(spark, lake, "greenhouse", START, job(1), job(2))
    lake.refresh("run-1", attempts(spark, START, greenhouse=True), START)
    later = datetime(2024, 1, 20)
    land(spark, lake, "greenhouse", later, job(2))
    lake.refresh("run-2", attempts(spark, later, greenhouse=True), later)
    ids = lambda: sorted(r.posting_id for r in lake.store.read("fact_job_posting").collect())
    assert ids() == ["greenhouse-2"] and lake.store.read("fact_job_posting_archive").count() == 1
    assert lake.store.read("staging_postings").count() == 2  # still inside the window of raw rows
    archived = files(lake.large.path("fact_job_posting_archive"))
    lake.refresh("run-3", attempts(spark, later, greenhouse=True), later)
    assert ids() == ["greenhouse-2"] and files(lake.large.path("fact_job_posting_archive")) == archived
    assert [r.posting_id for r in lake.store.read("job_posting_detail").collect()] == ["greenhouse-2"]
    # seen again after the purge, it is a live posting again
    land(spark, lake, "greenhouse", later, job(1, title="Data Engineer back"))
    lake.refresh("run-5", attempts(spark, later, greenhouse=True), later)
    assert ids() == ["greenhouse-1", "greenhouse-2"]


def test_refused_rows_are_kept_and_counted(spark):
    lake = Lake(spark, scratch_path(spark, "refused"))
    land(spark, lake, "greenhouse", START, job(1), '{"id": 2, "tit', {"title": "no id"}, None, "", "[1]", "3")
    rows = spark.createDataFrame([("{}", "r", START, "elsewhere"), ("{}", "r", START, None)], "payload string, run_id string, ingested_at timestamp, source_id string")
    landing.append_raw(rows, lake.raw_path)
    counts = lake.absorb(START)
    assert counts == {"good": 1, "PARSE_ERROR": 3, "MISSING_ID": 3, "UNKNOWN_SOURCE": 2}
    refused = lake.refused().groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in refused} == {"PARSE_ERROR": 3, "MISSING_ID": 3, "UNKNOWN_SOURCE": 2}
    assert lake.refused().filter("payload = '{\"id\": 2, \"tit'").count() == 1 and lake.normalized().filter("payload is not null").count() == 0
    assert lake.absorb(START) == counts and lake.refused().count() == 8  # again: the same partitions


def test_raw_days_are_dropped_whole_but_for_the_edge(spark):
    lake = Lake(spark, scratch_path(spark, "retained"))
    for at in (datetime(2024, 1, 1), datetime(2024, 1, 5, 6), datetime(2024, 1, 5, 18), datetime(2024, 1, 9)):
        land(spark, lake, "greenhouse", at, job(at.day), job(at.day + 20))
    land(spark, lake, "lever", datetime(2024, 1, 5, 6), {"id": "a"})
    lake.absorb(datetime(2024, 1, 9))
    young = {f for f in files(lake.raw_path) if "2024-01-09" in f}
    counts = lake.clean_raw("run-1", datetime(2024, 1, 15, 12), 10)
    assert counts == {"greenhouse": 4, "lever": 1}
    left = lake.raw().groupBy("source_id", "ingest_date").count().collect()
    assert {(r.source_id, str(r.ingest_date)): r["count"] for r in left} == {("greenhouse", "2024-01-05"): 2, ("greenhouse", "2024-01-09"): 2}
    assert young <= files(lake.raw_path) and lake.normalized().filter("ingest_date < '2024-01-05'").count() == 0
    assert lake.clean_raw("run-2", datetime(2024, 1, 15, 12), 10) == {}
    log = lake.store.read_log("pipeline_run_log").collect()
    assert {(r.run_id, r.source): r.rows_written for r in log} == {("run-1", "RETENTION greenhouse"): 4, ("run-1", "RETENTION lever"): 1}


def exchanges(plan):
    """Column names of every shuffle in a plan."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name == "Exchange":
            out = node.output()
            found.append([out.apply(i).name() for i in range(out.size())])
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_dedup_shuffles_wide_rows_once(spark):
    path = scratch_path(spark, "normalized")
    spark.createDataFrame([], schemas.TABLES["staging_postings_normalized"]).write.parquet(path)
    rows = spark.read.schema(schemas.TABLES["staging_postings_normalized"]).parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(dedup.deduplicate(rows)._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) >= 4 and len([names for names in found if "description" in names]) == 1, found


def test_dedup_picks_the_same_rows_as_step_by_step(spark, rows):
    base = {c.split(" ")[0]: None for c in schemas.TABLES["staging_postings_normalized"].split(", ")}
    made = []
    for i in range(60):
        made.append({**base, "posting_id": f"p{i % 11}", "dedup_key": f"k{i % 5}", "job_title": f"t{i % 3}", "description": "" if i % 2 else None,
                     "seen_at": datetime(2024, 1, 1 + i % 28, i % 24), "is_incomplete": False, "date_posted": date(2024, 1, 1)})
    df = spark.createDataFrame([tuple(m.values()) for m in made], schemas.TABLES["staging_postings_normalized"])
    steps = dedup.earliest_survivor(dedup.latest_version(dedup.collapse_repulls(df))).select(*schemas.columns("staging_postings"))
    assert rows(dedup.deduplicate(df)) == rows(steps)
    assert dedup.deduplicate(df.limit(0)).count() == 0


def test_archived_ids_come_from_the_index(spark):
    path = scratch_path(spark, "cold")
    assert archive.archived_ids(spark, path).count() == 0
    names = [c.split(" ")[0] for c in archive.ARCHIVE.split(", ")]
    rows = spark.createDataFrame([tuple("a" if n == "posting_id" else None for n in names)] * 2, archive.ARCHIVE)
    archive.append_archive(rows, path)
    archive.append_archive(rows.withColumn("posting_id", F.lit("b")), path)
    ids = archive.archived_ids(spark, path)
    assert sorted(r.posting_id for r in ids.collect()) == ["a", "b"]
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "json" not in plan.lower()
    older = scratch_path(spark, "older")  # an archive from before there was an index
    rows.write.json(older, compression="gzip")
    assert archive.archived_ids(spark, older).count() == 1 and os.path.isdir(archive.ids_path(older))


def test_archived_rows_without_a_cold_copy_are_encoded_once(spark):
    facts = schemas.empty(spark, "fact_job_posting")
    names = schemas.columns("fact_job_posting_archive")
    def row(key, seen):
        return tuple({"posting_id": key, "last_seen_at": seen}.get(n) for n in names)
    past = spark.createDataFrame([row("a", START), row("a", datetime(2023, 1, 1)), row("b", START)], schemas.TABLES["fact_job_posting_archive"])
    known = spark.createDataFrame([("b",)], "posting_id string")
    purge = lifecycle.archive_split(facts, past, *[schemas.empty(spark, n) for n in ("dim_company", "dim_location", "job_posting_detail", "fact_posting_skill_mention")], known, START)
    assert [(r.posting_id, r.last_seen_at[:10]) for r in purge.encoded.collect()] == [("a", "2024-01-10")]
    assert purge.counts.first().asDict() == {"encoded_count": 1, "purged_count": 2, "total_archived_offline": 2}


def test_dedup_reads_its_input_once(spark):
    """Every row is judged by a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        calls.add(1)
        return text

    base = {c.split(" ")[0]: None for c in schemas.TABLES["staging_postings_normalized"].split(", ")}
    made = [tuple({**base, "posting_id": f"p{i % 7}", "dedup_key": f"k{i % 7}", "job_title": "t", "is_incomplete": False,
                   "seen_at": datetime(2024, 1, 1, i % 24)}.values()) for i in range(40)]
    df = spark.createDataFrame(made, schemas.TABLES["staging_postings_normalized"]).withColumn("job_title", counted("job_title"))
    assert dedup.deduplicate(df).count() == 7
    assert calls.value == 40


def test_a_rewrite_computes_the_change_once(spark):
    large = Lake(spark, scratch_path(spark, "once"), buckets=4).large
    names = schemas.columns("fact_posting_skill_mention")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        calls.add(1)
        return value

    rows = spark.createDataFrame([(f"p-{i % 20}", f"s-{i}") for i in range(40)], "posting_id string, skill_id string")
    made = rows.select(counted("posting_id").alias("posting_id"), "skill_id").select(*names)
    large.rewrite("fact_posting_skill_mention", range(4), lambda old: old.unionByName(made))
    assert calls.value == 40 and large.read("fact_posting_skill_mention").count() == 40
    large.rewrite("fact_posting_skill_mention", [0, 1], lambda old: old.limit(0))  # emptied partitions go, others stay
    kept = {c for c in large.children(large.path("fact_posting_skill_mention")) if "=" in c}
    assert kept <= {"bucket_of_4=2", "bucket_of_4=3"} and large.exists("fact_posting_skill_mention")
    large.rewrite("fact_posting_skill_mention", [0, 1, 2, 3], lambda old: old.filter("posting_id = 'none'"))
    assert not large.exists("fact_posting_skill_mention") and large.read("fact_posting_skill_mention").count() == 0


def test_attempts_are_counted_once(spark):
    lake = Lake(spark, scratch_path(spark, "attempts"), buckets=4)
    lake.setup(START)
    land(spark, lake, "greenhouse", START, job(1))
    calls = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(ok):
        calls.add(1)
        return ok

    tried = attempts(spark, START, greenhouse=True).withColumn("ok", counted("ok"))
    assert lake.refresh("run-1", tried, START) == "SUCCESS"
    assert calls.value <= 2  # once for the boards that did well and at most once for the others


def test_balance_tells_postings_by_their_own_id(spark, tmp_path):
    """A company whose name looks like another posting's address spoils nothing."""
    when = "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate"
    spark.sql(f"SELECT id AS o_orderkey, 1L AS o_custkey, {when}, 10.0D AS o_totalprice FROM VALUES 5L, 10L, 101L, 103L, 107L, -15L AS t(id)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS c_custkey, 'a.example/101' AS c_name, 0 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'PERU' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    found = {(r["source_id"], r["outcome"]): r["n"] for r in lakes.refresh_balance(spark, str(tmp_path)).collect()}
    assert found == {("adzuna", "good"): 6, ("greenhouse", "PARSE_ERROR"): 2, ("rippling", "MISSING_ID"): 2, ("elsewhere", "UNKNOWN_SOURCE"): 2}


def test_landing_runs_only_methods_that_are_compiled(spark, tmp_path, monkeypatch):
    """While landed rows are written, a method too long for HotSpot to compile is not used; after that the setting is as before."""
    name, seen, write = "spark.sql.codegen.hugeMethodLimit", [], DataFrameWriter.parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(name)), write(self, path))[1])
    raw = spark.sql("SELECT '{}' AS payload, 'lever' AS source_id, 'r' AS run_id, timestamp'1992-01-01 00:00:00' AS ingested_at")
    assert landing.append_raw(raw, f"{tmp_path}/raw") == 1
    assert seen == ["8000"] and spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError), compiled_methods(spark):
        raise ZeroDivisionError
    assert spark.conf.get(name) == before


def shuffles(spark):
    """Ids of the shuffles that have files."""
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (held.apply(i).getName() for i in range(held.size()))
    return {int(n.split("_")[1]) for n in names if n.startswith("shuffle_")}


def test_a_refresh_leaves_only_the_lake_on_disk(spark):
    lake = Lake(spark, scratch_path(spark, "lean"), buckets=4)
    lake.setup(START)
    before, codec = shuffles(spark), spark.conf.get("spark.sql.parquet.compression.codec")
    for number, at in enumerate((START, datetime(2024, 1, 12)), 1):
        rows = spark.createDataFrame([(json.dumps(job(i, title=f"T{number}")),) for i in range(40)], "payload string")
        assert lake.land(landing.stamp(rows, "r", at, "greenhouse", "payload")) == 40
        with tracked() as made:
            assert lake.refresh(f"run-{number}", attempts(spark, at, greenhouse=True), at) == "SUCCESS"
        names = {os.path.basename(p).rsplit("-", 1)[0] for p in made}
        assert names >= {"outcomes", "ranking", "changed", "batch", "replaced", "details", "mentions", "facts", "stale", "lost", "encoded"}
        assert not [p for p in made if os.path.exists(p.removeprefix("file:"))]
    until, few = time.time() + 20, 4  # files go shortly after their query, but for stages over some log rows that it gave up while they ran
    while len(shuffles(spark) - before) > few and time.time() < until:
        time.sleep(0.2)
    assert len(shuffles(spark) - before) <= few
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec
    versions = [v for v in os.listdir(f"{lake.root.removeprefix('file:')}/tables/staging_ranking") if v.startswith("v=")]
    assert len(versions) == 1 and lake.store.read("staging_ranking").count() == 40
    assert lake.store.read("fact_job_posting").count() == 40


def test_scratch_goes_after_an_error_and_blocks_nest(spark):
    with tracked() as outer:
        with pytest.raises(ZeroDivisionError), passing(spark):  # the outer list equals the inner one here
            raise ZeroDivisionError
        with pytest.raises(ZeroDivisionError), passing(spark):
            stored(spark.range(1), "lost")
            raise ZeroDivisionError
        stored(spark.range(1), "kept")
    with passing(spark), ThreadPoolExecutor(1) as other:  # such as a stream's batch
        beside = other.submit(stored, spark.range(1), "beside").result()
    assert beside.count() == 1
    there = [os.path.isdir(p.removeprefix("file:")) for p in outer]
    assert there == [False, True]


def test_good_raw_files_are_absorbed_without_a_shuffle(spark, monkeypatch):
    """Small files are brought together, others written as they are cut: the same rows either way."""
    plans, write, found = [], DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()), write(self, path))[1])
    for good_size in (1 << 20, 0):
        monkeypatch.setattr(refresh, "GOOD_SIZE", good_size)
        lake = Lake(spark, scratch_path(spark, "absorbed"))
        for source, at in (("greenhouse", START), ("greenhouse", datetime(2024, 1, 9)), ("lever", START)):
            land(spark, lake, source, at, job(1), job(2), job(2), {"title": "no id"}, '{"id": 3, "tit', None)
        rows = spark.createDataFrame([("elsewhere", "{}", "r", START)], "source_id string, payload string, run_id string, ingested_at timestamp")
        landing.append_raw(rows, lake.raw_path)
        plans.clear()
        counts = lake.absorb(START)
        assert ["RebalancePartitions" in p for p in plans] == [good_size > 0]
        assert lake.absorb(START) == counts  # again: the same partitions
        found.append((counts, *(sorted(map(repr, lake.normalized(f).collect())) for f in ("good", "refused"))))
    assert found[0] == found[1] and found[0][0]["good"] == 9 and len(found[0][2]) == 10
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_narrowed_sightings_rank_as_the_whole_ones(spark):
    day = F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 3 as int))")
    rows = spark.range(200).select(
        F.concat(F.lit("p"), (F.col("id") % 40).cast("string")).alias("posting_id"), F.md5((F.col("id") % 90).cast("string")).alias("digest"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("k|"), (F.col("id") % 11).cast("string"))).alias("dedup_key"), day.alias("seen_at"))
    names = ["posting_id", "digest", "first_seen_at", "last_seen_at"]
    whole = dedup.survivors(dedup.sightings(rows)).select(names)
    small = dedup.survivors(dedup.sightings(dedup.narrowed(rows, "seen_at"))).withColumn("digest", F.lower(F.hex("digest"))).select(names)
    assert whole.count() > 1 and sorted(whole.collect()) == sorted(small.collect())
