from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import moment
from postlake.operators import dedup, dims, lifecycle, merge, quality, runlog, scd2, tagging, tracking
from postlake.operators.profiles import current_profile, parse, profile_row
from postlake.session import scratch_path
from postlake.sources import archive, schemas

AS_OF = date(2024, 1, 10)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


# --- dedup ---------------------------------------------------------------------
def test_repulls_versions_and_copies(spark, rows):
    df = spark.createDataFrame([
        ("a-1", "x", "k1", at(1)), ("a-1", "x", "k1", at(3)),     # the same content twice
        ("a-1", "y", "k2", at(5)),                                # a newer version
        ("b-1", "y", "k2", at(4)),                                # the same posting elsewhere, seen earlier
        ("c-1", "z", "k3", at(2)),
    ], "posting_id string, body string, dedup_key string, seen_at timestamp")
    collapsed = dedup.collapse_repulls(df)
    assert rows(collapsed, "posting_id", "body", "first_seen_at", "last_seen_at") == [
        ("a-1", "x", at(1), at(3)), ("a-1", "y", at(5), at(5)), ("b-1", "y", at(4), at(4)), ("c-1", "z", at(2), at(2))]
    latest = dedup.latest_version(collapsed)
    assert rows(latest, "posting_id", "body") == [("a-1", "y"), ("b-1", "y"), ("c-1", "z")]
    assert rows(dedup.earliest_survivor(latest), "posting_id") == [("b-1",), ("c-1",)]


def test_versions_seen_together_have_one_winner(spark):
    df = spark.createDataFrame([("a", str(i), at(1), at(1)) for i in range(20)],
                               "posting_id string, body string, first_seen_at timestamp, last_seen_at timestamp")
    winners = {dedup.latest_version(df.repartition(n)).first().body for n in (1, 3, 7)}
    assert len(winners) == 1


def test_a_hot_key_is_trimmed_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


# --- tagging -------------------------------------------------------------------
def test_both_tagging_plans_agree_on_real_text(spark, rows):
    terms = list(V.SKILLS) + ["de la", "la", "que", "et-cetera", "c++"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([
        (-1, "SQL, sql; CI/CD. A/B Testing Power BI/R java javascript c++ c++11 REST-API power  bi"),
        (-2, None), (-3, ""), (-4, "scikit-learn learn R&D r_x 'R'"), (-5, "éR R é la la que"),
    ], "doc_id long, text string")
    df = docs.unionByName(extra)
    dictionary = spark.createDataFrame([(t,) for t in terms], "term string")
    by_pattern = rows(tagging.tag_by_pattern(df, "doc_id", F.col("text"), terms))
    by_join = rows(tagging.tag_by_join(df, "doc_id", F.col("text"), dictionary))
    assert by_pattern == by_join
    found = {t for d, t in by_pattern if d == -1}
    assert found == {"sql", "ci/cd", "a/b testing", "power bi", "r", "java", "javascript", "rest", "api", "c++"} - {"c++"} | (
        {"c++"} & found)
    # Against one pattern per term, with no grouping of terms.
    one_by_one = F.array_compact(F.array(*[
        F.when(F.lower("text").rlike(r"\b" + tagging._quote(t.lower()) + r"\b"), t.lower()) for t in terms]))
    brute = rows(df.select("doc_id", F.explode(one_by_one).alias("term")))
    assert by_pattern == brute


def test_overlapping_terms_are_kept_apart(spark, rows):
    terms = ["machine learning", "learning systems", "learning", "sql server", "sql"]
    assert len(tagging.pattern_groups(terms)) > 1
    df = spark.createDataFrame([(1, "machine learning systems on sql server")], "id int, text string")
    assert rows(tagging.tag_by_pattern(df, "id", F.col("text"), terms)) == sorted(((1, t) for t in terms), key=repr)


def test_large_dictionaries_take_the_join(spark, rows):
    terms = [f"term{i}" for i in range(405)]
    df = spark.createDataFrame([(1, "Term3 and term404 but not term99999")], "id int, text string")
    assert rows(tagging.tag(df, "id", F.col("text"), terms, tagging.JOIN)) == [(1, "term3"), (1, "term404")]


# --- merges --------------------------------------------------------------------
KV = "k int, d date, v string, n int"
side = st.dictionaries(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.just(AS_OF))),
                       st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.integers(0, 9)), max_size=6)


def frame(spark, pairs):
    return spark.createDataFrame([(k, d, v, n) for (k, d), (v, n) in pairs.items()], KV)


@FEW
@given(target=side, source=side)
def test_upsert_against_a_dictionary_and_twice(spark, target, source):
    rules = {"v": merge.prefer_source, "n": merge.greatest}
    expected = dict(target)
    for key, (v, n) in source.items():
        if key in expected:
            old_v, old_n = expected[key]
            expected[key] = (v if v is not None else old_v, max(n, old_n))
        else:
            expected[key] = (v, n)
    t, s = frame(spark, target), frame(spark, source)
    once = merge.merge_upsert(t, s, ["k", "d"], rules)
    twice = merge.merge_upsert(once, s, ["k", "d"], rules)
    want = sorted(((k, d, v, n) for (k, d), (v, n) in expected.items()), key=repr)
    assert sorted((tuple(r) for r in once.collect()), key=repr) == want
    assert sorted((tuple(r) for r in twice.collect()), key=repr) == want


def test_upsert_takes_the_newest_source_row_and_booleans_are_three_valued(spark, rows):
    schema = "posting_id string, flag boolean, at timestamp"
    target = spark.createDataFrame([("a", False, at(1)), ("b", None, at(1))], schema)
    source = spark.createDataFrame([("a", True, at(2)), ("a", False, at(3)), ("b", False, at(2)), ("c", None, at(1))], schema)
    out = merge.merge_upsert(target, source, ["posting_id"], {"flag": merge.either, "at": merge.greatest},
                             order=[F.desc("at")])
    assert rows(out) == [("a", False, at(3)), ("b", None, at(2)), ("c", None, at(1))]


def test_insert_only_and_deletes(spark, rows):
    t = spark.createDataFrame([(1, "old")], "k int, v string")
    s = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    assert rows(merge.insert_missing(t, s, ["k"])) == [(1, "old"), (2, "new")]
    assert rows(merge.delete_keys(s, t, ["k"])) == [(2, "new")]


@FEW
@given(log=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["UPSERT", "DELETE"]), st.sampled_from("xyz")), max_size=8))
def test_change_log_last_write_wins(spark, log):
    state = {0: "a", 9: "b"}
    for key, op, value in log:
        state.pop(key, None)
        if op == "UPSERT":
            state[key] = value
    target = spark.createDataFrame([(0, "a"), (9, "b")], "k int, v string")
    changes = spark.createDataFrame([(k, op, v, i) for i, (k, op, v) in enumerate(log)], "k int, op string, v string, i int")
    out = merge.apply_changes(target, changes, ["k"], [F.desc("i")])
    assert {r.k: r.v for r in out.collect()} == state


# --- history -------------------------------------------------------------------
names = st.dictionaries(st.integers(0, 4), st.one_of(st.none(), st.sampled_from("xyz")), max_size=5)


@FEW
@given(snapshots=st.lists(names, min_size=1, max_size=3))
def test_history_is_contiguous_with_one_current_version(spark, snapshots):
    dim = schemas.empty(spark, "dim_company")
    for i, snapshot in enumerate(snapshots):
        s = spark.createDataFrame([(str(k), "n", v) for k, v in snapshot.items()],
                                  "company_id string, company_name string, display_name string")
        dim = scd2.scd2_apply(dim, s, "company_id", ["display_name"], moment(AS_OF + timedelta(days=i)))
        again = scd2.scd2_apply(dim, s, "company_id", ["display_name"], moment(AS_OF + timedelta(days=i)))
    found = sorted((tuple(r) for r in dim.collect()), key=repr)
    assert found == sorted((tuple(r) for r in again.collect()), key=repr)
    by_key = {}
    for key, _, value, start, end, current in sorted(found, key=lambda r: (r[0], r[3])):
        by_key.setdefault(key, []).append((value, start, end, current))
    latest = {}
    for snapshot in snapshots:
        latest.update({str(k): v for k, v in snapshot.items()})
    assert {k: v[-1][0] for k, v in by_key.items()} == latest
    for versions in by_key.values():
        assert [v[3] for v in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a[2] == b[1] for a, b in zip(versions, versions[1:])) and versions[-1][2] is None


def test_case_variants_are_one_company(spark):
    staging = spark.createDataFrame([("ACME", "ACME"), ("Acme", "Acme")], "company_name string, display_name string")
    assert scd2.company_snapshot(staging).count() == 1


def test_dimensions(spark, rows):
    df = spark.createDataFrame([(date(2023, 12, 30),), (None,), (date(2024, 1, 2),)], "d date")
    assert rows(dims.calendar(df, "d", AS_OF), "date_id", "day_of_week")[0] == (20231230, "Saturday")
    assert dims.calendar(df, "d", AS_OF).count() == 4
    assert rows(dims.calendar(df.limit(0), "d", AS_OF), "date") == [(AS_OF,)]
    old = spark.createDataFrame([("i1", "x", "X"), ("i0", "g", "Gone")], schemas.TABLES["dim_location"])
    new = spark.createDataFrame([("i1", "y", "X")], schemas.TABLES["dim_location"])
    assert rows(dims.accumulate(old, new, "location_id"), "location_id", "location_raw") == [("i0", "g"), ("i1", "y")]


# --- quality and runs ----------------------------------------------------------
def test_quality_rules(spark):
    schema = "posting_id string, job_title string, company_name string, date_posted date"
    good = spark.createDataFrame([("a", "t", "c", AS_OF), ("b", "t", "c", None)], schema)
    bad = spark.createDataFrame([("a", "t", "c", AS_OF + timedelta(days=1)), ("a", None, "c", None), (None, "t", "c", None)], schema)
    def report(df):
        return {r.rule_name: (r.status, r.rows_affected) for r in quality.report(df, as_of=AS_OF).collect()}
    assert report(good) == {"duplicate_posting_ids": ("PASS", 0), "null_required_fields": ("PASS", 0),
                            "future_date_posted": ("PASS", 0), "zero_postings": ("PASS", 2)}
    assert report(bad) == {"duplicate_posting_ids": ("FAIL", 1), "null_required_fields": ("FAIL", 2),
                           "future_date_posted": ("FAIL", 1), "zero_postings": ("PASS", 3)}
    empty = report(good.limit(0))
    assert empty["zero_postings"] == ("WARN", 0) and empty["duplicate_posting_ids"] == ("PASS", 0)
    assert quality.failed_count(quality.report(bad, as_of=AS_OF)).first()[0] == 3


@pytest.mark.parametrize("oks, downstream, expected", [
    ([True, True], True, "SUCCESS"), ([True, False], True, "PARTIAL"),
    ([False, False], True, "FAILED"), ([True, True], False, "FAILED")])
def test_run_status(spark, oks, downstream, expected):
    rows = [(f"s{i}", ok, 5, at(1), at(2)) for i, ok in enumerate(oks)]
    attempts = spark.createDataFrame(rows, "source string, ok boolean, rows int, a timestamp, b timestamp")
    outcomes = runlog.source_outcomes(attempts, "source", F.col("ok"), F.col("rows"), "a", "b")
    log = {r.source: r for r in runlog.run_log(outcomes, "r", downstream).collect()}
    assert log["OVERALL"].status == expected and log["OVERALL"].rows_written == 5 * sum(oks)
    assert log["s0"].started_at < log["s0"].ended_at


def test_a_source_fails_only_when_every_board_did(spark):
    attempts = spark.createDataFrame([("s", True, 1, at(1), at(1)), ("s", False, 0, at(1), at(1)), ("t", False, 0, at(1), at(1))],
                                     "source string, ok boolean, rows int, a timestamp, b timestamp")
    outcomes = runlog.source_outcomes(attempts, "source", F.col("ok"), F.col("rows"), "a", "b")
    assert {r.source: r.status for r in outcomes.collect()} == {"s": "SUCCESS", "t": "FAILED"}


def test_watermark_default(spark, rows):
    log = spark.createDataFrame([("a", "SUCCESS", at(3)), ("a", "SUCCESS", at(2)), ("b", "FAILED", at(5))],
                                "source string, status string, ended_at timestamp")
    sources = spark.createDataFrame([("a",), ("b",)], "source string")
    marks = runlog.high_watermark(log, sources, AS_OF)
    assert rows(marks) == [("a", at(3)), ("b", datetime(2023, 12, 11))]
    data = spark.createDataFrame([("a", at(3)), ("a", at(4)), ("b", at(1))], "src string, ts timestamp")
    assert rows(runlog.since_watermark(data, marks, "src", "ts")) == [("a", at(4)), ("b", at(1))]


# --- retention -----------------------------------------------------------------
def test_retention_days_must_be_positive(spark):
    df = spark.createDataFrame([], "source_id string, ingested_at timestamp")
    for bad in (0, -1):
        with pytest.raises(ValueError):
            lifecycle.retention_split(df, AS_OF, bad)
        with pytest.raises(ValueError):
            lifecycle.is_stale(AS_OF, bad)


def test_raw_retention(spark, rows):
    df = spark.createDataFrame([("a", at(1)), ("a", at(9)), ("b", at(2))], "source_id string, ingested_at timestamp")
    kept, dropped = lifecycle.retention_split(df, AS_OF, 5)
    assert rows(kept) == [("a", at(9))] and rows(dropped) == [("a", 1), ("b", 1)]


def test_archive_token_and_reason(spark):
    schema = ("posting_id string, job_title string, role_family string, company_name string, location string, "
              "source_id string, date_posted date, closing_date date, first_seen_at timestamp, last_seen_at timestamp, "
              "is_incomplete boolean, salary_min double, salary_max double, currency string, employment_type string, "
              "posting_url string, apply_url string, description string")
    base = ("p-1", "t", "DE", "c", "l", "s", AS_OF)
    tail = (False, None, None, None, None, None, None, None)
    df = spark.createDataFrame([(*base, date(2024, 1, 1), at(1), at(2, 3), *tail),
                                (*base, date(2024, 2, 1), at(1), None, *tail)], schema)
    import base64
    first, second = lifecycle.encode(df, AS_OF).orderBy("closing_date").collect()
    assert base64.b64decode(first._encoded_token).decode() == "p-1|DE|2024-01-02T03:00:00+00:00"
    assert base64.b64decode(second._encoded_token).decode() == "p-1|DE|None"
    assert (first.archive_reason, second.archive_reason) == ("DATE_PASSED", "NO_LONGER_SEEN")
    assert lifecycle.encode(df, AS_OF, legacy_reason=True).filter("archive_reason = 'DATE_PASSED'").count() == 2
    assert (first.closing_date, first.archived_at) == ("2024-01-01", "2024-01-10T00:00:00+00:00")


def _facts(spark):
    rows = [("live", None, at(9)), ("old", None, at(1)), ("closed", date(2024, 1, 9), at(9)), ("cold", None, at(1))]
    return spark.createDataFrame(
        [(i, "c", "l", "s", "t", "DE", AS_OF, closing, at(1), seen, False) for i, closing, seen in rows],
        schemas.TABLES["fact_job_posting"])


@pytest.mark.parametrize("cold_only", [False, True])
def test_archive_split_keeps_every_posting_once(spark, rows, cold_only):
    facts = _facts(spark)
    ids = facts.select("posting_id")
    details = ids.select("posting_id", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("salary_min", "double"), ("salary_max", "double"), ("currency", "string"), ("employment_type", "string"),
        ("posting_url", "string"), ("apply_url", "string"), ("description", "string"))])
    mentions = ids.withColumn("skill_id", F.lit("k"))
    cold = spark.createDataFrame([("cold",), ("gone",)], "posting_id string")
    before = spark.createDataFrame(
        [("old", "c", "l", "s", "archived title", "DE", AS_OF, None, at(1), at(1), False, at(1), "NO_LONGER_SEEN")],
        schemas.TABLES["fact_job_posting_archive"])
    purge = lifecycle.archive_split(facts, before, schemas.empty(spark, "dim_company"),
                                    schemas.empty(spark, "dim_location"), details, mentions, cold, AS_OF, 7, cold_only)
    assert rows(purge.facts, "posting_id") == [("live",)]
    assert rows(purge.details, "posting_id") == [("live",)] and rows(purge.mentions, "posting_id") == [("live",)]
    assert rows(purge.encoded, "posting_id", "job_title") == [("closed", "t"), ("old", "t")]   # the live row wins
    assert purge.counts.first().asDict() == {"encoded_count": 2, "purged_count": 3, "total_archived_offline": 4}
    assert rows(purge.archive, "posting_id") == ([] if cold_only else [("closed",), ("cold",), ("old",)])


def test_archive_files_round_trip(spark, tmp_path):
    encoded = spark.createDataFrame([], archive.ARCHIVE)
    row = {n.split(" ")[0]: None for n in archive.ARCHIVE.split(", ")}
    rows = spark.createDataFrame([tuple({**row, "posting_id": i, "archived_at": "t"}.values()) for i in "ab"], archive.ARCHIVE)
    path, plain = str(tmp_path / "gz"), str(tmp_path / "plain")
    for part in (rows.limit(1), encoded, rows):
        archive.append_archive(part, path, plain)
    assert archive.read_archive(spark, path).count() == spark.read.text(plain).count() == 3
    assert archive.archived_ids(spark, path).count() == 2
    assert archive.first_archived(spark, path, 1).first().posting_id == "a"


# --- user state ----------------------------------------------------------------
def test_application_checks_are_in_order(spark):
    postings = spark.createDataFrame([("p",)], "posting_id string")
    changes = spark.createDataFrame([
        (1, "p", AS_OF, "APPLIED"), (2, "p", AS_OF + timedelta(days=1), "NOPE"), (3, "q", AS_OF, "NOPE"), (4, "q", AS_OF, "SAVED")],
        "i int, posting_id string, date_applied date, status string")
    out = {r.i: r.reject_reason for r in tracking.validate_applications(changes, postings, AS_OF).collect()}
    assert out == {1: None, 2: "FUTURE_DATE", 3: "INVALID_STATUS", 4: "POSTING_NOT_FOUND"}
    saved = tracking.save_jobs(postings, AS_OF, moment(AS_OF))
    applied = tracking.apply_applications(schemas.empty(spark, "applications"), saved)
    assert applied.first().status == "SAVED"


def test_notes(spark, rows):
    schema = "note_id string, posting_id string, note string, created_at timestamp, updated_at timestamp, op string"
    changes = spark.createDataFrame([
        ("n1", "p", "  hello ", at(1), at(1), "INSERT"), ("n2", "p", "   ", at(1), at(1), "INSERT"),
        (None, "p", "new", at(2), at(2), "INSERT"), ("n9", "p", "x", at(1), at(1), "UPDATE")], schema)
    valid, blank = tracking.note_changes(changes)
    assert blank.count() == 1 and valid.filter("note_id is null").count() == 0
    notes = tracking.apply_notes(schemas.empty(spark, "job_notes"), valid)
    assert sorted(r.note for r in notes.collect()) == ["hello", "new"]      # the unknown note is not created
    edits = spark.createDataFrame([("n1", "other", "edited", at(5), at(5), "UPDATE")], schema)
    edited = tracking.apply_notes(notes, tracking.note_changes(edits)[0]).filter("note_id = 'n1'").first()
    assert (edited.note, edited.posting_id, edited.created_at, edited.updated_at) == ("edited", "p", at(1), at(5))
    drop = spark.createDataFrame([("n1", None, None, None, at(6), "DELETE")], schema)
    assert tracking.apply_notes(notes, tracking.note_changes(drop)[0]).count() == 1
    assert [r.note for r in tracking.notes_for(notes, "p").collect()] == ["new", "hello"]


def test_hide_keeps_the_first_time(spark, rows):
    hidden = spark.createDataFrame([("a", at(1))], "posting_id string, hidden_at timestamp")
    changes = spark.createDataFrame([("a", at(3)), ("b", at(4)), ("b", at(2))], "posting_id string, hidden_at timestamp")
    assert rows(tracking.hide(hidden, changes)) == [("a", at(1)), ("b", at(2))]


def test_profiles(spark):
    none = schemas.empty(spark, "user_profile")
    assert current_profile(none).first().target_skills == V.PROFILE_DEFAULT["target_skills"]
    stored = tracking.upsert_profiles(none, profile_row(spark, AS_OF, target_roles=["SWE"], min_salary=10))
    again = tracking.upsert_profiles(stored, profile_row(spark, AS_OF + timedelta(days=1), target_roles=["BI"]))
    assert again.count() == 1 and current_profile(again).first().target_roles == ["BI"]
    holes = stored.withColumns({"target_skills": F.lit(None).cast("string"), "min_salary": F.lit(None).cast("double"),
                                "target_roles": F.lit("not json")})
    row = parse(holes).first()
    assert (row.target_skills, row.min_salary, row.target_roles) == (["SQL", "Python"], 0.0, ["DE", "DA", "BI"])


def test_notes_added_edited_and_deleted_in_one_batch(spark):
    at = [datetime(2024, 1, 1, h) for h in range(4)]
    schema = "note_id string, posting_id string, note string, created_at timestamp, updated_at timestamp, op string"
    changes = spark.createDataFrame([
        ("a", "p", "first", at[0], at[0], "INSERT"), ("a", None, "second", None, at[1], "UPDATE"),
        ("b", "p", "gone", at[0], at[0], "INSERT"), ("b", None, None, None, at[0], "DELETE"),
        ("c", None, "no such note", None, at[0], "UPDATE"),
        ("d", None, "too early", None, at[0], "UPDATE"), ("d", "q", "kept", at[2], at[2], "INSERT")], schema)
    got = tracking.apply_notes(changes.limit(0).drop("op"), changes).collect()
    assert sorted((r.note_id, r.posting_id, r.note, r.created_at) for r in got) == [
        ("a", "p", "second", at[0]), ("d", "q", "kept", at[2])]


def test_spans_are_never_the_broadcast_side(spark, rows, monkeypatch):
    """A small file of texts has many spans; the plan goes by the dictionary's measured size."""
    path = scratch_path(spark, "texts")
    spark.range(2000).select("id", F.concat(F.lit("plain words and sql "), F.col("id").cast("string")).alias("text")).write.parquet(path)
    texts, dictionary = spark.read.parquet(path), spark.createDataFrame([("SQL",), ("words and",), ("",), (None,)], "term string")

    def plan_and_rows():
        pairs = tagging.tag_by_join(texts, "id", F.col("text"), dictionary)
        return pairs._jdf.queryExecution().sparkPlan().toString(), rows(pairs)

    small, found = plan_and_rows()
    assert "BroadcastHashJoin" in small and "BuildRight" in small and len(found) == 4000
    monkeypatch.setattr(tagging, "SMALL_DICTIONARY", 0)
    large, same = plan_and_rows()
    assert "SortMergeJoin" in large and "Broadcast" not in large and same == found
