import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from postlake.operators.normalize import normalize, split_unidentified
from postlake.session import scratch_path
from postlake.sources import archive, config, export, landing, schemas
from postlake.sources.snapshots import Snapshots

AS_OF = date(2024, 1, 10)
AT = datetime(2024, 1, 10)


def raw(spark, source, *payloads):
    rows = [(json.dumps(p) if not isinstance(p, str) else p, "r", AT, source) for p in payloads]
    return spark.createDataFrame(rows, "payload string, run_id string, ingested_at timestamp, source_id string")


def first(spark, source, payload, **options):
    return normalize(raw(spark, source, payload), **options).first()


def test_adzuna(spark):
    row = first(spark, "adzuna", {
        "id": 7, "title": " Data Engineer ", "company": {"display_name": " Acme "},
        "location": {"display_name": "Berlin"}, "created": "2024-01-02T03:04:05Z", "redirect_url": "u",
        "description": "<b>x</b>", "salary_min": 10, "salary_max": "many", "currency": "EUR",
        "contract_time": "full_time"})
    assert (row.posting_id, row.company_name, row.job_title, row.role_family) == (
        "adzuna-7", "Acme", "Data Engineer", "DE")
    assert (row.date_posted, row.salary_min, row.salary_max) == (date(2024, 1, 2), 10.0, None)
    assert (row.currency, row.employment_type, row.apply_url, row.description) == ("EUR", "full_time", "u", "x")
    assert row.is_incomplete is False and row.dedup_key == "acme|data engineer|berlin"


def test_greenhouse_prefers_the_enriched_name(spark):
    row = first(spark, "greenhouse", {"id": 1, "company_display_name": "Good", "company_name": "bad", "title": "T",
                                      "location": "not an object", "first_published": "2024-01-01",
                                      "application_deadline": "2024-02-01T00:00:00Z"})
    assert (row.company_name, row.location_normalized, row.closing_date) == ("Good", "Unknown", date(2024, 2, 1))
    assert row.is_incomplete is True and row.salary_min is None


def test_lever_dates_are_milliseconds(spark):
    row = first(spark, "lever", {"id": "a", "company": "C", "text": "T", "createdAt": 1700000000000,
                                 "closedAt": 1700086400000, "categories": {"location": "L", "commitment": "Full"},
                                 "salaryRange": {"min": 1.5, "max": 2, "currency": "USD"}})
    assert (row.date_posted, row.closing_date) == (date(2023, 11, 14), date(2023, 11, 15))
    assert (row.salary_min, row.salary_max, row.currency, row.employment_type) == (1.5, 2.0, "USD", "Full")


@pytest.mark.parametrize("description, expected", [
    ({"role": "r", "company": "c"}, "r"), ({"company": "c"}, "c"), ("plain", "plain"),
    ({"other": 1}, '{"other":1}'), (None, "")])
def test_rippling_description_may_be_object_or_text(spark, description, expected):
    row = first(spark, "rippling", {"uuid": "u", "id": "i", "name": "T", "companyName": "C",
                                    "workLocations": ["A", "B"], "location": "Z", "publishedAt": "2024-01-05",
                                    "description": description})
    assert (row.posting_id, row.location_raw, row.date_posted, row.description) == (
        "rippling-u", "A", date(2024, 1, 5), expected)


def test_ashby_places(spark):
    address = {"postalAddress": {"addressLocality": "Pune", "addressCountry": "IN"}}
    base = {"id": "x", "company_display_name": "C", "title": "T", "publishedAt": "2024-01-01", "jobUrl": "j"}
    assert first(spark, "ashby", {**base, "location": "L", "address": address}).location_raw == "L"
    assert first(spark, "ashby", {**base, "address": address}).location_raw == "Pune, IN"
    # By default a remote flag without a place counts for nothing; on request it does.
    assert first(spark, "ashby", {**base, "isRemote": True}).location_normalized == "Unknown"
    assert first(spark, "ashby", {**base, "isRemote": True}, remote_fallback=True).location_raw == "Remote"
    assert first(spark, "ashby", base, remote_fallback=True).location_raw == "Unspecified"
    assert first(spark, "ashby", base).apply_url == "j"


def test_missing_ids_are_set_apart(spark):
    known, unknown = split_unidentified(normalize(raw(spark, "adzuna", {"id": 1}, {"title": "no id"})))
    assert (known.count(), unknown.count()) == (1, 1)
    row = known.first()
    assert (row.company_name, row.job_title, row.is_incomplete) == ("Unknown", "Unknown", True)


def test_unwrap(spark, rows):
    bodies = spark.createDataFrame(
        [(1, '{"jobs":[{"id":1},{"id":2}]}'), (2, '{"jobs":{"id":3}}'), (3, "[]"), (4, "oops")],
        "n int, body string")
    assert rows(landing.unwrap(bodies, "body", "jobs")) == [(1, '{"id":1}'), (1, '{"id":2}')]
    listed = spark.createDataFrame([('[{"id":1}]',), ('{"id":1}',)], "body string")
    assert rows(landing.unwrap(listed)) == [('{"id":1}',)]


def test_assemble_details(spark, rows):
    listed = spark.createDataFrame([("b", "1"), ("b", "2"), ("b", "3"), ("b", None)], "board string, job_id string")
    details = spark.createDataFrame([("b", "1", '{"x":1}'), ("b", "2", "[1]"), ("b", "9", "{}")],
                                    "board string, job_id string, payload string")
    found, missing = landing.assemble_details(listed, details, ["board", "job_id"])
    assert rows(found, "job_id") == [("1",)]
    assert rows(missing, "job_id") == [("2",), ("3",)]


def test_enrich_companies_overrides_payload_members(spark):
    companies = spark.createDataFrame(
        [("Acme", "acme", None, "Tech", ["Berlin"], "Fast"), ("Lev", None, "lev", "Ads", None, None)],
        "display_name string, greenhouse_board_token string, lever_company_slug string, industry string, "
        "locations array<string>, hiring_pace string")
    payload = '{"id": 12345678901234567890, "company_display_name": "old", "t": "a\\"b", "n": {"x": [1, null]}}'
    boards = spark.createDataFrame([("acme", payload), ("none", '{"id":1}')], "board_token string, payload string")
    out = {r.board_token: json.loads(r.payload)
           for r in landing.enrich_companies(boards, companies, "greenhouse").collect()}
    assert out["acme"]["company_display_name"] == "Acme"
    assert (out["acme"]["company_industry"], out["acme"]["company_locations"]) == ("Tech", ["Berlin"])
    assert out["acme"]["t"] == 'a"b' and out["acme"]["n"] == {"x": [1, None]}
    assert out["none"]["company_display_name"] == "Unknown"
    lever = spark.createDataFrame([("x", '{"company":"Own"}'), ("lev", '{"company":"Own"}')],
                                  "board_token string, payload string")
    names = {r.board_token: json.loads(r.payload)["company_display_name"]
             for r in landing.enrich_companies(lever, companies, "lever").collect()}
    assert names == {"x": "Own", "lev": "Lev"}


def test_quarantine(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1',), ('{"a":1} x',), (None,)], "payload string")
    split = landing.split_malformed(df)
    assert (split.good.count(), split.quarantine.count()) == (1, 3)
    places = spark.createDataFrame([("de",), ("xx",), (None,)], "country string")
    assert landing.split_unsupported_countries(places).quarantine.count() == 2


def test_land_counts_and_refuses_unknown_sources(spark):
    path = scratch_path(spark, "land")
    records = spark.createDataFrame([(1, "x"), (2, None)], "id int, title string")
    assert landing.land("lever", records, "run", AS_OF, path) == 2
    assert landing.land("lever", records.limit(0), "run", AS_OF, path) == 0
    back = spark.read.parquet(path)
    assert back.count() == 2 and set(back.columns) == {"payload", "run_id", "ingested_at", "source_id", "ingest_date"}
    with pytest.raises(ValueError):
        landing.land("elsewhere", records, "run", AS_OF, path)


def test_unchanged_records_are_dropped(spark, rows):
    landed = spark.createDataFrame([("a", "1")], "source_id string, payload string")
    batch = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "source_id string, payload string")
    hashes = landing.content_hashes(landed, ["source_id"])
    assert rows(landing.changed_only(batch, hashes, ["source_id"])) == [("a", "2"), ("b", "1")]


def test_config_files(spark, tmp_path, rows):
    (tmp_path / "c.yaml").write_text(
        "companies:\n  - {display_name: A, lever_company_slug: a, industry: I, locations: [X, Y]}\n")
    row = config.companies(spark, str(tmp_path / "c.yaml")).first()
    assert (row.display_name, row.lever_company_slug, row.locations, row.notes) == ("A", "a", ["X", "Y"], None)
    (tmp_path / "p.yaml").write_text(
        "enterprise_categories:\n  big:\n    - {company: A, programs: [p, q]}\n    - {company: B}\n  small:\n    - {company: C, stipend: 5k}\n")
    directory = config.portal_directory(spark, str(tmp_path / "p.yaml"))
    assert rows(config.flatten_directory(directory), "category", "company") == [
        ("big", "A"), ("big", "B"), ("small", "C")]
    flat = config.flatten_directory(directory, nested="programs", nested_out="program")
    assert rows(flat, "company", "program") == [("A", "p"), ("A", "q"), ("B", None), ("C", None)]
    (tmp_path / "u.yaml").write_text("profile:\n  target_roles: [DE]\n  min_salary: 5\n")
    stored = config.profile(spark, str(tmp_path / "u.yaml"), AS_OF).first()
    assert (stored.target_roles, stored.min_salary, stored.seniority_level) == ('["DE"]', 5.0, "ENTRY")


def test_snapshots(spark):
    store = Snapshots(spark, scratch_path(spark, "tables"))
    assert store.read("dim_source").count() == 0
    assert set(store.apply_schema()) == set(schemas.TABLES) and store.apply_schema() == []
    seeded = store.commit("dim_source", schemas.seed_sources(spark))
    assert seeded.count() == 5
    # A table can be replaced by a frame that reads it.
    store.commit("dim_source", store.read("dim_source").filter("source_id = 'lever'"))
    assert store.read("dim_source").count() == 1
    # A stream's batch that is done changes nothing; the next one, or another stream's, does.
    for batch, rows in ((("0a", 0), 1), (("0a", 1), 5)):
        store.commit("dim_source", schemas.seed_sources(spark).limit(rows), batch=batch)
        store.commit("dim_source", schemas.seed_sources(spark).limit(3), batch=batch)
        assert store.read("dim_source").count() == rows
    assert store.commit("dim_source", schemas.seed_sources(spark).limit(2), batch=("0b", 0)).count() == 2


def test_half_written_snapshot_is_not_seen(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.commit("dim_source", schemas.seed_sources(spark))
    (tmp_path / "dim_source" / "v=0000000002").mkdir()
    assert store.current("dim_source") == 1
    store.commit("dim_source", schemas.seed_sources(spark).limit(2))
    assert (store.current("dim_source"), store.read("dim_source").count()) == (3, 2)


def test_archive_of_nothing(spark):
    path = scratch_path(spark, "no-archive")
    assert archive.read_archive(spark, path).count() == 0
    assert archive.first_archived(spark, path, 5).count() == 0


def test_export_heading_and_blanks(spark, tmp_path):
    schema = ("posting_id string, company_name string, job_title string, location string, date_posted date, "
              "closing_date date, last_seen_at timestamp, is_likely_closed boolean, date_applied date, "
              "role_family string, status string")
    row = ("p", "c", "t", "l", date(2024, 1, 1), None, None, True, None, "DE", "NOT_APPLIED")
    full = spark.createDataFrame([row], schema)
    assert tuple(export.tracker_rows(full).first()) == (
        "p", "c", "t", "l", "2024-01-01", "Not specified", "", "Yes", "")
    for name, df in (("full", full), ("none", full.limit(0))):
        path = export.write_tracker(df, str(tmp_path / name), AT)
        text = spark.read.text(path).collect()
        assert text[0].value.startswith("Posting ID,Company,Job Title,Location,Date Posted,Closing Date")
    again = export.write_tracker(full, str(tmp_path / "full"), AT)
    assert again.endswith("full-20240110000000")
    assert spark.read.option("header", True).csv(again).select(F.col("`Closing Date`")).first()[0] == "Not specified"


def test_payloads_that_cannot_be_read_keep_their_text(spark):
    texts = ['{"a":1', '{"a":1,"a":2}', '{"a":1}', None]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    got = [r.p for r in df.select(landing.overlay_members(F.col("payload"), F.lit('{"b":2}')).alias("p")).collect()]
    assert got == ['{"a":1', '{"a":1,"a":2}', '{"a":1,"b":2}', None]


def test_cut_off_bodies_are_set_aside(spark):
    bodies = ['{"jobs":[{"a":1}]}', '{"jobs":[{"a":1}', '{"jobs":{}}', '{}', None, '{"jobs":[]}']
    split = landing.split_bodies(spark.createDataFrame([(b,) for b in bodies], "body string"), "body", "jobs")
    assert [r.body for r in split.good.collect()] == [bodies[0], bodies[5]]
    assert split.quarantine.filter("reason = 'PARSE_ERROR'").count() == 4
