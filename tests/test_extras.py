"""Keyset pages, aliases, vectors, late arrivals, clustered landing, one word boundary."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postlake.operators import aliases, browse, tagging, vectors
from postlake.session import scratch_path
from postlake.sources import landing
from postlake.streaming import late

START = datetime(2024, 1, 1)


# --- keyset paging ---------------------------------------------------------------
@pytest.fixture(scope="module")
def postings(spark):
    draw = random.Random(4)
    rows = [(f"p{i:03d}", draw.choice([None, START.date() + timedelta(days=draw.randrange(5))]), draw.choice([None, 1.0, 2.5, 9.0]),
             draw.choice([None, 100.0, 200.0]), draw.choice([None, "a", "B", "b"]), draw.choice([None, START + timedelta(hours=draw.randrange(3))])) for i in range(57)]
    return spark.createDataFrame(rows, "posting_id string, date_posted date, match_score double, salary_max double, company_name string, last_seen_at timestamp")


@pytest.mark.parametrize("sort", browse.SORTS)
def test_pages_found_from_the_last_row_cover_the_order(postings, sort):
    direction, column = browse.SORTS[sort]
    whole = [r.posting_id for r in postings.orderBy(direction(column), "posting_id").collect()]
    seen, last = [], None
    while True:
        rows = browse.after(postings, sort, 10, last).collect()
        if not rows:
            break
        seen += [r.posting_id for r in rows]
        last = (rows[-1][column], rows[-1].posting_id)
    assert seen == whole
    plan = browse.after(postings, sort, 10, last)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


# --- aliases -----------------------------------------------------------------------
def test_aliases_close_over_chains_and_both_directions(spark):
    chain = [(f"n{i:02d}", f"N{i + 1:02d}") for i in range(20)] + [("x", "X"), (None, "y"), ("z", None), ("b", "a"), ("c", "B"), ("c", "B")]
    got = {r.name: r.canonical for r in aliases.closure(spark.createDataFrame(chain, "name string, alias string")).collect()}
    assert got == {**{f"n{i:02d}": "n00" for i in range(21)}, "a": "a", "b": "a", "c": "a"}
    names = spark.createDataFrame([("n03", "n00")], "name string, canonical string")
    rows = spark.createDataFrame([("N03",), ("Other",), (None,)], "s string")
    assert sorted(str(r.s) for r in aliases.canonical(rows, "s", names).collect()) == ["None", "n00", "other"]
    assert aliases.closure(spark.createDataFrame([], "name string, alias string")).count() == 0


# --- vectors -----------------------------------------------------------------------
def test_vectors_match_brute_force(spark):
    draw = random.Random(8)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(200)] + [(500, [0.0] * 4), (501, None), (502, [1.0]), (503, [1.0, 0.0, 0.0, 0.0]), (504, [2.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    asked = {"x": [1.0, 0.0, 0.0, 0.0], "y": [0.5, -1.0, 2.0, 0.1]}
    got = vectors.match_by_vector(table, asked, 5)
    for name, q in asked.items():
        def score(v, q=q):
            return sum(a * b for a, b in zip(v, q)) / (sum(a * a for a in v) ** 0.5 * sum(b * b for b in q) ** 0.5)
        want = sorted(((-score(v), i) for i, v in rows if v and len(v) == 4 and any(v)))[:5]
        assert [r.vec_id for r in got.filter(F.col("query") == name).orderBy("rank").collect()] == [i for _, i in want]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan and "Cartesian" not in plan
    assert vectors.match_by_vector(table, {}, 5).count() == 0 and vectors.match_by_vector(table.limit(0), asked, 5).count() == 0
    with pytest.raises(ValueError):
        vectors.match_by_vector(table, {str(i): [1.0] for i in range(vectors.QUERIES_MAX + 1)}, 5)


# --- late arrivals -----------------------------------------------------------------
SCHEMA = "id int, who string, at timestamp"


def deliver(spark, path, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(path)


def done(query):
    query.awaitTermination()
    assert query.exception() is None


def test_late_first_arrivals_are_told_from_repeats(spark):
    path, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    day = lambda n: START + timedelta(days=n)
    deliver(spark, path, (1, "a", day(0)), (1, "b", day(0)), (2, "a", day(30)))
    done(late.arrivals(read(spark, path), ["id"], "at", out, mark, 10))
    deliver(spark, path, (1, "c", day(0)), (3, "a", day(5)), (4, "a", day(25)), (3, "a", day(6)), (None, "n", day(40)), (None, "m", day(41)))
    done(late.arrivals(read(spark, path), ["id"], "at", out, mark, 10))
    deliver(spark, path, (3, "z", day(40)), (5, "a", day(30)))
    done(late.arrivals(read(spark, path), ["id"], "at", out, mark, 10))
    rows = late.read_arrivals(spark, out).collect()
    assert len(rows) == 11
    fate = lambda i: sorted((r.fate, r.batch) for r in rows if r.id == i)
    assert fate(1) == [("first", 0), ("repeat", 0), ("repeat", 1)] and fate(2) == [("first", 0)]
    assert fate(3) == [("late", 1), ("repeat", 1), ("repeat", 2)] and fate(4) == [("first", 1)] and fate(5) == [("late", 2)]


def test_daily_partials_count_late_rows_and_replays_once(spark):
    path, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    deliver(spark, path, (1, "a", START + timedelta(days=9)))
    deliver(spark, path, (2, "a", START), (3, "b", START))
    done(late.daily_partials(read(spark, path), "at", ["who"], out, mark))
    counts = lambda: sorted((str(r.day), r.who, r.n) for r in late.daily_totals(spark, out, ["who"]).collect())
    want = [("2024-01-01", "a", 1), ("2024-01-01", "b", 1), ("2024-01-10", "a", 1)]
    assert counts() == want
    last = sorted(n for n in os.listdir(f"{mark}/commits") if n.isdigit())[-1]  # as if the last batch had died before its commit
    os.rename(f"{mark}/commits/{last}", f"{mark}/lost-{last}")
    if os.path.exists(f"{mark}/commits/.{last}.crc"):
        os.rename(f"{mark}/commits/.{last}.crc", f"{mark}/lost-{last}.crc")
    done(late.daily_partials(read(spark, path), "at", ["who"], out, mark))
    assert counts() == want


# --- landing and tagging ---------------------------------------------------------
def test_landing_writes_few_files(spark):
    path = scratch_path(spark, "landed")
    raw = spark.range(4000).repartition(16).select(F.col("id").cast("string").alias("payload"), F.lit("r").alias("run_id"),
                                                   F.lit(START).alias("ingested_at"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source_id"))
    assert landing.append_raw(raw, path) == 4000
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) == 3 and spark.read.parquet(path).count() == 4000


def test_both_tagging_plans_agree_on_any_script(spark, rows):
    texts = ["SQL und Éclair", "éR r", "R, Ünï-R", "naïve bayes", "日本sql", "sql日本 sql", "C++ c++x", "x_sql sql_", "A/B testing", None, "", "ér R"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    terms = ["SQL", "R", "Éclair", "naïve Bayes", "A/B Testing", "C"]
    one = tagging.tag(df, "k", F.col("t"), terms, tagging.PATTERN)
    other = tagging.tag(df, "k", F.col("t"), terms, tagging.JOIN)
    assert rows(one) == rows(other)
    assert {(r.k, r.term) for r in one.collect()} >= {(0, "sql"), (0, "éclair"), (1, "r"), (3, "naïve bayes"), (8, "a/b testing")}
    assert not {(4, "sql"), (7, "sql")} & {(r.k, r.term) for r in one.collect()}
