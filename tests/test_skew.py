"""One key with a third of all rows: results stay whole and no task gets the hot rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from postlake.operators import dedup, merge
from postlake.operators.quality import report
from postlake.plans.marts import activity

N = 90_000
START = datetime(2024, 1, 1)


def sightings(spark):
    """A third of all rows are sightings of one posting, in ten contents."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(0, N, 1, 12).select(
        key.alias("posting_id"), (F.col("id") % 10).cast("string").alias("body"),
        key.alias("dedup_key"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("seen_at"), "id")


def test_dedup_of_a_hot_posting(spark):
    rows = sightings(spark).drop("id")
    collapsed = dedup.collapse_repulls(rows)
    assert collapsed.count() == 10 + 2 * N // 3
    latest = dedup.latest_version(collapsed)
    hot = latest.filter("posting_id = 'hot'").first()
    assert latest.count() == 1 + 2 * N // 3 and hot.body == str((N - 3) % 10)
    assert dedup.earliest_survivor(latest).count() == 1 + 2 * N // 3


def test_rows_that_cross_the_shuffle_for_a_hot_key(spark):
    """Each map task sends one row of the hot key: the limit runs before the exchange."""
    winners = dedup.keep_first(sightings(spark), ["posting_id"], [F.desc("seen_at")])
    winners.count()
    plan = winners._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_changes_on_a_hot_key(spark):
    target = spark.createDataFrame([("hot", "old"), ("kept", "old")], "k string, v string")
    changes = sightings(spark).select(F.col("posting_id").alias("k"), F.col("id").cast("string").alias("v"),
                                      F.lit("UPSERT").alias("op"), "id")
    out = merge.apply_changes(target, changes, ["k"], [F.desc("id")])
    assert out.count() == 2 + 2 * N // 3
    assert {r.k: r.v for r in out.filter("k in ('hot', 'kept')").collect()} == {"hot": str(N - 3), "kept": "old"}


def test_counts_and_rules_on_a_hot_key(spark):
    rows = sightings(spark).withColumn("company", F.when(F.col("id") % 3 == 0, "hot").otherwise("other"))
    counts = {r.company: r.total_postings for r in activity(
        rows, "company", "id", "seen_at", "seen_at", date(2024, 1, 2), 3).collect()}
    assert counts == {"hot": N // 3, "other": 2 * N // 3}
    found = {r.rule_name: r.rows_affected for r in report(
        rows.withColumn("day", F.to_date("seen_at")), "posting_id", ("body",), "day", as_of=date(2024, 1, 1)).collect()}
    assert found["duplicate_posting_ids"] == 1 and found["zero_postings"] == N
    assert found["future_date_posted"] == N - 86_400
