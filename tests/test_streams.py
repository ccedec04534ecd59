import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from postlake.operators import merge
from postlake.session import scratch_path
from postlake.sources.snapshots import Snapshots
from postlake.streaming import streams

SCHEMA = "id int, who string, at timestamp"
START = datetime(2024, 1, 1)


def write_batches(spark, path, *batches):
    for i, batch in enumerate(batches):
        (spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").json(path))


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(path)


def done(query):
    query.awaitTermination()
    assert query.exception() is None


def test_repeats_are_dropped_across_batches(spark):
    path, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    day = [(i, "a", START + timedelta(days=i)) for i in range(5)]
    write_batches(spark, path, day[:3], day[1:], day)
    done(streams.sink_append(streams.drop_repeats(stream(spark, path), ["id"], "at"), out, mark))
    # A stream restarted from its checkpoint takes only what is new.
    write_batches(spark, path, [(4, "a", START), (7, "a", START + timedelta(days=7))])
    done(streams.sink_append(streams.drop_repeats(stream(spark, path), ["id"], "at"), out, mark))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 7]


def test_upserts_equal_the_batch_result_and_replays_change_nothing(spark):
    path, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    store = Snapshots(spark, scratch_path(spark, "tables"))
    rows = [(i, "abc"[i % 3], START + timedelta(hours=i)) for i in range(12)]
    write_batches(spark, path, rows[6:], rows[:3], rows[3:6])           # not in order of time

    def per_who(df):
        return df.groupBy("who").agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))

    rules = {"last": merge.greatest, "n": lambda t, s: t + s}
    store.commit("who", per_who(spark.createDataFrame([], SCHEMA)))
    store.commit("who", store.read("who"))   # the table has commits of its own, as many as the stream has batches
    store.commit("who", store.read("who"))
    done(streams.upsert_stream(stream(spark, path), store, "who", ["who"], rules, mark, prepare=per_who))
    want = sorted(tuple(r) for r in per_who(spark.createDataFrame(rows, SCHEMA)).collect())
    assert sorted(tuple(r) for r in store.read("who").collect()) == want
    # A batch whose commit is done is not applied again.
    name = streams.stream_id(spark, mark)
    last = store.last_batch("who", name)
    replay = merge.merge_upsert(store.read("who"), per_who(spark.createDataFrame(rows[:3], SCHEMA)), ["who"], rules)
    store.commit("who", replay, batch=(name, last))
    assert sorted(tuple(r) for r in store.read("who").collect()) == want


def test_daily_counts_drop_late_rows(spark):
    path, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    store = Snapshots(spark, scratch_path(spark, "tables"))
    # The watermark a batch filters by is the one reached two batches before it.
    write_batches(spark, path, [(1, "a", START)], [(2, "a", START + timedelta(days=5))],
                  [(4, "a", START + timedelta(days=5, hours=1))], [(3, "a", START)])
    store.commit("daily", spark.createDataFrame([], "day date, who string, n bigint"))
    counts = streams.daily_counts(stream(spark, path), "at", ["who"], "1 day")
    done(streams.upsert_stream(counts, store, "daily", ["day", "who"], {"n": merge.take_source}, mark, mode="update"))
    assert sorted((str(r.day), r.n) for r in store.read("daily").collect()) == [("2024-01-01", 1), ("2024-01-06", 2)]


def test_landing_stream_keeps_the_payload(spark):
    from postlake.sources.landing import stamp
    path, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    write_batches(spark, path, [(1, "a", START)], [(2, "b", START)])
    records = stream(spark, path).select("id", F.col("who").alias("source_id"))
    done(streams.land_stream(stamp(records, "run", START), out, mark))
    back = {r.source_id: json.loads(r.payload)["id"] for r in spark.read.parquet(out).collect()}
    assert back == {"a": 1, "b": 2}


def test_fact_stream_equals_one_batch_merge(spark):
    from datetime import date
    from postlake.plans.star import upsert_facts
    from postlake.sources.schemas import TABLES, columns, empty
    from postlake.sources.snapshots import month_partition
    schema = TABLES["fact_job_posting"]

    def fact(i, posted, seen, family="DE", incomplete=False):
        at = START + timedelta(days=seen)
        return (f"p{i}", "c", "l", "s", "t", family, posted, None, at, at, incomplete)

    first = [fact(1, date(2024, 1, 5), 1), fact(2, None, 1), fact(3, date(2024, 2, 5), 1)]
    second = [fact(1, date(2024, 1, 5), 4, "BI", True), fact(2, None, 3), fact(4, date(2024, 3, 1), 4), fact(4, date(2024, 3, 1), 5)]
    path, landed, mark = (scratch_path(spark, n) for n in ("facts", "in", "mark"))
    keep = spark.createDataFrame([fact(9, date(2023, 12, 1), 0)], schema)
    keep.withColumn("posted_month", month_partition("date_posted")).write.partitionBy("posted_month").parquet(path)
    for batch in (first, second):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landed)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    done(streams.fact_stream(source, path, mark))
    got = sorted((tuple(r) for r in spark.read.parquet(path).select(*columns("fact_job_posting")).collect()), key=repr)
    want = upsert_facts(upsert_facts(keep, spark.createDataFrame(first, schema)), spark.createDataFrame(second[:2] + second[3:], schema))
    # The first batch's two sightings of p4 are one staged row, the later one.
    assert got == sorted((tuple(r) for r in want.collect()), key=repr)
    assert empty(spark, "fact_job_posting").columns == columns("fact_job_posting")


def test_a_fresh_checkpoint_is_another_stream(spark):
    path = scratch_path(spark, "in")
    store = Snapshots(spark, scratch_path(spark, "tables"))
    write_batches(spark, path, [(1, "a", START)], [(2, "b", START)])
    store.commit("who", spark.createDataFrame([], "who string, at timestamp"))
    for _ in range(2):
        mark = scratch_path(spark, "mark")
        done(streams.upsert_stream(stream(spark, path).select("who", "at"), store, "who", ["who"],
                                   {"at": merge.greatest}, mark))
        assert store.last_batch("who", streams.stream_id(spark, mark)) == 1
    assert sorted(r.who for r in store.read("who").collect()) == ["a", "b"] and store.current("who") == 5
