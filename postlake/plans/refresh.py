"""A full refresh over the tables of a lake: land, stage, check, load, publish, archive, log.

A refresh moves only what changed.  Raw days since the last good run are normalised again, good
and refused rows in one write; the narrow sightings of all kept days are ranked; the postings
whose ranking changed are fetched and merged into the months and buckets they belong to.
"""

from __future__ import annotations

from contextlib import nullcontext
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.time import as_day, day, moment
from postlake.operators import dedup, dims, lifecycle, quality, runlog, tracking
from postlake.operators.merge import insert_missing
from postlake.operators.normalize import REFUSALS, judged
from postlake.plans import marts, star
from postlake.session import forget, little_disk, passing, setting, stored, tracked
from postlake.sources import archive, landing, schemas
from postlake.sources.snapshots import Snapshots, overwrite_touched
from postlake.sources.touched import BY_MONTH, BY_POSTING, Touched

GOOD, REFUSED = "good", "refused"
GOOD_SIZE = 1 << 20  # bytes of a raw file, on average, from which files need not be brought together
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "16")  # of one task; beyond, it sorts its rows by partition
NORMALIZED = (f"{schemas.TABLES['staging_postings_normalized'].replace('source_id string, ', '')}, "
              "payload string, digest string, reason string, fate string, source_id string, ingest_date date")


class Tables:
    """Snapshots for small tables, touched partitions for large ones, under one ``read``."""

    def __init__(self, snapshots: Snapshots, large: Touched):
        self.snapshots, self.large = snapshots, large
        self.commit, self.commit_all = snapshots.commit, snapshots.commit_all
        self.append, self.read_log = snapshots.append, snapshots.read_log

    def read(self, name: str) -> DataFrame:
        return self.large.read(name) if name in BY_MONTH + BY_POSTING else self.snapshots.read(name)

    def exists(self, name: str) -> bool:
        return self.large.exists(name) if name in BY_MONTH + BY_POSTING else self.snapshots.exists(name)


class Lake:
    """The tables of one lake and the steps that move them forward.

    A step that died can be run again: partitions are merged by key, and the ranking that
    says what was loaded is replaced last.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.large = Touched(spark, f"{self.root}/large", buckets)
        self.store = Tables(Snapshots(spark, f"{self.root}/tables"), self.large)
        self.raw_path = f"{self.root}/raw"
        self.normalized_path = f"{self.root}/normalized"
        self.archive_path = f"{self.root}/archive"

    def setup(self, as_of) -> None:
        """Create missing tables and put the seed rows in; safe to repeat."""
        self.store.snapshots.apply_schema(skip=BY_MONTH + BY_POSTING)
        for name, seed, key in (
            ("dim_source", schemas.seed_sources(self.spark), "source_id"),
            ("app_state", schemas.seed_app_state(self.spark, as_of), "state_key"),
        ):
            self.store.commit(name, insert_missing(self.store.read(name), seed, [key]))

    def land(self, rows: DataFrame) -> int:
        """Append landed rows to the raw folder, and return how many."""
        with little_disk(self.spark):
            return landing.append_raw(rows, self.raw_path)

    def raw(self) -> DataFrame:
        schema = f"{schemas.RAW}, source_id string, ingest_date date"
        return self.spark.read.schema(schema).parquet(self.raw_path)

    def normalized(self, fate: str = GOOD) -> DataFrame:
        return self.spark.read.schema(NORMALIZED).parquet(self.normalized_path).filter(F.col("fate") == fate)

    def refused(self) -> DataFrame:
        """Landed rows that are no postings: payload, source, time and reason."""
        return self.normalized(REFUSED).select("payload", "source_id", F.col("seen_at").alias("ingested_at"), "reason", "ingest_date")

    def marks(self) -> dict:
        """Per source the day of its last success in a run that did not fail later on."""
        log = self.store.read_log("pipeline_run_log")
        whole = log.filter((F.col("source") == "OVERALL") & (F.col("status") != runlog.FAILED)).select("run_id").distinct()
        ended = (log.filter((F.col("status") == runlog.SUCCESS) & ~F.col("source").isin("OVERALL", "ARCHIVE", "RETENTION"))
                 .join(whole, "run_id", "left_semi").groupBy("source").agg(F.max("started_at").alias("mark")))
        return {r["source"]: as_day(r["mark"]) for r in ended.collect() if r["mark"]}  # one row a source

    def raw_since(self, marks: dict, as_of, retention_days: int) -> DataFrame:
        """Raw rows of the days from each source's mark on; of a source without one, of all kept days."""
        oldest = as_day(as_of) - timedelta(days=retention_days)
        start = F.lit(oldest)
        for source, mark in marks.items():
            start = F.when(F.col("source_id") == source, F.lit(max(mark, oldest))).otherwise(start)
        return self.raw().filter(F.col("ingest_date") >= start)

    def absorb(self, as_of, marks: dict | None = None, retention_days: int = V.RAW_RETENTION_DAYS) -> dict:
        """Normalise raw days again and replace their partitions; returns rows by outcome.

        Good and refused rows go to partitions of one write, counted while they are written.
        Raw files of good size are written again as they are cut, without a shuffle of all that
        is normalised; small ones are brought together by partition.
        """
        rows = judged(self.raw_since(marks or {}, as_of, retention_days), ("ingest_date",))
        fate = F.when(F.col("reason").isNull(), GOOD).otherwise(REFUSED)
        seen = Observation()
        counts = [F.count(F.when(F.col("reason") == reason, 1)).alias(reason) for reason in REFUSALS]
        counted = rows.observe(seen, F.count(F.when(F.col("reason").isNull(), 1)).alias(GOOD), *counts).withColumn("fate", fate)
        parts = ["fate", "source_id", "ingest_date"]
        whole = self.large.mean_file(self.raw_path) >= GOOD_SIZE
        counted = counted if whole else counted.hint("rebalance", *parts)
        with little_disk(self.spark), setting(self.spark, *OPEN_FILES) if whole else nullcontext():
            (counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*parts).parquet(self.normalized_path))
        return {name: int(n) for name, n in seen.get.items()}

    def stage(self, as_of, retention_days: int = V.RAW_RETENTION_DAYS, marks: dict | None = None) -> DataFrame:
        """Staging after a run, from the kept days; returns the rows that changed.

        Only the raw days since the marks are parsed; the ranking reads ids, digests, blocking
        keys and times.  Staging rows of postings that rank as before are not touched.
        """
        self.outcomes = self.absorb(as_of, marks, retention_days)
        kept = self.normalized().filter((F.col("ingest_date") >= day(as_of, retention_days)) & (F.col("seen_at") >= moment(as_of, retention_days)))
        seen = dedup.sightings(dedup.narrowed(kept, "seen_at", "ingest_date"), F.max("ingest_date").alias("home"))
        chosen = dedup.survivors(seen).select("posting_id", F.lower(F.hex("digest")).alias("digest"), "first_seen_at", "last_seen_at", "home")
        self.ranking = stored(chosen, "ranking")
        before = self.store.snapshots.read("staging_ranking").select(self.ranking.columns)
        with tracked() as narrow:
            changed = stored(self.ranking.join(before, self.ranking.columns, "left_anti"), "changed")
        gone = before.join(self.ranking, "posting_id", "left_anti").select("posting_id")
        homes = [r[0] for r in changed.select("home").distinct().collect()]  # days inside the window
        batch = stored(dedup.fetch(kept.filter(F.col("ingest_date").isin(homes)), changed).select(*schemas.columns("staging_postings")), "batch")
        self.replaced = stored(changed.select("posting_id").unionByName(gone), "replaced")
        forget(self.spark, narrow)
        self.replace_postings("staging_postings", batch)
        return batch

    def replace_postings(self, name: str, rows: DataFrame) -> None:
        """Put rows in for all rows of the postings that changed or went."""
        replaced = self.replaced
        self.large.rewrite(name, self.large.values(name, replaced),
                           lambda old: old.join(replaced, "posting_id", "left_anti").unionByName(rows))

    def check(self, run_id: str, as_of) -> None:
        rules = quality.report(self.store.read("staging_postings"), as_of=as_of)
        self.store.append("data_quality_log", quality.log_rows(rules, run_id, moment(as_of)))

    def load(self, batch: DataFrame, as_of) -> None:
        """Merge staged changes into the dimensions, and into the months and buckets they touch."""
        read, large = self.store.read, self.large
        staging = read("staging_postings")
        made = self.store.commit_all({
            "dim_company": star.refresh_companies(read("dim_company"), staging, as_of),
            "dim_location": dims.accumulate(read("dim_location"), dims.locations(staging), "location_id"),
            "dim_skill": schemas.seed_skills(self.spark),
        })
        with passing(self.spark):
            details = stored(star.staged_details(batch), "details")
            large.rewrite("job_posting_detail", large.values("job_posting_detail", details), lambda old: star.upsert_details(old, details))
        with passing(self.spark):
            self.replace_postings("fact_posting_skill_mention", stored(star.mentions(batch), "mentions"))
        with passing(self.spark):
            facts = stored(star.staged_facts(batch, made["dim_company"], made["dim_location"]), "facts")
            large.rewrite("fact_job_posting", large.values("fact_job_posting", facts), lambda old: star.upsert_facts(old, facts))
        self.store.commit("dim_date", dims.calendar(read("fact_job_posting"), "date_posted", as_of))
        self.store.commit("staging_ranking", self.ranking)
        self.store.snapshots.forget_old("staging_ranking")

    def set_profiles(self, changes: DataFrame) -> None:
        self.store.commit("user_profile", tracking.upsert_profiles(
            self.store.read("user_profile"), changes))

    def star(self) -> star.Star:
        read = self.store.read
        return star.Star(
            facts=read("fact_job_posting"), archive=read("fact_job_posting_archive"),
            details=read("job_posting_detail"), mentions=read("fact_posting_skill_mention"),
            companies=read("dim_company"), locations=read("dim_location"),
            skills=read("dim_skill"), dates=read("dim_date"),
            applications=read("applications"), hidden=read("hidden_jobs"),
            profiles=read("user_profile"))

    def archive(self, as_of, days: int = V.POSTING_RETENTION_DAYS, cold_only: bool = False) -> dict:
        """Archive and purge; the cold rows are written before anything is dropped.

        Months without a stale fact, and buckets without a posting that lost its last fact, keep
        their files.
        """
        with little_disk(self.spark), passing(self.spark):
            gold, large = self.star(), self.large
            known = archive.archived_ids(self.spark, self.archive_path)
            purge = lifecycle.archive_split(
                gold.facts, gold.archive, gold.companies, gold.locations, gold.details, gold.mentions,
                known, as_of, days, cold_only)
            counts = purge.counts.first().asDict()
            archive.append_archive(purge.encoded, self.archive_path)
            stale = stored(gold.facts.filter(lifecycle.is_stale(as_of, days)), "stale")
            lost = stored(stale.select("posting_id").distinct().join(
                gold.facts.filter(lifecycle.is_live(as_of, days)).select("posting_id"), "posting_id", "left_anti"), "lost")
            # The archive table takes the stale rows before the live tables let go of them.
            if cold_only:
                large.rewrite("fact_job_posting_archive", [r[0] for r in large.parts("fact_job_posting_archive").select(
                    large.column("fact_job_posting_archive")).distinct().collect()], lambda old: old.limit(0))
            else:
                stamped = stale.select("*", moment(as_of).alias("archived_at"), lifecycle.archive_reason(as_of, F.col("closing_date")).alias("archive_reason"))
                large.rewrite("fact_job_posting_archive", large.values("fact_job_posting_archive", stale),
                              lambda old: old.unionByName(lifecycle.not_archived(stamped, old).select(*old.columns)))
            for name in ("job_posting_detail", "fact_posting_skill_mention"):
                large.rewrite(name, large.values(name, lost), lambda old: old.join(lost, "posting_id", "left_anti"))
            large.rewrite("fact_job_posting", large.values("fact_job_posting", stale), lambda old: old.filter(lifecycle.is_live(as_of, days)))
            return counts

    def clean_raw(self, run_id: str, as_of, days: int = V.RAW_RETENTION_DAYS) -> dict:
        """Delete raw rows older than the window, and log how many of each source.

        Whole days are dropped as folders; only the day that the window cuts is written again.
        Normalised rows and refusals of dropped days go with them.
        """
        edge = as_day(as_of) - timedelta(days=days)
        _, dropped = lifecycle.retention_split(self.raw(), as_of, days, partition="ingest_date")
        counts = {r["source_id"]: int(r["rows_deleted"]) for r in dropped.collect()}  # one row a source
        at_edge = self.raw().filter(F.col("ingest_date") == F.lit(edge))
        old = F.coalesce(F.col("ingested_at") < moment(as_of, days), F.lit(False))
        mixed = [r[0] for r in at_edge.filter(old).select("source_id").distinct().collect()]
        cut = stored(at_edge.filter(F.col("source_id").isin(mixed) & ~old), "edge")
        overwrite_touched(self.spark, self.raw_path, cut, "source_id", "ingest_date")
        emptied = set(mixed) - {r[0] for r in cut.select("source_id").distinct().collect()}
        for path, fates in ((self.raw_path, ("",)), (self.normalized_path, (f"fate={GOOD}/", f"fate={REFUSED}/"))):
            for fate in fates:
                for source in self.large.children(f"{path}/{fate}"):
                    gone = [d for d in self.large.children(f"{path}/{fate}{source}") if d.startswith("ingest_date=")
                            and (d[12:] < str(edge) or (d[12:] == str(edge) and not fate and source.partition("=")[2] in emptied))]
                    self.large.drop(f"{path}/{fate}{source}", gone)
        rows = [(run_id, f"RETENTION {source}", runlog.SUCCESS, n) for source, n in sorted(counts.items())]
        log = self.spark.createDataFrame(rows, "run_id string, source string, status string, rows_written bigint")
        self.store.append("pipeline_run_log", log.withColumns({"started_at": moment(as_of), "ended_at": moment(as_of)}))
        return counts

    def refresh(self, run_id: str, attempts: DataFrame, as_of,
                archive_days: int = V.POSTING_RETENTION_DAYS, retention_days: int = V.RAW_RETENTION_DAYS) -> str:
        """All steps after landing; returns the run's status.

        ``attempts`` has a row per board tried: source, ok, rows, started_at,
        ended_at.  With no source landed the later steps are skipped; the log is
        written in every case.
        """
        with little_disk(self.spark), passing(self.spark):
            outcomes = stored(runlog.source_outcomes(  # one row a source; attempts may be a count over all landed rows
                attempts, "source", F.col("ok"), F.col("rows"), "started_at", "ended_at"), "outcomes")
            landed = not outcomes.filter(F.col("status") == runlog.SUCCESS).isEmpty()
            ok, failure = True, None
            try:
                if landed:
                    with passing(self.spark):  # the ranking, the batch and the ids replaced
                        batch = self.stage(as_of, retention_days, self.marks())
                        self.check(run_id, as_of)
                        self.load(batch, as_of)
                    counts = self.archive(as_of, archive_days)
                    marts.publish(self.star(), as_of)
                    self._log_archive(run_id, counts, as_of)
            except Exception as error:  # the run must be logged as failed, then the cause raised
                ok, failure = False, error
            log = runlog.run_log(outcomes, run_id, ok)
            self.store.append("pipeline_run_log", log.select(*schemas.columns("pipeline_run_log")))
            if failure is not None:
                raise failure
            return log.filter(F.col("source") == "OVERALL").first()["status"]

    def _log_archive(self, run_id: str, counts: dict, as_of) -> None:
        row = self.spark.createDataFrame(
            [(run_id, "ARCHIVE", runlog.SUCCESS, int(counts["encoded_count"]))],
            "run_id string, source string, status string, rows_written bigint")
        self.store.append("pipeline_run_log", row.withColumns(
            {"started_at": moment(as_of), "ended_at": moment(as_of)}))
