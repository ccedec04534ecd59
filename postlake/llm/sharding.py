"""Balanced label propagation: linked documents share shards, shards stay even.

Rows that share a link are neighbours.  Linked rows start on a shard by hash and then
move, round after round, to the shard where most of their neighbours' bytes are, as far as
that shard has room.  Rows without links are dealt last and make all shards even.  Only
Spark's own functions are used; the driver sees sums per shard and per bucket (a fixed
number of each), never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postlake.llm.common import ranked, stored

SLACK = 1.02  # how far propagation may overfill a shard; made even afterwards
BUCKETS = 1024
SALTS = 256
FINE = 0.15  # share of the free bytes, in the smallest rows, kept back to even out the rest


def picked(values: list[float], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), index + 1)


def loads(rows: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["bytes"] for r in rows.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    return [int(found.get(s) or 0) for s in range(shards)]


def propagate(members: DataFrame, shards: int, capacity: float, rounds: int) -> DataFrame:
    """``row, size, shard`` of all linked rows.

    ``members`` has ``row, size, link``, a row once for each of its links.  Each round
    tallies bytes by link and shard (added up before the shuffle, so a link of a third of
    all rows is a few numbers), lets each link name its best shard with room, and moves the
    rows that live elsewhere.  If more want to move than fit, whole buckets of links move.
    """
    members = stored(members.withColumn("shard", F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int")), "labels")
    for _ in range(rounds):
        now = loads(members.groupBy("row").agg(F.first("size").alias("size"), F.first("shard").alias("shard")), shards)
        full = [load >= capacity * 0.98 for load in now]
        has_room = picked([0.0 if f else 1.0 for f in full], F.col("shard")) > 0
        tally = members.groupBy("link", "shard").agg(F.sum("size").alias("bytes"))
        weight = F.struct(F.col("bytes"), F.xxhash64("link", "shard"))
        best = tally.groupBy("link").agg(
            F.sum("bytes").alias("group_bytes"), F.max_by("shard", weight).alias("first"),
            F.max_by("shard", F.when(has_room, weight)).alias("open"), F.max("bytes").alias("most"))
        best = best.withColumn("target", F.when(picked([0.0 if f else 1.0 for f in full], F.col("first")) > 0, F.col("first"))
                               .otherwise(F.col("open"))).where("target is not null")
        giant = F.col("group_bytes") > capacity / 8
        wish = (members.join(best, "link")
                .where((F.col("shard") != F.col("target")) & ~(giant & ~has_room)
                       & ~(~giant & ~has_room & (F.col("most") == F.col("group_bytes"))))
                .groupBy("row").agg(
                    F.first("size").alias("size"), F.max_by("target", F.struct("most", "link")).alias("target"),
                    F.max_by(F.when(giant, F.xxhash64("row")).otherwise(F.xxhash64("link")), F.struct("most", "link")).alias("by"))
                .withColumn("bucket", F.pmod("by", F.lit(BUCKETS)).cast("int")))
        wish = stored(wish.select("row", "size", "target", "bucket"), "moves")
        wanted = wish.groupBy("target", "bucket").agg(F.sum("size").alias("bytes")).collect()  # shards x BUCKETS at most
        if not wanted:
            break
        cuts = []
        for s in range(shards):
            room, cut = capacity - now[s], 0
            for r in sorted((r for r in wanted if r["target"] == s), key=lambda r: r["bucket"]):
                if r["bytes"] > room:
                    break
                room -= r["bytes"]
                cut = r["bucket"] + 1
            cuts.append(cut)
        if not any(cuts):
            break
        moved = wish.where(F.col("bucket") < picked(cuts, F.col("target"))).select("row", "target")
        members = stored(members.join(moved, "row", "left")
                         .withColumn("shard", F.coalesce("target", "shard")).drop("target"), "labels")
    return members.groupBy("row").agg(F.first("size").alias("size"), F.first("shard").alias("shard"), F.min("link").alias("link"))


def by_share(rows: DataFrame, room: list[float], classes: Column) -> DataFrame:
    """Rows cut, inside each class, into stretches of bytes in proportion to ``room``.

    A row's place among the bytes of its class comes from sums per salt and a running sum
    inside its salt, so no class has to meet in one task.
    """
    keyed = rows.withColumn("_class", classes).withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    sums = keyed.groupBy("_class", "_salt").agg(F.sum("size").alias("_bytes"))
    ahead = Window.partitionBy("_class").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.withColumn("_before", F.coalesce(F.sum("_bytes").over(ahead), F.lit(0)))
            .withColumn("_all", F.sum("_bytes").over(Window.partitionBy("_class"))).drop("_bytes"))
    inside = Window.partitionBy("_class", "_salt").orderBy(F.col("size").desc(), "row")
    total = sum(max(r, 0.0) for r in room) or 1.0
    cuts, run = [], 0.0
    for r in room[:-1]:
        run += max(r, 0.0) / total
        cuts.append(run)
    placed = (keyed.withColumn("_run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .join(sums, ["_class", "_salt"])
              .withColumn("_at", (F.col("_before") + F.col("_run") - F.col("size") / 2) / F.col("_all")))
    shard = sum((F.when(F.col("_at") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)) if cuts else F.lit(0)
    return placed.withColumn("shard", shard.cast("int")).select("row", "size", "shard")


def even(rows: DataFrame, kept: DataFrame, free: DataFrame, shards: int) -> DataFrame:
    """``row, shard`` of all rows: ``kept`` stay unless their shard overflows, ``free`` fill up.

    Free rows are dealt by size class in proportion to the room left; the smallest ones
    come last and even out what is left over.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    goal = total / shards
    now = loads(kept, shards)
    if any(load > goal for load in now):  # release whole links from overfull shards
        cut = [min(1.0, 1.05 * (load - goal) / load) if load > goal else 0.0 for load in now]
        release = (F.pmod(F.xxhash64("link", F.lit("release")), F.lit(1 << 20)) / float(1 << 20)) < picked(cut, F.col("shard"))
        kept = stored(kept.withColumn("_free", release), "kept")
        free = free.unionByName(kept.where("_free").select("row", "size"))
        kept = kept.where("not _free").drop("_free")
        now = loads(kept, shards)
        if any(load > goal for load in now):  # links too large to release whole
            cut = [min(1.0, 1.02 * (load - goal) / load) if load > goal else 0.0 for load in now]
            release = (F.pmod(F.xxhash64("row", F.lit("release")), F.lit(1 << 20)) / float(1 << 20)) < picked(cut, F.col("shard"))
            kept = stored(kept.withColumn("_free", release), "kept")
            free = free.unionByName(kept.where("_free").select("row", "size"))
            kept = kept.where("not _free").drop("_free")
            now = loads(kept, shards)
    sizes = free.groupBy(F.expr("cast(log2(size) * 2 as int)").alias("class")).agg(F.sum("size").alias("bytes")).collect()
    least, run = 0, 0
    for r in sorted(sizes, key=lambda r: r["class"]):
        run += r["bytes"]
        least = r["class"]
        if run >= FINE * sum(x["bytes"] for x in sizes):
            break
    size_class = F.expr("cast(log2(size) * 2 as int)")
    coarse = stored(by_share(free.where(size_class > least), [goal - load for load in now], size_class), "coarse")
    now = [a + b for a, b in zip(now, loads(coarse, shards))]
    fine = by_share(free.where(size_class <= least), [goal - load for load in now], F.lit(0))
    return kept.select("row", "shard").unionByName(coarse.select("row", "shard")).unionByName(fine.select("row", "shard"))


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 6, links: DataFrame | None = None,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: shards of near equal bytes that keep linked rows together.

    Rows of equal text are linked; ``links`` (``doc_id, link``) adds further links, many
    per row if need be.  A size is the text's UTF-8 bytes plus one.  A link larger than a
    shard is split over as few as have room.  Null texts have no bytes and no link, null
    keys no further links; repeated rows are placed each; an empty table gives no rows;
    other columns are ignored.
    """
    value = docs[text].cast("string")
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(value.isNotNull(), F.xxhash64(value)).alias("link")), "rows")
    members = rows.where("link is not null").select("row", "size", "link")
    if links is not None:
        more = links.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("link", F.lit("more")).alias("link"))
        members = members.unionByName(rows.select("row", "doc_id", "size").join(more, "doc_id").select("row", "size", "link"))
    shared = members.groupBy("link").agg(F.count("*").alias("_n")).where("_n > 1").select("link")
    members = stored(members.join(shared, "link").select("row", "size", "link"), "members")
    total = rows.agg(F.sum("size")).first()[0] or 0
    linked = stored(propagate(members, shards, SLACK * total / shards, rounds), "linked")
    free = rows.join(linked.select("row"), "row", "left_anti").select("row", "size")
    placed = stored(even(rows, linked, free, shards), "placed")
    return ranked(rows.join(placed, "row").select("row", "doc_id", "size", "text_crc32", "shard"),
                  F.col("shard"), ["row"], "slot").drop("row")
