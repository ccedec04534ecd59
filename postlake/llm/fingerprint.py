"""Bottom-k sketches of word shingles, with Spark's own functions only.

A document's shingles are its runs of ``width`` words (all words as one shingle if there
are fewer; none without words).  Its sketch is the sorted array of the ``k`` smallest
distinct 64-bit hashes.  Sketches of parts merge into the sketch of the whole, and two
sketches estimate resemblance, containment and distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postlake.llm.common import shuffle_width

WIDTH, K = 5, 128
BLANKS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SPAN = 2.0 ** 64  # number of hash values


def sketch(text: Column, width: int = WIDTH, k: int = K) -> Column:
    """The sketch of one text; null and empty texts have an empty one.

    The array of words holds one text at a time, so memory is bounded by the longest row.
    """
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), SPACES)

    def smallest(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1))),
                           lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(width)]))
        return F.when((F.size(w) == 1) & (w[0] == ""), F.array().cast("array<bigint>")).otherwise(
            F.slice(F.sort_array(F.array_distinct(runs)), 1, k))

    return F.transform(F.array(words), smallest)[0]


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold.

    Exact when both sketches are shorter than ``k``; two empty ones are alike.
    """
    def share(union: Column) -> Column:
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union))
    return F.transform(F.array(merge(a, b, k)), share)[0].cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    last = F.element_at(a, -1).cast("double") + SPAN / 2
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (last / SPAN))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second holds, too."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def shown(a: Column) -> Column:
    """A sketch as text: its hashes as 16 hexadecimal digits each, smallest first."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def fingerprints(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """``doc_id, sketch, n_shingles`` of every whole text.

    Null texts count as empty (no shingle, empty sketch); null keys and repeated rows are
    sketched each; an empty table gives no rows; other columns are ignored.
    """
    made = docs.select("doc_id", sketch(F.col("text"), width, k).alias("sketch"))
    return made.withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def blocks(docs: DataFrame, key: str, count: int) -> tuple[list[int], Column]:
    """Split points of ``key`` into about ``count`` even ranges, and each row's range.

    The split points are keys that occur, ``count`` of them at most whatever the size of
    the table; a range is found by two short searches.
    """
    points = docs.where(F.col(key).isNotNull()).stat.approxQuantile(
        key, [i / count for i in range(count)], 1 / (4 * count))
    splits = sorted({int(p) for p in points})[1:]
    step = max(1, int(len(splits) ** 0.5))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda s: s <= F.col(key)))

    if not splits:
        return splits, F.lit(0)
    all_points = F.array(*[F.lit(s) for s in splits])
    heads = F.array(*[F.lit(s) for s in splits[::step]])
    block = (below(heads) - 1) * step
    inside = F.when(block < 0, F.lit(0)).otherwise(
        block + below(F.slice(all_points, F.greatest(block, F.lit(0)) + 1, F.lit(step))))
    return splits, F.coalesce(inside, F.lit(0))  # a null key sorts first


def with_next(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """``doc_id, text, sketch`` and the ``next_text, next_sketch`` of the row after it, by ascending ``doc_id``.

    The last row is followed by the first.  Rows are dealt by range of ``doc_id``, once,
    and sketched there; the first row of a range is also sent, as a guest, to the range
    before it.  Ties go by text; null keys come first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    splits, block = blocks(rows, "doc_id", 4 * shuffle_width(docs.sparkSession))
    first = rows.agg(F.min("doc_id"), F.sum(F.col("doc_id").isNull().cast("long"))).first()
    lowest = F.col("doc_id").isNull() if first[1] else F.col("doc_id") == F.lit(first[0])
    last = len(splits)
    starts = F.col("doc_id").isin(splits) if splits else F.lit(False)
    dealt = (rows.withColumn("_block", block)
             .withColumn("_to", F.explode(F.array_compact(F.array(
                 F.struct(F.col("_block").alias("block"), F.lit(0).alias("guest")),
                 F.when(starts, F.struct((F.col("_block") - 1).alias("block"), F.lit(1).alias("guest"))),
                 F.when(lowest, F.struct(F.lit(last).alias("block"), F.lit(2).alias("guest")))))))
             .select("doc_id", "text", "_to.block", "_to.guest")
             .repartition("block").withColumn("sketch", sketch(F.col("text"), width, k)))
    order = Window.partitionBy("block").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return (dealt.withColumn("next_text", F.lead("text").over(order))
            .withColumn("next_sketch", F.lead("sketch").over(order))
            .where("guest = 0").select("doc_id", "text", "sketch", "next_text", "next_sketch"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many first characters of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))
