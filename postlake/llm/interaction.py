"""What each of five text filters removes, in every order they can be applied in.

A document's mask says which filters it fails.  Every mask has a big integer whose fields hold
the outcomes of all 600 steps (120 orders of five filters): kept after the step, removed by it,
removed before although it fails, and removed with a label.  These integers are summed per part
inside the tasks, then over them, and unpacked at the end.  A field has 64 bits, so no sum of
fewer than 2^63 documents runs into the next field.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postlake.llm.common import map_batches, shipped, shuffle_width, stored

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
SHAPE = (len(OUTCOMES), len(ORDERS), len(FILTERS))
FIELD = 8  # bytes
WIDE = FIELD * int(np.prod(SHAPE))
LIVE = 256  # parts whose sums a task holds before it passes them on
SALTS = 64

UPPER, CONTINUATION = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
MARKS = b"#$%&*|"

MEASURED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.StringType()),
                         T.StructField("digest", T.BinaryType()), T.StructField("mask", T.IntegerType())])
SUMS = T.StructType([T.StructField("part", T.StringType()), T.StructField("salt", T.IntegerType()), T.StructField("counters", T.BinaryType())])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())]
                     + [T.StructField(name, T.LongType()) for name in COUNTS])


def failed(text: bytes) -> int:
    """The mask of filters A to D (bit 0 to 3) that a UTF-8 text fails.

    A: under 100 words; B: under 80 % of the words distinct; C: over 10 % of the code points
    in A-Z; D: one of MARKS in it.  An empty text fails A only.
    """
    words = text.split()  # bytes are cut at ASCII white space
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * capitals > 10 * points) << 2
            | (len(text.translate(None, MARKS)) < len(text)) << 3)


@cache
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The integer of a mask: a one in the field of each outcome of each step, zeros elsewhere."""
    fields = np.zeros(SHAPE, dtype="<u8")
    for i, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            removed = fails and not gone
            fields[:, i, step] = (not fails and not gone, removed, fails and gone, removed and good, removed and toxic)
            gone = gone or fails
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> dict[str, np.ndarray]:
    """The counts of a part, 120 x 5 each."""
    fields = np.frombuffer(total.to_bytes(WIDE, "little"), dtype="<u8").astype(np.int64).reshape(SHAPE)
    made = dict(zip(OUTCOMES, fields))
    place = np.array([[FILTERS.index(name) for name in order] for order in ORDERS])
    removed = made["removed"]
    shapley = np.array([removed[place == f].sum() for f in range(len(FILTERS))])
    alone = np.array([removed[np.flatnonzero(place[:, -1] == f)[0], -1] for f in range(len(FILTERS))])  # what only the last filter finds
    return made | {"shapley": shapley[place], "unique_fails": alone[place]}


def sums_in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One integer per part met in the task (or more, where a task meets more than LIVE parts)."""
    totals: dict[str, int] = {}
    salt = TaskContext.get().partitionId() % SALTS
    for batch in batches:
        for (part, *key), n in Counter(zip(*(c.to_pylist() for c in batch.columns))).items():
            totals[part] = totals.get(part, 0) + n * packed(*key)
            if len(totals) >= LIVE:
                yield sums_batch(totals, salt)
                totals = {}
    if totals:
        yield sums_batch(totals, salt)


def sums_batch(totals: dict[str, int], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.string()), pa.array([salt] * len(totals), pa.int32()),
         pa.array([total.to_bytes(WIDE, "little") for total in totals.values()], pa.binary())], schema=to_arrow_schema(SUMS))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int]]:
    """Part, salt and sum of consecutive rows of a part and salt; one integer is held at a time."""
    at, total = None, 0
    for batch in batches:
        for part, salt, counters in zip(*(c.to_pylist() for c in batch.columns)):
            if at is not None and at != (part, salt):
                yield *at, total
                total = 0
            at, total = (part, salt), total + int.from_bytes(counters, "little")
    if at is not None:
        yield *at, total


def sums_of_salts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _, total in runs(batches):
        yield sums_batch({part: total}, 0)


def steps_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    orders = [order for order in ORDERS for _ in FILTERS]
    for part, _, total in runs(batches):
        made = unpacked(total)
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(orders), pa.string()), pa.array(orders, pa.string()), pa.array(steps)]
                                         + [pa.array(made[name].ravel()) for name in COUNTS], schema=to_arrow_schema(AUDIT))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of documents.

    ``docs`` has ``doc_id``, ``text`` and the column ``part``; ``labels`` has ``doc_id``,
    ``quality`` and ``toxic``.  Filter E fails a text that equals the text of a smaller
    ``doc_id`` anywhere in the table (rows without an id are neither smaller nor larger, so they
    pass; repeated rows of one id are no copies of each other).  Null texts count as empty, a null
    part as the empty string; an id labelled more than once has a label if any of its rows has it;
    rows without an id have none.  Other columns are ignored; an empty table gives no rows.
    """
    def measure(keys, texts, parts):
        whole = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        return {"doc_id": keys, "part": parts, "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in whole],
                "mask": [failed(t) for t in whole]}

    shipped(docs.sparkSession)
    rows = stored(map_batches(docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.col(part).cast("string"), F.lit(""))), measure, MEASURED), "masks")
    first = (rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))  # joined by id and digest: the rows of a common text have different ids
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    named = rows.where("doc_id is not null").join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    masks = named.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    masks = masks.unionByName(rows.where("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    width = shuffle_width(docs.sparkSession)
    salted = masks.mapInArrow(sums_in_tasks, SUMS).repartition(width, "part", "salt").sortWithinPartitions("part", "salt")
    whole = salted.mapInArrow(sums_of_salts, SUMS).repartition(width, "part").sortWithinPartitions("part")
    return whole.mapInArrow(steps_of_parts, AUDIT)
