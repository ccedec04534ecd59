"""Removal of repeated runs of words by winnowing.

Words are cut at white space, wherever the newlines are.  A window is any ``words`` words in
a row.  Each window selects the least hash of the GRAM-word runs inside it (the last of
equal ones) as its anchor, so equal windows have an equal anchor at an equal place, and
neighbouring windows mostly share one: an anchor stands for a range of windows, and its
stretch is all the words of these.  Anchors whose hash occurs more than once are compared by
whole stretches first: a stretch that occurred earlier has only repeated windows.  What is
left where a repeat begins and ends is compared window by window, that is word by word.
The words of all windows that occurred earlier go; the earliest occurrence of each stays.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import forget, fresh, map_batches, numbered, shipped, stored, tracked
from postlake.llm.neardup import chunks
from postlake.llm.shingles import mixed, word_hashes

WORDS = 50
GRAM = 20  # words of an anchor
BASE = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WORD = re.compile(r"\S+")
#: UTF-8 of the white space beyond ASCII that ends a word.
WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
WIDE_LEADS = sorted({space[:2] for space in WIDE_SPACES})
NARROW_SPACES = bytes(32 if 0x1C <= b <= 0x1F else b for b in range(256))
ANCHORS = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                        T.StructField("print", T.LongType()), T.StructField("content", T.LongType()),
                        T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
WINDOWS = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                        T.StructField("content", T.LongType()), T.StructField("start", T.IntegerType())])


def spaced(text: bytes) -> bytes:
    """The text with ASCII spaces for all other white space, byte for byte."""
    text = text.translate(NARROW_SPACES)
    if any(lead in text for lead in WIDE_LEADS):
        for space in WIDE_SPACES:
            text = text.replace(space, b" " * len(space))
    return text


class Rolling:
    """Words of some texts, one after the other, with hashes of any run of words.

    ``first`` is the place of each text's first word (and the end), ``owner`` the text of each word.
    """

    def __init__(self, texts: list[bytes]):
        hashes, self.owner = word_hashes(texts)
        n = len(hashes)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.owner, minlength=len(texts)))])
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)
        self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n], dtype=np.uint64)])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words from each start to before each end, the same wherever they are."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverses[starts])


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (the last of equal ones) among each ``width`` values in a row."""
    places, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)  # ranges of ``have`` values, ``step`` apart, together hold have + step
        left, right = places[:-step], places[step:]
        places = np.where(values[right] <= values[left], right, left)
        have += step
    return places


def anchors(rolling: Rolling, words: int) -> tuple[np.ndarray, ...]:
    """Text, hash, stretch hash, first and last window (counted inside the text) of each anchor."""
    gram = min(GRAM, words)
    n = len(rolling.owner)
    starts = np.arange(max(0, n - words + 1))
    starts = starts[rolling.owner[starts] == rolling.owner[starts + words - 1]] if len(starts) else starts
    if not len(starts):
        return (np.zeros(0, dtype=np.int64),) * 5
    places = np.arange(n - gram + 1)
    grams = rolling.runs(places, places + gram)
    at = least_places(grams, words - gram + 1)[starts]
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    lo, hi = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    at, owner = at[new], rolling.owner[starts[new]]
    content = mixed(rolling.runs(lo, hi + words) + (hi - lo).astype(np.uint64) * np.uint64(0x100000001B3) + (at - lo).astype(np.uint64))
    return owner, grams[at], content, lo - rolling.first[owner], hi - rolling.first[owner]


def repeats(docs: DataFrame, words: int) -> DataFrame:
    """``row, spans``: the runs of words (first, last) that repeat an earlier run, in order.

    ``docs`` has ``row`` (unique), ``doc_id`` and ``text``; earlier means by ``doc_id``
    (nulls first), ``row`` and place.
    """
    def read(rows, keys, texts):
        parts = []
        texts = [spaced(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        for begin, end in chunks(texts):
            owner, *rest = anchors(Rolling(texts[begin:end]), words)
            parts.append((owner + begin, *rest))
        owner, prints, content, lo, hi = (np.concatenate(p) for p in zip(*parts))
        held = pa.array(owner)
        return {"row": rows.take(held), "doc_id": keys.take(held), "print": prints.view(np.int64), "content": content.view(np.int64),
                "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)}

    # Tables of one row per key are written before the join by that key, which Spark can then split where the key is common.
    with tracked() as made:
        found = stored(map_batches(docs.select("row", "doc_id", "text"), read, ANCHORS), "anchors")
        shared = stored(found.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"), "shared")
        hits = stored(found.join(shared, "print"), "hits")
        order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "row", F.col("lo").alias("at"))
        first = stored(hits.groupBy("content").agg(F.min(order).alias("first")).select(
            "content", F.col("first.row").alias("first_row"), F.col("first.at").alias("first_at")), "first")
    marked = stored(hits.join(first, "content").select("row", "doc_id", "print", "lo", "hi", (
        (F.col("row") != F.col("first_row")) | (F.col("lo") >= F.col("first_at") + words)).alias("later")), "marked")
    forget(docs.sparkSession, made)  # all that is read of them from here on is in ``marked``
    whole = marked.where("later").select("row", F.col("lo").alias("first"), (F.col("hi") + words - 1).alias("last"))

    edges = marked.where("not later").select("row", "print", "lo", "hi")
    several = stored(edges.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"), "several")
    ranges = edges.join(several, "print").groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))  # of one document

    def expand(rows, keys, texts, ranges):
        held, contents, places = [], [], []
        texts, ranges = [spaced(t) for t in texts.cast(pa.binary()).to_pylist()], ranges.to_pylist()
        for begin, end in chunks(texts):
            rolling = Rolling(texts[begin:end])
            for i in range(begin, end):
                starts = np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in ranges[i]])
                at = starts + rolling.first[i - begin]
                held.append(np.full(len(starts), i))
                contents.append(rolling.runs(at, at + words))
                places.append(starts)
        held = pa.array(np.concatenate(held))
        return {"row": rows.take(held), "doc_id": keys.take(held), "content": np.concatenate(contents).view(np.int64),
                "start": np.concatenate(places).astype(np.int32)}

    opened = docs.join(ranges, "row").select("row", "doc_id", "text", "ranges")
    each = stored(map_batches(opened, expand, WINDOWS), "windows")
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "row", "start")
    first = stored(each.groupBy("content").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
                   .select("content", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")), "first")
    later = each.join(first, "content").where((F.col("row") != F.col("first_row")) | (F.col("start") >= F.col("first_start") + words))
    spans = whole.union(later.select("row", F.col("start").alias("first"), (F.col("start") + words - 1).alias("last")))
    gathered = spans.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))  # of one document

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])))])

    def cover(rows, spans):
        return {"row": rows, "spans": [merged([(s["first"], s["last"]) for s in one]) for one in spans.to_pylist()]}

    return map_batches(gathered, cover, schema)


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    """The same words as runs that neither overlap nor touch."""
    out: list[dict] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def cut(text: str | None, spans: list[dict] | None) -> tuple[str | None, list[int] | None]:
    """The text without the runs of words, and the places of the lines that lost all their words.

    A line that keeps a word stays without the words (and the white space after them, or
    before them at its end); lines without words stay.
    """
    if text is None or not spans:
        return text, None
    gone, n = iter(spans), 0  # n: words before
    span = next(gone)
    out, removed = [], []
    for place, line in enumerate(text.split("\n")):
        words, keep = list(WORD.finditer(line)), []
        for _ in words:
            while span is not None and span["last"] < n:
                span = next(gone, None)
            keep.append(span is None or n < span["first"])
            n += 1
        if all(keep):
            out.append(line)
        elif not any(keep):
            removed.append(place)
        else:
            parts, at = [], 0
            for i, word in enumerate(words):
                if not keep[i]:
                    parts.append(line[at:word.start()])
                    at = words[i + 1].start() if i + 1 < len(words) else word.end()
            made = "".join(parts) + line[at:]
            out.append(made if keep[-1] else made.rstrip())
    return "\n".join(out), removed


def dedup_lines(docs: DataFrame, words: int = WORDS, spans: str = "_spans", removed: str = "_removed") -> DataFrame:
    """The documents without repeated runs of words, with ``_removed`` and ``_spans``.

    ``_spans`` are the runs of words that went (first and last, counted from 0), ``_removed``
    the places of the lines that went whole; both are null if nothing went; other names for them
    are arguments, for tables that have such columns.  All rows stay,
    with their columns; ``text`` is cut.  Null and empty texts stay as they are; texts of
    fewer words than ``words`` have no window; null keys count as earliest, repeated rows as
    later copies; an empty table gives no rows.  Rows are told apart by their place in
    their file (anything but a plain Parquet table is written first).
    """
    shipped(docs.sparkSession)
    row = fresh(docs, "_row")
    rows = numbered(docs, row)
    gone = repeats(rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), words)
    joined = (rows.join(gone.select(F.col("row").alias(row), F.col("spans").alias(spans)), row, "left").drop(row)
              .withColumn(removed, F.lit(None).cast("array<int>")))

    def run(batches):
        for batch in batches:
            at, by, lines = (batch.schema.get_field_index(c) for c in ("text", spans, removed))
            columns = list(batch.columns)
            made = [cut(t, s) for t, s in zip(columns[at].to_pylist(), columns[by].to_pylist())]
            columns[at] = pa.array([t for t, _ in made], type=pa.string())
            columns[lines] = pa.array([r for _, r in made], type=batch.schema.field(lines).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return joined.mapInArrow(run, joined.schema)


def without_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The same with only the columns of ``docs``, and ``n_chars`` of the new text.

    Nulls, empty texts, repeated rows, empty tables and other columns, whatever their names, are
    treated as ``dedup_lines`` does; ``n_chars`` of a text that lost nothing stays as it is.
    """
    spans, removed = fresh(docs, "_spans"), fresh(docs, "_removed")
    made = dedup_lines(docs, words, spans, removed)
    return made.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
        F.char_length("text")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
