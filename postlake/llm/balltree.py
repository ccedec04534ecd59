"""Exact ranked lexical search with ball trees over sparse integer vectors.

A term is a run of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased.
The score of a document for a query is the sum over the query's terms of an integer weight times
an integer component of the document, so it is an inner product.  The documents, cut down to the
terms of the queries, are dealt to blocks; each block builds a tree by halving at the median of a
line between two far documents.  A node has a centroid and a radius, and no document in it scores
more than query x centroid + |query| x radius, rounded up.  A query walks the nodes of a block from
the highest bound down and stops when no bound reaches its tenth score; leaves are scored in
integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from postlake.llm.common import map_batches, shipped, stored

# Fixed values of the score.
UNIT, LENGTH_SHARE, TF_SCALE, LENGTH_SCALE, WEIGHT_SCALE = 10**9, 75, 1000, 8, 1000
LEAF = 128  # documents
BLOCK = 2_000_000  # components of the documents of a tree
QUERY_BYTES, QUERIES = 2 << 20, 2000  # of the queries that are searched for together; more take further blocks
SLACK = 1e-9  # relative; sums of some thousand doubles err far less

#: Term bytes: digits, letters (A-Z to a-z) and all bytes beyond ASCII as they are, everything else a space.
FOLD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

VECTORS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
FREQUENCIES = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("df", T.LongType())])
FOUND = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Queries:
    """A block of queries: their keys and terms, and the number of each term."""

    first: int
    keys: list
    texts: list[list[bytes]]
    vocabulary: dict[bytes, int]

    def matrix(self, weights: np.ndarray) -> np.ndarray:
        """Weight of each term (column) in each query (row), repeats included."""
        made = np.zeros((len(self.texts), len(self.vocabulary)), dtype=np.int64)
        for row, text in enumerate(self.texts):
            for term in text:
                made[row, self.vocabulary[term]] += 1
        return made * weights


def query_blocks(items: DataFrame, key: str, text: str) -> Iterator[Queries]:
    """The queries in blocks of bounded size; only one block is on the driver at a time."""
    keys, texts, size, first = [], [], 0, 0

    def block() -> Queries:
        return Queries(first, keys, texts, {t: i for i, t in enumerate(dict.fromkeys(t for one in texts for t in one))})

    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        keys.append(row["key"])
        texts.append(terms((row["text"] or "").encode("utf-8", "replace")))
        size += len(row["text"] or "")
        if size >= QUERY_BYTES or len(keys) >= QUERIES:
            yield block()
            first += len(keys)
            keys, texts, size = [], [], 0
    if keys:
        yield block()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts``: the number of terms of a text, and its terms that are in the vocabulary."""
    def read(keys, texts):
        lengths, found, counts = [], [], []
        for text in texts.cast(pa.binary()).to_pylist():
            words = terms(text or b"")
            lengths.append(len(words))
            held = Counter([vocabulary[w] for w in words if w in vocabulary])
            found.append(np.fromiter(held.keys(), dtype=np.int32, count=len(held)))
            counts.append(np.fromiter(held.values(), dtype=np.int32, count=len(held)))
        return {"doc_id": keys, "n": lengths, "terms": lists(found), "counts": lists(counts)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), read, VECTORS)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32), pa.int32()))


def frequencies(made: DataFrame, size: int) -> DataFrame:
    """Documents that hold each term: counted in each task, then summed."""
    def count(batches):
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], schema=to_arrow_schema(FREQUENCIES))

    return made.select("terms").mapInArrow(count, FREQUENCIES).groupBy("term").agg(F.sum("df").alias("df"))


def components(n: list[int], counts: np.ndarray, owners: np.ndarray, docs: int, words: int) -> np.ndarray:
    """The integer component of each term of each document: it grows with the count and falls with the length."""
    length = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * docs // words for x in n], dtype=np.int64)[owners]
    return UNIT * counts // (TF_SCALE * counts + LENGTH_SCALE * length)


class Tree:
    """Ball tree over the documents of one block, held as rows (terms and components) in leaf order."""

    def __init__(self, keys: np.ndarray, begins: np.ndarray, at: np.ndarray, values: np.ndarray, size: int):
        self.size, self.values, self.at, self.begins, self.keys = size, values, at, begins, keys
        order = np.arange(len(keys))
        self.spans: list[tuple[int, int]] = [(0, len(keys))]
        self.children: list[tuple[int, int] | None] = []
        self.centroids, self.radii = [], []
        squares = np.add.reduceat(values.astype(np.float64) ** 2, begins[:-1])
        node = 0
        while node < len(self.spans):
            lo, hi = self.spans[node]
            rows = order[lo:hi]
            centre, far = self.ball(rows, squares)
            self.centroids.append(centre)
            self.radii.append(math.sqrt(float(far.max())) * (1 + SLACK))
            if hi - lo <= LEAF:
                self.children.append(None)
            else:
                one = rows[int(far.argmax())]
                other = rows[int(self.distances(rows, squares, self.dense(one)).argmax())]
                along = self.dots(rows, self.dense(other) - self.dense(one))
                middle = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(along, middle)]
                self.children.append((len(self.spans), len(self.spans) + 1))
                self.spans += [(lo, lo + middle), (lo + middle, hi)]
            node += 1
        entries, ends = self.entries(order)
        self.at, self.values, self.keys, self.begins = self.at[entries], self.values[entries], keys[order], np.concatenate([[0], ends])
        self.centroids, self.radii = np.array(self.centroids), np.array(self.radii)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the components of some rows, one row after the other, and where each row ends."""
        sizes = self.begins[rows + 1] - self.begins[rows]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1]) + np.repeat(self.begins[rows] - (ends - sizes), sizes), ends

    def dense(self, row: int) -> np.ndarray:
        made = np.zeros(self.size)
        held = slice(self.begins[row], self.begins[row + 1])
        made[self.at[held]] = self.values[held]
        return made

    def dots(self, rows: np.ndarray, direction: np.ndarray) -> np.ndarray:
        entries, ends = self.entries(rows)
        return np.add.reduceat(self.values[entries] * direction[self.at[entries]], np.concatenate([[0], ends[:-1]]))

    def distances(self, rows: np.ndarray, squares: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distances, rounded up by more than the sums can err."""
        own, other = squares[rows], float(point @ point)
        return np.maximum(own + other - 2 * self.dots(rows, point), 0) + SLACK * (own + other)

    def ball(self, rows: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entries, _ = self.entries(rows)
        centre = np.bincount(self.at[entries], weights=self.values[entries], minlength=self.size) / len(rows)
        return centre, self.distances(rows, squares, centre)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that a document of each node (column) can score for each query (row)."""
        weights = queries.astype(np.float64)
        reach = np.sqrt((weights ** 2).sum(axis=1))[:, None] * self.radii
        return (weights @ self.centroids.T + reach) * (1 + SLACK) + 1

    def search(self, query: np.ndarray, bounds: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """The ``k`` best ``(score, doc_id)`` with a score above 0, and how many leaves were scored."""
        best: list[tuple[int, int]] = []  # heap of (score, -doc_id): the worst of the best is on top
        walk, leaves = [(-bounds[0], 0)], 0
        while walk:
            bound, node = heapq.heappop(walk)
            if len(best) == k and -bound < best[0][0]:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(walk, (-bounds[child], child))
                continue
            lo, hi = self.spans[node]
            leaves += 1
            held = slice(self.begins[lo], self.begins[hi])
            scores = np.add.reduceat(self.values[held] * query[self.at[held]], self.begins[lo:hi] - self.begins[lo])
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[i]), -int(self.keys[lo + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(score, -key) for score, key in best], leaves


def searched(made: DataFrame, queries: np.ndarray, first: int, docs: int, words: int, k: int) -> DataFrame:
    """``query, doc_id, score``: the best ``k`` of each block of documents for each query."""
    def block(keys, n, at, counts) -> pa.RecordBatch:
        sizes = np.concatenate([np.diff(o) for o, _ in at])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        where = np.concatenate([values for _, values in at])
        values = components(n, np.concatenate(counts).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), docs, words)
        tree = Tree(np.array(keys, dtype=np.int64), begins, where, values, queries.shape[1])
        bounds = tree.bounds(queries)
        found = [(first + i, key, score) for i, query in enumerate(queries) for score, key in tree.search(query, bounds[i], k)[0]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found) if found else ((), (), ()), to_arrow_schema(FOUND))],
                                          schema=to_arrow_schema(FOUND))

    def run(batches):
        keys, n, at, counts, size = [], [], [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            where, held = batch.column("terms"), batch.column("counts")
            keys += batch.column("doc_id").to_pylist()
            n += batch.column("n").to_pylist()
            at.append((where.offsets.to_numpy(), where.flatten().to_numpy()))
            counts.append(held.flatten().to_numpy())
            size += len(counts[-1])
            if size >= BLOCK:
                yield block(keys, n, at, counts)
                keys, n, at, counts, size = [], [], [], [], 0
        if keys:
            yield block(keys, n, at, counts)

    return made.where("size(terms) > 0 and doc_id is not null").mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, all exact.

    ``docs`` has ``doc_id`` and ``text``.  Null and empty texts have no terms: such a document is
    in no result and such an item has no rows.  Scores of 0 are no results; equal scores are ranked
    by ``doc_id``; repeated rows of one ``doc_id`` are documents of their own (equal ones rank next to
    each other); repeated items are searched for each, and their rows tell apart by rank only.
    Documents without an id count in the statistics and are in no result.  Other columns are ignored;
    empty tables give no rows.
    """
    spark = docs.sparkSession
    shipped(spark)
    parts = []
    for block in query_blocks(items, key, text):
        if not block.vocabulary:
            continue
        made = stored(vectors(docs, block.vocabulary), "vectors")
        total = made.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
        if not total["docs"]:
            continue
        weights = np.zeros(len(block.vocabulary), dtype=np.int64)
        df = dict.fromkeys(range(len(weights)), 0) | {r["term"]: r["df"] for r in frequencies(made, len(weights)).collect()}  # of this block's terms
        for term, n in df.items():
            weights[term] = math.floor(WEIGHT_SCALE * math.log((2 * total["docs"] + 2) / (2 * n + 1)))
        found = searched(made, block.matrix(weights), block.first, total["docs"], total["words"], k)
        names = spark.createDataFrame([(block.first + i, name) for i, name in enumerate(block.keys)],
                                      T.StructType([T.StructField("query", T.IntegerType()), T.StructField(key, items.schema[key].dataType)]))
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id"))).where(F.col("rank") <= k)
        parts.append(stored(best.join(names, "query").select(key, "rank", "doc_id", "score"), "found"))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(key, items.schema[key].dataType), T.StructField("rank", T.IntegerType()),
                                                       T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
