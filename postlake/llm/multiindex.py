"""Nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own k-means centroids (fitted on a
bounded sample); a cell is a pair of centroids.  All vectors are indexed by cell.  For a
query, cells are visited in order of the sum of their two half distances with a heap (the
multi-sequence walk) until they hold a given share of the vectors; what they hold is
reranked by the exact distance on the original vectors.

The index is dealt in blocks of at most BLOCK vectors of neighbouring cells; a query goes to
the blocks that hold a cell it visits, so a cell with very many equal vectors is many blocks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from postlake.llm.common import ranked, shipped, shuffle_width, stored

SAMPLE = 20_000  # vectors the centroids are fitted on, at most
MAX_CENTROIDS = 128  # per half; cells are at most its square
PROBE = 0.5  # share of the vectors that a query's cells must hold
BLOCK = 4096
QUERIES_AT_ONCE = 256
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())])


@dataclass
class Codebook:
    """Centroids of both halves; ``cut`` is where the second half begins."""
    cut: int
    first: np.ndarray
    second: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(vectors[:, :self.cut], self.first), squared(vectors[:, self.cut:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.distances(vectors)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centroids * centroids).sum(1)[None] - 2 * x @ centroids.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    draw = np.random.default_rng(7)
    centroids = np.unique(x, axis=0)
    if len(centroids) <= k:
        return centroids
    centroids = centroids[draw.choice(len(centroids), k, replace=False)]
    for _ in range(rounds):
        near = squared(x, centroids).argmin(1)
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def fit(vectors: DataFrame, total: int, sample: int = SAMPLE) -> Codebook | None:
    """Centroids from at most ``sample`` vectors, picked by a hash of their id."""
    rows = vectors.orderBy(F.xxhash64("vec_id", F.lit("fit")), "vec_id").limit(sample).select("vector").collect()
    if not rows:
        return None
    x = np.array([r["vector"] for r in rows], dtype=np.float64)
    k = int(min(MAX_CENTROIDS, max(2, total ** 0.5 / 1.5)))
    cut = max(1, x.shape[1] // 2)
    return Codebook(cut, kmeans(x[:, :cut], k), kmeans(x[:, cut:], k))


def walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, wanted: int) -> tuple[list[int], int]:
    """Cells in order of summed half distance, until they hold ``wanted`` vectors."""
    a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
    x, y = first[a], second[b]
    heap = [(x[0] + y[0], 0, 0)]
    seen = np.zeros(len(x), dtype=np.int64)  # next column of each row that may enter the heap
    seen[0] = 1
    out, count = [], 0
    while heap and count < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if held[cell]:
            out.append(cell)
            count += int(held[cell])
        if j + 1 < len(y) and seen[i] == j + 1 and (i == 0 or seen[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
            seen[i] = j + 2
        if i + 1 < len(x) and seen[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
            seen[i + 1] = j + 1
    return out, count


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` in double precision of the vectors that take part.

    Left out: null ids, null or empty vectors, vectors with null or non-finite
    components, and zero vectors.
    """
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        fine & F.exists("vector", lambda c: c != 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, probe: float = PROBE, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found, by Euclidean distance.

    ``vectors`` and ``queries`` have ``vec_id, vector`` (see ``usable``).  A query is not its
    own neighbour (rows with its id are left out); ties go to the smaller id; with fewer
    candidates all are returned.  Vectors of other lengths than the fitted ones take no
    part.  Empty tables give no rows.
    """
    spark = vectors.sparkSession
    shipped(spark)
    vectors = stored(vectors.dropDuplicates(["vec_id", "vector"]), "vectors")
    total = vectors.count()
    book = fit(vectors, total, sample)
    empty = spark.createDataFrame([], T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
                                                    *FOUND.fields[1:]]))
    if book is None:
        return empty
    size = book.first.shape[1] + book.second.shape[1]
    vectors = vectors.where(F.size("vector") == size)

    def add_cell(frames):
        for frame in frames:
            x = np.stack(frame["vector"].to_numpy()) if len(frame) else np.zeros((0, size))
            frame["cell"] = book.cells(x).astype(np.int32) if len(x) else np.zeros(0, dtype=np.int32)
            yield frame

    celled = stored(vectors.mapInPandas(add_cell, "vec_id long, vector array<double>, cell int"), "cells")
    cells = len(book.first) * len(book.second)
    held = np.zeros(cells, dtype=np.int64)
    for row in celled.groupBy("cell").count().collect():  # at most MAX_CENTROIDS squared rows
        held[row["cell"]] = row["count"]
    # blocks: cells laid out one after the other, cut every BLOCK vectors
    before = np.cumsum(held) - held
    width = int(min(BLOCK, max(256, total // (4 * shuffle_width(spark)))))
    wanted = int(np.ceil(probe * total)) + k
    placed = ranked(celled, F.col("cell"), ["vec_id"], "place")

    def add_block(frames):
        for frame in frames:
            frame["block"] = (before[frame["cell"].to_numpy()] + frame["place"].to_numpy()) // width
            yield frame[["vec_id", "vector", "cell", "block"]]

    index = placed.select("vec_id", "vector", "cell", "place").mapInPandas(
        add_block, "vec_id long, vector array<double>, cell int, block long")

    def route(frames):
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["vector"].to_numpy())
            a, b = book.distances(x)
            rows = []
            for i, (query, vector) in enumerate(zip(frame["query_id"], frame["vector"])):
                visited = np.array(walk(a[i], b[i], held, wanted)[0], dtype=np.int64)
                spans = np.unique(np.concatenate([np.arange(lo, hi + 1) for lo, hi in zip(
                    before[visited] // width, (before[visited] + held[visited] - 1) // width)]))
                bits = np.zeros(cells, dtype=bool)
                bits[visited] = True
                for block in spans:
                    # only the cells of this block, as bits from its first cell on
                    low = np.searchsorted(before + held, block * width, side="right")
                    high = np.searchsorted(before, (block + 1) * width, side="left")
                    rows.append((query, vector, int(block), int(low), np.packbits(bits[low:high]).tobytes()))
            yield pd.DataFrame(rows, columns=["query_id", "vector", "block", "low", "visited"])

    asked = queries.where(F.size("vector") == size).select(F.col("vec_id").alias("query_id"), "vector")
    routed = asked.repartition(shuffle_width(spark)).mapInPandas(
        route, "query_id long, vector array<double>, block long, low int, visited binary")

    def search(key, left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        x = np.stack(right["vector"].to_numpy())
        ids, cell = right["vec_id"].to_numpy(), right["cell"].to_numpy()
        out_q, out_v, out_s = [], [], []
        for at in range(0, len(left), QUERIES_AT_ONCE):
            part = left.iloc[at:at + QUERIES_AT_ONCE]
            q = np.stack(part["vector"].to_numpy())
            close = squared(q, x)
            for i, (query, low, visited) in enumerate(zip(part["query_id"], part["low"], part["visited"])):
                bits = np.unpackbits(np.frombuffer(visited, dtype=np.uint8)).astype(bool)
                inside = cell - low
                ok = (inside >= 0) & (inside < len(bits)) & (ids != query)
                ok[ok] = bits[inside[ok]]
                pick = np.flatnonzero(ok)
                if len(pick) > 4 * k:  # the fast distances only choose whom to measure exactly
                    rough = close[i, pick]
                    least = np.partition(rough, 2 * k)[2 * k]
                    pick = pick[rough <= least + 1e-9 * (1 + least)]
                exact = np.sqrt(((x[pick] - q[i]) ** 2).sum(1))
                best = np.lexsort((ids[pick], exact))[:k]
                out_q += [query] * len(best)
                out_v += ids[pick][best].tolist()
                out_s += exact[best].tolist()
        return pd.DataFrame({"query_id": np.array(out_q, dtype=np.int64), "vec_id": np.array(out_v, dtype=np.int64),
                             "score": np.array(out_s, dtype=np.float64)})

    found = routed.groupBy("block").cogroup(index.groupBy("block")).applyInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
