"""Nearest rows to a few query vectors by cosine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.dedup import keep_first

QUERIES_MAX = 200  # query vectors are constants of one plan; longer lists are refused, not cut


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles, NULL where one is zero or the lengths differ."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)


def match_by_vector(rows: DataFrame, queries: Mapping[str, Sequence[float]], k: int, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """``query, rank, key, score``: the ``k`` rows nearest to each query, ties by key.

    Queries are constants of the scan, so there is no join; each map task passes on its best
    ``k`` rows per query and nothing else is shuffled.  Rows whose vector is NULL, zero or of another
    length match nothing.
    """
    if len(queries) > QUERIES_MAX:
        raise ValueError(f"{len(queries)} query vectors; at most {QUERIES_MAX} go into one plan")
    if not queries:
        return rows.limit(0).select(F.lit("").alias("query"), F.lit(0).alias("rank"), key, F.lit(0.0).alias("score"))
    doubles = F.col(vector).cast("array<double>")
    scores = F.array(*[F.struct(F.lit(name).alias("query"), cosine(doubles, F.array(*[F.lit(float(x)) for x in values])).alias("score"))
                       for name, values in queries.items()])
    each = rows.select(key, F.explode(scores).alias("s")).select("s.query", key, "s.score").filter("score IS NOT NULL")
    return keep_first(each, ["query"], [F.desc("score"), F.asc(key)], k, "rank").select("query", "rank", key, "score")
