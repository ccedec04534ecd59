"""Packing token pieces into sequences by fitted length patterns.

Documents are cut into pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (``capacity`` numbers, whatever the number of documents) reaches the
driver.  There the repeat counts of full patterns of one, two or three lengths are
fitted to the histogram by non-negative least squares, rounded down, and the rest is packed
best-fit, also by counts.  Each piece then finds its sequence from its rank among the
pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import map_batches, ranked, shuffle_width, stored, text_strings

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("copy", T.LongType())])
END = (0).to_bytes(4, "little")
GRID = 32  # step of the second length in patterns of three
SWEEPS = 6


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """One row per piece: ids end with id 0; only longer documents are cut, the first piece short.

    A null text is empty (one piece of one token).  ``copy`` tells rows with equal keys apart.
    """
    def work(keys, copies, texts):
        from postlake.llm.bytebpe import tokenizer
        out: dict[str, list] = {f.name: [] for f in PIECES}
        for doc, copy, ids in zip(keys.to_pylist(), copies.to_pylist(), tokenizer(tokenizer_file).encoded(text_strings(texts))):
            ids += END
            total = len(ids) // 4
            cut, number = (total % capacity or capacity) if total > capacity else total, 0
            start = 0
            while start < total:
                out["doc_id"].append(doc)
                out["copy"].append(copy)
                out["piece"].append(number)
                out["start"].append(start)
                out["length"].append(cut - start)
                out["ids_crc32"].append(zlib.crc32(memoryview(ids)[4 * start:4 * cut]))
                start, cut, number = cut, cut + capacity, number + 1
        return out

    return map_batches(docs.select(docs[key].cast("long"), F.monotonically_increasing_id().alias("copy"),
                                   docs[text].cast("string")), work, PIECES)


def fit_patterns(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """Non-negative least-squares repeat counts of full patterns, by coordinate descent.

    Minimises the squared difference between the pieces that the patterns use and
    ``counts`` (by length), over patterns of lengths that occur and fill a sequence.
    """
    have = [length for length in range(1, capacity + 1) if counts[length]]
    there = set(have)
    patterns = [(capacity,)] if capacity in there else []
    patterns += [(a, capacity - a) for a in have if 2 * a >= capacity and a < capacity and capacity - a in there]
    for b in have:
        if b % GRID and len(have) > 4 * GRID:
            continue
        for a in have:
            c = capacity - a - b
            if a >= b >= c > 0 and c in there or a >= c >= b and c in there:
                patterns.append(tuple(sorted((a, b, c), reverse=True)))
    patterns = sorted(set(patterns), key=lambda p: (len(p), tuple(-x for x in p)))
    rest = counts.astype(float).tolist()
    uses = [tuple((length, p.count(length)) for length in set(p)) for p in patterns]
    x = [0.0] * len(patterns)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, use in enumerate(uses):
            gain = norm = 0.0
            for length, n in use:
                gain += n * rest[length]
                norm += n * n
            step = max(-x[j], gain / norm)
            if step:
                x[j] += step
                moved += abs(step)
                for length, n in use:
                    rest[length] -= n * step
        if moved < 0.5:
            break
    return [(p, n) for p, n in zip(patterns, x) if n > 0]


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with whole repeat counts that use every piece exactly once."""
    left = counts.copy()
    made: dict[tuple[int, ...], int] = defaultdict(int)
    for pattern, repeats in sorted(fit_patterns(counts, capacity), key=lambda f: (-f[1], f[0])):
        whole = int(repeats + 0.5)
        for length in set(pattern):
            whole = min(whole, int(left[length]) // pattern.count(length))
        if whole > 0:
            made[pattern] += whole
            for length in pattern:
                left[length] -= whole
    # residuals: best fit by counts; open sequences of equal content are one group
    groups: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    spaces: list[int] = []
    for length in range(capacity, 0, -1):
        todo = int(left[length])
        while todo:
            at = int(np.searchsorted(spaces, length))
            if at == len(spaces):
                many = capacity // length
                for n, times in ((many, todo // many), (todo % many, 1)):
                    if n and times:
                        space = capacity - n * length
                        pattern = (length,) * n
                        if space:
                            groups[space][pattern] = groups[space].get(pattern, 0) + times
                            spaces = sorted(groups)
                        else:
                            made[pattern] += times
                todo = 0
                continue
            space = spaces[at]
            pattern, have = next(iter(groups[space].items()))
            fit = min(space // length, todo)
            times = min(have, todo // fit)
            if times == have:
                del groups[space][pattern]
                if not groups[space]:
                    del groups[space]
            else:
                groups[space][pattern] = have - times
            grown, room = pattern + (length,) * fit, space - fit * length
            if room:
                groups[room][grown] = groups[room].get(grown, 0) + times
            else:
                made[grown] += times
            spaces = sorted(groups)
            todo -= fit * times
    for same in groups.values():
        for pattern, times in same.items():
            made[pattern] += times
    return list(made.items())


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank), the sequence of that rank, and the offset there."""
    used: dict[int, int] = defaultdict(int)
    rows = []
    base = 0
    for pattern, repeats in patterns:
        offset = 0
        for length in pattern:
            rows.append((length << 44 | used[length], base, offset))
            used[length] += repeats
            offset += length
        base += repeats
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else ((), (), ())))


def assign(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    keys, bases, offsets = slots(plan(counts, capacity))
    placed = ranked(pieces, F.col("length"), ["doc_id", "piece", "copy"])
    schema = T.StructType([f for f in PIECES if f.name != "copy"] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def work(doc, piece, start, length, crc, rank):
        rank = rank.to_numpy(zero_copy_only=False)
        key = (length.to_numpy(zero_copy_only=False) << 44) | rank
        at = np.searchsorted(keys, key, side="right") - 1
        return {"doc_id": doc, "piece": piece, "start": start, "length": length, "ids_crc32": crc,
                "sequence_id": pa.array(bases[at] + (key - keys[at])), "offset": pa.array(offsets[at])}

    return map_batches(placed.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), work, schema)


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, text: str = "text",
         key: str = "doc_id") -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    Null and empty texts give one piece of one token; repeated rows and null keys are
    packed each; an empty table gives no rows; other columns are ignored.  Texts of any
    length are cut, never shortened.
    """
    return assign(stored(token_pieces(docs, tokenizer_file, capacity, text, key), "pieces"), capacity)
