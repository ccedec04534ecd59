"""Licence families of paragraphs: a sparse n-gram classifier confirmed against templates.

A multinomial logistic regression over word 1- and 2-grams is fitted on the driver from
the templates below (shortened, embedded in other words, and mixed up as unknown
examples), a few thousand short examples whatever the size of the corpus.  Its weights
and the n-grams of the templates are one small table of fixed size, broadcast to the
n-grams of the corpus; what is shuffled is one row of sums for each window.

A paragraph is a run of lines without a blank one (nothing but signs counts as blank).  It
is read in windows of twice the longest template's words, each begun half a window after
the last, so that every notice lies whole in one wherever lines end.  Windows without any
anchor word are skipped: anchors are chosen so that too little of any template is left
without them to be confirmed.
"""

from __future__ import annotations

import functools
import math
import operator
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: short notices by which the families are known
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the Apache License, Version 2.0.",
                   "Released under the Apache 2.0 license."),
    "mit": ("Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL v3.",
                "Released under the GNU General Public License v3.0 or later."),
    "gpl-2.0": ("This program is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL v2."),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 3.", "Licensed under the GNU LGPL v2.1."),
    "agpl-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "Licensed under the GNU AGPL v3."),
    "bsd": ("Licensed under the BSD 3-Clause License.", "Released under the BSD license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    "mpl-2.0": ("Licensed under the Mozilla Public License, version 2.0.", "This file is subject to the terms of the Mozilla Public License."),
    "isc": ("Licensed under the ISC License.", "Released under the ISC license."),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "This work is dedicated to the public domain under CC0."),
    "all-rights": ("All rights reserved.", "Copyright, all rights reserved."),
}
ORDINARY = ("the driver must carry a valid license for the car", "copyright law is taught in the second year",
            "he asked permission to leave the public room", "the general version of this work is under review",
            "a person may use the file under the table", "all members are reserved and public rights differ",
            "the license office is open to the public", "see version 3 of the report", "the mit campus is large")
FAMILIES = (*TEMPLATES, "unknown")
WORD = r"[a-z0-9][a-z0-9.-]*[a-z0-9]|[a-z0-9]"
# fixed values: words too common to look for
COMMON = frozenset("a all any be by for from in is not of or the this to under use with without work you version".split())
COPIES = 40  # training examples of each template
LEAST_OVERLAP = 0.6


def grams(words: list[str]) -> list[str]:
    return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))})


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def longest() -> int:
    """Words of the longest template: the step between windows."""
    return max(len(words_of(n)) for notices in TEMPLATES.values() for n in notices)


@functools.lru_cache(maxsize=1)
def anchors() -> tuple[str, ...]:
    """Words, at least one of which any confirmed window holds.

    As long as some template's n-grams without an anchor could still make up
    LEAST_OVERLAP of it, the word that most such templates share becomes one more.
    """
    notices = [words_of(n) for family in TEMPLATES.values() for n in family]
    chosen: list[str] = []
    while True:
        open_ones = [words for words in notices if sum(not set(g.split()) & set(chosen) for g in grams(words)) >= LEAST_OVERLAP * len(grams(words))]
        if not open_ones:
            return tuple(sorted(chosen))
        shared = Counter(w for words in open_ones for w in set(words) - set(chosen) - COMMON)
        chosen.append(min(shared, key=lambda w: (-shared[w], -len(w), w)))


def examples(draw: random.Random) -> list[tuple[list[str], int]]:
    """Shortened and embedded templates of each family; unknown ones from loose words of all and
    from templates that lost the words by which their family is known."""
    filler = [w for line in ORDINARY for w in line.split()]
    pool = filler + [w for notices in TEMPLATES.values() for n in notices for w in words_of(n)]
    families = Counter(w for notices in TEMPLATES.values() for w in {w for n in notices for w in words_of(n)})
    made, bare = [], []
    for family, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            stripped = [w for w in words_of(notice) if families[w] > 1]
            whole = any(set(grams(stripped)) <= set(grams(words_of(n))) for notices in TEMPLATES.values() for n in notices)
            bare += [stripped] if not whole else []  # a notice may be another's with a word more
            for copy in range(COPIES):
                words = words_of(notice)
                if copy and len(words) > 5:
                    words = [w for w in words if draw.random() > 0.05]
                before, after = (draw.choices(filler, k=draw.randrange(longest())) if copy > 3 else [] for _ in range(2))
                made.append((before + words + after, family))
    known = len(made)
    for n in range(known):
        if n % 4 == 0:
            words = draw.choice(ORDINARY).split()
        elif n % 4 == 1:
            words = draw.choices(pool, k=draw.randrange(3, longest()))
        elif n % 4 == 2:
            words = draw.choices(filler, k=draw.randrange(3, 2 * longest()))
        else:
            words = draw.choices(filler, k=draw.randrange(8)) + draw.choice(bare) + draw.choices(filler, k=draw.randrange(8))
        made.append((words, len(TEMPLATES)))
    draw.shuffle(made)
    return made


@functools.lru_cache(maxsize=1)
def fit() -> tuple[dict[str, list[float]], list[float], float]:
    """Weights of each n-gram by family, the biases, and the least probability of a known family.

    The threshold is set on examples held out of the fit: half way, in log odds, between
    the most certain wrong answer and the 5 % least certain right ones, at least 0.5.
    """
    made = examples(random.Random(11))
    held, fitted = made[::4], [m for i, m in enumerate(made) if i % 4]
    counts: dict[str, int] = {}
    for words, _ in fitted:
        for g in grams(words):
            counts[g] = counts.get(g, 0) + 1
    index = {g: i for i, g in enumerate(sorted(g for g, n in counts.items() if n >= 3))}

    def design(rows):
        x = np.zeros((len(rows), len(index) + 1))
        x[:, -1] = 1
        for r, (words, _) in enumerate(rows):
            for g in grams(words):
                if g in index:
                    x[r, index[g]] = 1
        return x, np.eye(len(FAMILIES))[[f for _, f in rows]]

    x, y = design(fitted)
    w = np.zeros((x.shape[1], len(FAMILIES)))
    speed = np.zeros_like(w)
    for _ in range(300):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 0.5 * (x.T @ (p - y) / len(x) + 1e-5 * w)
        w += speed
    x, y = design(held)
    z = x @ w
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best, right = p[:, :-1].max(1), p[:, :-1].argmax(1) == y.argmax(1)
    odds = np.log(np.clip(best, 1e-9, 1 - 1e-9) / (1 - np.clip(best, 1e-9, 1 - 1e-9)))
    wrong = odds[~right].max() if (~right).any() else -9.0
    sure = np.quantile(odds[right], 0.05) if right.any() else 9.0
    least = max(0.5, 1 / (1 + math.exp(-min(wrong + sure, 2 * sure) / 2)))
    return {g: w[i].round(6).tolist() for g, i in index.items()}, w[-1].round(6).tolist(), float(min(least, 0.9))


def gram_table(spark: SparkSession) -> DataFrame:
    """``gram, numbers``: millionths of its weight by family, then which templates hold it (0 or 1).

    The empty n-gram, which every window holds, carries the biases.
    """
    weights, bias, _ = fit()
    notices = [set(grams(words_of(n))) for family in TEMPLATES.values() for n in family]
    rows = {"": [*bias, *[0] * len(notices)]}
    for g in sorted(weights.keys() | set().union(*notices)):
        rows[g] = [*weights.get(g, [0] * len(FAMILIES)), *(g in n for n in notices)]
    shown = ",".join(f"('{g}','{','.join(str(round(v * 1e6) if i < len(FAMILIES) else int(v)) for i, v in enumerate(row))}')"
                     for g, row in rows.items())
    return spark.sql(f"SELECT gram, cast(split(numbers, ',') AS array<long>) AS numbers FROM VALUES {shown} AS t(gram, numbers)")


def windows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``row, doc_id, place, start, grams`` of the windows that hold an anchor word.

    ``place`` numbers the paragraphs of a text and ``start`` the words of a paragraph.  A
    word cut by a hyphen at the end of a line is read on in the next.
    """
    step = longest()
    known = F.array(*[F.lit(w) for w in anchors()])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("doc_id"),
                       F.lower(docs[text].cast("string")).alias("text")).where(
        functools.reduce(operator.or_, [F.col("text").contains(w) for w in anchors()]))
    parts = rows.select("row", "doc_id", F.posexplode(F.split("text", r"\n[^\p{L}\p{N}\n]*\n")).alias("place", "part"))
    words = F.regexp_extract_all(F.regexp_replace("part", r"-[ \t\r]*\n[^\p{L}\p{N}\n]*", "-"), F.lit(WORD), F.lit(0))
    parts = parts.select("row", "doc_id", "place", words.alias("words")).where(F.arrays_overlap("words", known))
    last = F.greatest(F.ceil((F.size("words") - step) / step) - 1, F.lit(0)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("words", k * step + 1, 2 * step))
    held = parts.select("row", "doc_id", "place", F.posexplode(cut).alias("k", "words")).where(F.arrays_overlap("words", known))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))),
                        lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))
    return held.select("row", "doc_id", "place", (F.col("k") * step).cast("long").alias("start"),
                       F.array_distinct(F.concat("words", pairs, F.array(F.lit("")))).alias("grams"))


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, place, family, start, probability, overlap, confirmed``: a row for each family in a paragraph.

    Paragraphs with an anchor word are judged.  A window's family is unknown below the
    calibrated probability or when no template of the family shares LEAST_OVERLAP of its
    n-grams with it; ``confirmed`` tells whether one does.  A paragraph has one row for each
    known family of its windows, with the most probable window (ties to the first), or one
    unknown row.  ``start`` is the word the window begins at.

    Null and empty texts have no paragraph; repeated rows are scanned each; null keys stay
    null; very long texts are cut to windows in place; other columns are ignored, whatever
    their names; empty tables give no rows.
    """
    least = fit()[2]
    several = [len(grams(words_of(n))) for family in TEMPLATES.values() for n in family]
    owner = [f for f, family in enumerate(TEMPLATES.values()) for _ in family]
    terms = windows(docs, text, key).select("row", "doc_id", "place", "start", F.explode("grams").alias("gram"))
    summed = [F.sum(F.get("numbers", F.lit(i))).alias(f"n{i}") for i in range(len(FAMILIES) + len(several))]
    sums = (terms.join(F.broadcast(gram_table(docs.sparkSession)), "gram")  # a few thousand rows, fixed by the templates
            .groupBy("row", "doc_id", "place", "start").agg(*summed))
    shares = [F.array_max(F.array(*[F.col(f"n{len(FAMILIES) + t}") / F.lit(several[t]) for t in range(len(several)) if owner[t] == f]))
              for f in range(len(TEMPLATES))]
    at = ["row", "doc_id", "place", "start"]
    scored = sums.select(*at, F.array(*[F.col(f"n{f}") / F.lit(1e6) for f in range(len(FAMILIES))]).alias("z"), F.array(*shares).alias("shares"))
    scored = scored.withColumn("p", F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    scored = scored.select(*at, "shares", F.slice(F.transform("p", lambda v: v / F.aggregate("p", F.lit(0.0), lambda a, b: a + b)),
                                                  1, len(TEMPLATES)).alias("known"))
    judged = scored.select(*at, F.array_max("known").alias("probability"),
                           F.array_position("known", F.array_max("known")).cast("int").alias("guess"), "shares")
    judged = judged.select(*at, "probability", "guess", F.element_at("shares", F.col("guess")).alias("overlap"))
    family = F.when((F.col("probability") >= least) & (F.col("overlap") >= LEAST_OVERLAP), F.col("guess")).otherwise(len(FAMILIES))
    best = F.max(F.struct("probability", (-F.col("start")).alias("before"), "overlap"))
    each = judged.withColumn("family", family).groupBy("row", "doc_id", "place").pivot("family", list(range(1, len(FAMILIES) + 1))).agg(best)
    found = F.array(*[F.when(F.col(str(f)).isNotNull(), F.struct(F.lit(name).alias("family"), F.col(str(f)).alias("best")))
                      for f, name in enumerate(FAMILIES, 1) if name != "unknown"])
    unknown = F.array(F.struct(F.lit("unknown").alias("family"), F.col(str(len(FAMILIES))).alias("best")))
    rows = each.withColumn("found", F.array_compact(found)).select(
        "doc_id", "place", F.explode(F.when(F.size("found") > 0, F.col("found")).otherwise(unknown)).alias("one"))
    return rows.select("doc_id", F.col("place").cast("long").alias("place"), "one.family", (-F.col("one.best.before")).alias("start"),
                       F.round("one.best.probability", 6).alias("probability"), F.round("one.best.overlap", 6).alias("overlap"),
                       (F.col("one.best.overlap") >= LEAST_OVERLAP).alias("confirmed"))
