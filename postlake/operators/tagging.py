"""Dictionary tagging: which terms a text holds as whole words.

Two plans give the same answer, by one definition of a word.  ``PATTERN`` folds the
dictionary into regular expressions that scan each text once, with no join; it suits a
dictionary written down in code.  ``JOIN`` cuts the text at word boundaries into alternating
runs and looks every boundary-to-boundary span as long as some term up by equality; it takes a
dictionary of any size.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN, JOIN = "pattern", "join"
SMALL_DICTIONARY = 8 << 20  # bytes of terms, measured, that every executor can hold
_WORD = r"\p{L}\p{Nd}\p{Mn}_"
_EDGE = f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"  # between a word character and another
RUNS = f"[{_WORD}]+|[^{_WORD}]+"


def _boundary(term: str, at: int) -> bool:
    def word(i: int) -> bool:
        return 0 <= i < len(term) and (term[i].isalnum() or term[i] == "_")
    return word(at - 1) != word(at)


def _ends(term: str, at: int) -> bool:
    return at == len(term) or _boundary(term, at)


def _may_overlap(a: str, b: str) -> bool:
    """Whether a whole-word match of one term can share characters with one of the other."""
    for outer, inner in ((a, b), (b, a)):
        for at in range(len(outer)):
            if at and not _boundary(outer, at):
                continue
            tail = outer[at:]
            if tail.startswith(inner) and _ends(outer, at + len(inner)):
                return True
            if inner.startswith(tail) and _ends(inner, len(tail)):
                return True
    return False


def pattern_groups(terms: Sequence[str]) -> list[list[str]]:
    """Terms split so that within a group no two matches can share characters.

    A scan for alternatives only reports matches that do not overlap; inside such
    a group it therefore misses none.
    """
    groups: list[list[str]] = []
    for term in dict.fromkeys(t.lower() for t in terms):
        home = next((g for g in groups if not any(_may_overlap(term, t) for t in g)), None)
        if home is None:
            groups.append([term])
        else:
            home.append(term)
    return groups


def _quote(term: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", term)


def found_terms(text: Column, terms: Sequence[str]) -> Column:
    """Array of the distinct lower-cased terms present in the text."""
    lowered = F.lower(text)
    hits = [
        F.regexp_extract_all(lowered, F.lit(f"{_EDGE}({'|'.join(map(_quote, group))}){_EDGE}"), F.lit(1))
        for group in pattern_groups(terms)
    ]
    return F.array_distinct(hits[0] if len(hits) == 1 else F.concat(*hits))


def tag_by_pattern(df: DataFrame, key: str, text: Column, terms: Sequence[str]) -> DataFrame:
    """(key, term) pairs, one scan of each text and no join."""
    return (df.select(key, found_terms(text, terms).alias("_terms"))
            .select(key, F.explode("_terms").alias("term")))


def _span_pattern(runs: int, word_first: bool) -> str:
    """One match per run of the first kind, capturing the span of so many runs from there.

    The span is captured ahead of the match and only its first run is consumed, so
    spans overlap but the scan goes run by run.  Possessive runs never give
    characters back, so a span always ends at a boundary.
    """
    word, other = f"[{_WORD}]++", f"[^{_WORD}]++"
    kinds = [word, other] if word_first else [other, word]
    return "(?=(" + "".join(kinds[i % 2] for i in range(runs)) + "))" + kinds[0]


def term_spans(text: Column, shapes: Sequence[tuple[int, bool]]) -> Column:
    """Distinct spans of the given shapes: number of runs, and whether a word run is first."""
    lowered = F.lower(text)
    found = [F.regexp_extract_all(lowered, F.lit(_span_pattern(*shape)), F.lit(1)) for shape in shapes]
    return F.array_distinct(found[0] if len(found) == 1 else F.concat(*found))


def _runs(term: str) -> Column:
    runs = F.size(F.regexp_extract_all(F.col(term), F.lit(RUNS), F.lit(0)))
    return F.struct(runs.alias("n"), F.col(term).rlike(f"^[{_WORD}]").alias("w"))


def term_shapes(words: DataFrame, term: str = "term") -> list[tuple[int, bool]]:
    """The distinct shapes of a dictionary's terms: a handful, whatever its size."""
    return _measured(words, term)[0]


def _measured(words: DataFrame, term: str = "term") -> tuple[list[tuple[int, bool]], int]:
    """The shapes of a dictionary's terms, and its size in bytes, from one aggregate."""
    size = F.sum(F.octet_length(term) + F.lit(32)).cast("bigint")
    shapes, held = words.select(F.collect_set(_runs(term)), F.coalesce(size, F.lit(0))).first()
    return sorted((row["n"], row["w"]) for row in shapes), held


def tag_by_join(df: DataFrame, key: str, text: Column, dictionary: DataFrame,
                term: str = "term") -> DataFrame:
    """(key, term) pairs by equality with a dictionary of any size.

    Only the key and the span travel to the join, never the text.  Catalyst cannot know how
    many spans a text has and takes them for a small side, so the plan is chosen here from
    the dictionary's measured size: the spans are never the side that is broadcast.
    """
    words = dictionary.select(F.lower(term).alias("term")).filter("term <> ''").distinct()
    shapes, size = _measured(words)
    if not shapes:
        return df.select(key, F.lit(None).cast("string").alias("term")).limit(0)
    spans = (df.select(key, term_spans(text, shapes).alias("_spans"))
             .select(key, F.explode("_spans").alias("term")))
    words = words.hint("broadcast" if size <= SMALL_DICTIONARY else "merge")
    return spans.join(words, "term").select(key, "term")


def tag(df: DataFrame, key: str, text: Column, terms: Sequence[str], plan: str = PATTERN) -> DataFrame:
    """(key, term) pairs for a dictionary given as a list; ``plan`` chooses how, not what."""
    if plan == PATTERN:
        return tag_by_pattern(df, key, text, terms)
    words = df.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return tag_by_join(df, key, text, words)


def skill_mentions(postings: DataFrame, skills: Sequence[str], key: str = "posting_id",
                   title: str = "job_title", text: str = "description", plan: str = PATTERN) -> DataFrame:
    """(posting, skill) pairs over title and description.

    ``found_terms`` is already distinct within a row and postings are unique by
    key, so no shuffle is needed to remove repeats.
    """
    whole = F.concat(F.col(title), F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return tag(postings, key, whole, skills, plan).select(
        key, F.md5(F.col("term").cast("binary")).alias("skill_id"))
