"""Experience wanted by a posting, read out of its title and description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.text import first_match, has_word


def is_fresher(title: Column, text: Column) -> Column:
    hit = has_word(title, V.FRESHER_TITLE) | has_word(F.coalesce(text, F.lit("")), V.FRESHER_TEXT)
    return F.coalesce(hit, F.lit(False))


def years_mention(text: Column, pattern: str) -> Column:
    """First number the pattern captures; no match or an overflow gives NULL."""
    return F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), pattern, 1).try_cast("int")


def _within(value: Column, top: int) -> Column:
    return value.isNotNull() & value.between(0, top)


def experience_level(fresher: Column, low: Column, title: Column) -> Column:
    by_years = [(low <= years, label) for years, label in V.LEVEL_BY_YEARS]
    by_years[0] = (fresher | by_years[0][0], by_years[0][1])
    by_title = [(has_word(title, words), label) for label, words in V.LEVEL_BY_TITLE]
    return first_match(
        by_years + [(low > V.LEVEL_BY_YEARS[-1][0], V.LEVEL_ABOVE)] + by_title, V.LEVEL_DEFAULT)


def with_experience(df: DataFrame, title: str = "job_title", text: str = "description") -> DataFrame:
    """Add ``min_years_exp``, ``max_years_exp``, ``is_fresher`` and ``experience_level``.

    A title that sounds senior but states no years is taken to want five of them.
    Three projections, so that each regular expression runs once per row.
    """
    found = df.withColumns({
        "is_fresher": is_fresher(F.col(title), F.col(text)),
        "_low": years_mention(F.col(text), V.YEARS_LOW),
        "_high": years_mention(F.col(text), V.YEARS_HIGH),
        "_single": years_mention(F.col(text), V.YEARS_SINGLE),
    })
    low = (F.when(F.col("is_fresher"), F.lit(0))
           .when(_within(F.col("_low"), V.MAX_LOW_YEARS), F.col("_low"))
           .when(_within(F.col("_single"), V.MAX_LOW_YEARS), F.col("_single"))
           .when(has_word(F.col(title), V.ASSUMED_SENIOR_TITLE), F.lit(V.ASSUMED_SENIOR_YEARS)))
    high = (F.when(F.col("is_fresher"), F.lit(1))
            .when(_within(F.col("_high"), V.MAX_HIGH_YEARS), F.col("_high")))
    bounded = found.withColumns({"min_years_exp": low, "max_years_exp": high})
    level = experience_level(F.col("is_fresher"), F.col("min_years_exp"), F.col(title))
    return bounded.withColumn("experience_level", level).drop("_low", "_high", "_single")
