from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions import text
from postlake.functions.experience import with_experience
from postlake.functions.numbers import percent, steady_round
from postlake.functions.time import (closing_passed, epoch_millis_day, iso_day, likely_closed,
                                     quarter_label, season)


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'string' if values[n] is None or isinstance(values[n], str) else 'double' if isinstance(values[n], float) else 'date' if isinstance(values[n], date) and not isinstance(values[n], datetime) else 'timestamp' if isinstance(values[n], datetime) else 'bigint'}"
        for n in names))
    return df.select(column.alias("v")).first()[0]


@pytest.mark.parametrize("title, family", [
    ("Senior Data Engineer", "DE"),
    ("ETL pipeline for machine learning", "DE"),      # rule order: DE before DS
    ("BI Developer", "BI"),
    ("ML Engineer", "DS"),
    ("Product Analyst", "DA"),
    ("Full Stack Software Engineer", "SWE"),
    ("Office Manager", "OTHER"),
    ("Metl worker", "OTHER"),                          # whole words only
])
def test_classifier_takes_the_first_rule(spark, title, family):
    assert one(spark, text.classify(F.col("t")), t=title) == family


@pytest.mark.parametrize("raw, clean", [
    (None, "Unknown"), ("", "Unknown"), ("   ", "Unknown"), ("  Berlin \t  Mitte ", "Berlin Mitte")])
def test_location(spark, raw, clean):
    assert one(spark, text.normalize_location(F.col("l")), l=raw) == clean


def test_strip_markup(spark):
    assert one(spark, text.strip_markup(F.col("h")), h="<p>a</p>\n<b>b &amp; c</b>") == "a b &amp; c"
    assert one(spark, text.strip_markup(F.col("h")), h=None) == ""
    assert one(spark, text.strip_markup(F.col("h"), decode_entities=True), h="<i>a</i>&nbsp;&amp;lt; b") == "a &lt; b"


def test_bucket_and_decode(spark):
    bucket = text.bucketize(F.col("d"), V.LONGEVITY_EDGES, V.LONGEVITY_LABELS)
    assert [one(spark, bucket, d=d) for d in (0, 3, 4, 14, 30, 31)] == [
        "0-3 days", "0-3 days", "4-7 days", "8-14 days", "15-30 days", "30+ days"]
    label = text.decode(F.col("c"), V.ROLE_LABELS, V.ROLE_LABEL_DEFAULT)
    assert one(spark, label, c="BI") == "Business Intelligence"
    assert one(spark, label, c=None) == "Other Tech"


def test_dates(spark):
    assert one(spark, iso_day(F.col("t")), t="2024-03-05T10:00:00Z") == date(2024, 3, 5)
    assert one(spark, iso_day(F.col("t")), t="2024-13-45") is None      # bad text is NULL, not an error
    assert one(spark, epoch_millis_day(F.col("t")), t="1700006399999") == date(2023, 11, 14)
    assert one(spark, epoch_millis_day(F.col("t")), t="-1") == date(1969, 12, 31)
    assert one(spark, epoch_millis_day(F.col("t")), t="soon") is None
    assert one(spark, season(F.col("d")), d=date(2024, 12, 1)) == "Winter"
    assert one(spark, season(F.col("d")), d=date(2024, 10, 1)) == "Fall / Autumn"
    assert one(spark, quarter_label(F.col("d")), d=date(2024, 10, 1)) == "Q4"


def test_millis_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, epoch_millis_day(F.col("t")), t="1700006399999") == date(2023, 11, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_likely_closed(spark):
    as_of = date(2024, 1, 10)
    flag = likely_closed(F.col("c"), F.col("s"), as_of)
    assert one(spark, flag, c=date(2024, 1, 9), s=datetime(2024, 1, 9)) is True
    assert one(spark, flag, c=date(2024, 1, 10), s=datetime(2024, 1, 9)) is False
    assert one(spark, flag, c=date(2024, 2, 1), s=datetime(2024, 1, 2)) is True
    assert one(spark, likely_closed(F.col("c"), F.col("s"), as_of, archived=F.lit(True)),
               c=date(2024, 2, 1), s=datetime(2024, 1, 9)) is True
    assert one(spark, closing_passed(F.lit(None).cast("date"), as_of), x=1) is False


@pytest.mark.parametrize("title, description, expected", [
    ("Engineer", "3 - 5+ years experience", (3, 5, False, "MID")),
    ("Engineer", "2 to 4 yrs", (2, 4, False, "JUNIOR")),
    ("Engineer", "at least 9 years of professional experience", (9, None, False, "LEAD")),
    ("Engineer", "minimum 1 year of experience", (1, None, False, "FRESHER")),
    ("Engineer", "0-1 years", (0, 1, True, "FRESHER")),
    ("Summer Intern", None, (0, 1, True, "FRESHER")),
    ("Senior Engineer", "great team", (5, None, False, "MID")),   # senior title implies five years
    ("Principal Architect", "", (5, None, False, "MID")),
    ("Architect", "", (None, None, False, "LEAD")),
    ("Engineer", "40 - 60 years", (None, None, False, "UNSPECIFIED")),
    ("Engineer", "99999999999 - 5 years", (None, 5, False, "UNSPECIFIED")),
    ("Engineer", "nothing", (None, None, False, "UNSPECIFIED")),
])
def test_experience(spark, title, description, expected):
    df = spark.createDataFrame([(title, description)], "job_title string, description string")
    row = with_experience(df).first()
    assert (row.min_years_exp, row.max_years_exp, row.is_fresher, row.experience_level) == expected


def test_rounding_is_half_up_and_steady(spark):
    assert one(spark, steady_round(F.col("x"), 2), x=10.015) == 10.02
    assert one(spark, steady_round(F.col("x"), 1), x=66.24999999999999) == 66.3
    assert one(spark, percent(F.col("a"), F.lit(3)), a=1) == 33.33
