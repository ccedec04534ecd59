"""Date and time functions; "now" is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.text import decode

MILLIS_PER_DAY = 86_400_000
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"


def as_day(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def day(as_of: date | datetime, minus_days: int = 0) -> Column:
    """The as-of day as a date literal, so comparisons can be pushed to the scan."""
    return F.lit(as_day(as_of) - timedelta(days=minus_days))


def moment(as_of: date | datetime, minus_days: int = 0) -> Column:
    """The as-of time as a UTC timestamp literal."""
    at = as_of if isinstance(as_of, datetime) else datetime(as_of.year, as_of.month, as_of.day)
    at = at - timedelta(days=minus_days)
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f") + " UTC").cast("timestamp")


def iso_day(text: Column) -> Column:
    """The date in the first ten characters of ISO text, or NULL."""
    return F.substring(text, 1, 10).try_cast("date")


def epoch_millis_day(text: Column) -> Column:
    """The UTC date of an epoch-milliseconds text, whatever the session time zone."""
    days = F.floor(text.try_cast("bigint") / F.lit(MILLIS_PER_DAY)).cast("int")
    return F.date_add(F.lit(date(1970, 1, 1)), days)


def date_key(value: Column) -> Column:
    return F.date_format(value, "yyyyMMdd").cast("bigint")


def year_month(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM")


def season(value: Column) -> Column:
    return decode(F.month(value), V.SEASONS, V.SEASON_DEFAULT)


def quarter_label(value: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(value).cast("string"))


def iso_text(value: Column, kind: str) -> Column:
    """ISO text of a date or timestamp column."""
    return F.date_format(value, "yyyy-MM-dd" if kind == "date" else ISO_SECONDS)


def closing_passed(closing: Column, as_of) -> Column:
    return F.coalesce(closing < day(as_of), F.lit(False))


def unseen_since(last_seen: Column, as_of, days: int) -> Column:
    return last_seen < moment(as_of, days)


def likely_closed(closing: Column, last_seen: Column, as_of,
                  days: int = V.CLOSED_AFTER_DAYS, archived: Column | None = None) -> Column:
    """Archived, past its closing date, or not seen for a number of days."""
    flag = closing_passed(closing, as_of) | unseen_since(last_seen, as_of, days)
    return flag if archived is None else archived | flag
